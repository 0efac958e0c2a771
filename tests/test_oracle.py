"""Every registered query against its DuckDB SQL on the smallest data set."""
import sys

import duckdb
import pytest

sys.path.insert(0, __import__("os").path.join(__import__("os").path.dirname(__file__), "..", "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
NAMES = sorted(n for n in entry.queries() if not n.startswith("op") and n != "pipeline")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(NAMES) <= set(SQL) <= set(entry.queries())  # every query of the library itself has oracle SQL


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert df.columns
        return
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(cols, drows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "body" in df.columns
