"""Registered training-data queries against their SQL, and the pipeline."""
import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from relaykit.llm import queries
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    res = con.execute(queries.SQL[name])
    cols = [d[0] for d in res.description]
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, res.fetchall())[0]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == corpus_pipeline.COLUMNS, name
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), SF).collect() == []


def test_pipeline_removes_repeats_of_over_50_words(spark):
    def words(tag, n):
        return " ".join(f"{tag}{i:03d}" for i in range(n))
    rows, want = [], {}
    for k, n in enumerate((20, 49, 51, 58, 64)):  # under 400 bytes each
        passage = words(f"p{chr(97 + k)}", n)
        for j in range(2):
            # the bytes at the edges differ, but for 49 words: there parts of words are repeated too
            a, b = (words(f"x{k}{j}", 30), words(f"y{k}{j}", 30)) if n == 49 else (words(f"x{k}{j}", 30) + "ab"[j], "cd"[j] + words(f"y{k}{j}", 30))
            rows.append((2 * k + j, f"{a} {passage} {b}", "en", "src0", 0))
            want[2 * k + j] = f"{a} {b}" if n > 50 else f"{a} {passage} {b}"
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.repeats(spark, docs, SF).collect()}
    assert got == want


def test_pipeline_keeps_every_source_and_character(spark):
    rows = [(k, f"text {k}", "en", s, 6) for k, s in enumerate([None, "new", "src0"] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.mixing(spark, docs, SF).groupBy("source").count().collect()
    assert {r["source"] for r in got} == {None, "new", "src0"} and min(r["count"] for r in got) > 10
    passage = " ".join(f"wört{k:03d}" for k in range(60))
    rows = [(1, f"a \ufffd é{passage}é keep \ufffd"), (2, f"b {passage} one"), (3, "x \ufffd y"), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.repeats(spark, docs, SF).collect()}
    assert got == {1: "a \ufffd é é keep \ufffd", 2: "b  one", 3: "x \ufffd y", 4: "", 5: ""}
