from pyspark.sql import functions as F
import duckdb

from relaykit.registry import REGISTRY, parse_table_list
from relaykit.sources import jdbc


def test_range_predicates_cover_all_keys():
    for lower, upper, parts in ((0, 99, 4), (1, 10, 2), (5, 5, 3), (0, 2, 10)):
        preds = jdbc.range_predicates("id", lower, upper, parts)
        con = duckdb.connect()
        con.execute("create table t as select range - 50 as id from range(300) union all select null")
        got = [con.execute(f"select count(*) from t where ({p})").fetchall()[0][0] for p in preds]
        assert sum(got) == 301  # ids outside the bounds and nulls are each in one range
        assert 1 <= len(preds) <= parts


def test_date_predicates_and_select_list():
    preds = jdbc.date_predicates(["2024-01-01", "2024-01-02"], "id", (1, 10), 2)
    assert len(preds) == 4 and all(p.startswith("dt = '2024-01-0") for p in preds)
    assert jdbc.select_list(REGISTRY.get("user_info"), "id") == \
        "id, user_unique_id, reg_time, ys_dev_cnt, user_add_day, dt"
    opts = jdbc.jdbc_options("jdbc:mysql://h/db", user="u", password="p", fetch_size=500)
    assert opts["fetchsize"] == "500" and opts["pushDownPredicate"] == "true"


def test_table_list_parsing():
    assert parse_table_list(" pay, user_info ,,x") == ["pay", "user_info", "x"]


def test_failed_lines_with_line_breaks_and_record_text(spark):
    from relaykit.sources import logs
    head = "2024-02-01 00:00:00.000 - FAILED: table=pay, dt=2024-01-01, user=us***, "
    rows = [(head + 'reason=HTTP 500: a\nb, record={"x":", record={1}"}',), (head + "reason=r, record=null",)]
    got = logs.parse_failed(spark.createDataFrame(rows, "value string")).collect()
    assert [(r.reason, r.record_json) for r in got] == [("HTTP 500: a\nb", '{"x":", record={1}"}'), ("r", "null")]
    made = spark.createDataFrame([("FAILED: a\r\nb",)], "m string").select(
        logs.failed_file_line(F.lit("t"), F.col("m")).alias("v")).first().v
    assert made == "t - FAILED: a\\r\\nb"
