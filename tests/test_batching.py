import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from relaykit.operators import batching
from relaykit.operators.ordinal import with_ordinal
from relaykit.registry import BATCH, SINGLE


def modes_df(spark, mode):
    return spark.createDataFrame([("t", mode)], "table_name string, mode string")


def payload_rows(spark, n, dt="d", start=0, step=1, bad=()):
    rows = [("t", dt, start + i * step, "u", "{}", ("Transform failed" if i in bad else None), f"b{i}")
            for i in range(n)]
    return spark.createDataFrame(rows, "table_name string, dt string, event_id long, user_unique_id string, "
                                       "params string, error string, body string")


def brute_force_ord(df, key="event_id"):
    w = Window.partitionBy("table_name", "dt").orderBy(key)
    return {r[key]: r.o for r in df.select(key, (F.row_number().over(w) - 1).alias("o")).collect()}


@pytest.mark.parametrize("bucket_rows", [1 << 20, 7, 64])
def test_ordinal_matches_brute_force(spark, bucket_rows):
    df = payload_rows(spark, 500, step=3).unionByName(payload_rows(spark, 130, dt="e", start=5))
    got = {r.event_id: r.ord for r in with_ordinal(df, ["table_name", "dt"], "event_id",
                                                   bucket_rows=bucket_rows).collect() if r.dt == "d"}
    assert got == {k: v for k, v in brute_force_ord(df.where(F.col("dt") == "d")).items()}


def test_ordinal_refines_clustered_keys(spark):
    # 200 keys packed at the bottom of a huge range, one far away: the first
    # equal-width bucket is hot and must be split into finer ranges
    dense = payload_rows(spark, 200, start=0)
    far = payload_rows(spark, 1, start=10_000_000)
    df = dense.unionByName(far)
    got = {r.event_id: r.ord for r in with_ordinal(df, ["table_name", "dt"], "event_id", bucket_rows=4).collect()}
    assert got == brute_force_ord(df)


@pytest.mark.parametrize("n", [0, 1, 19, 20, 21, 1000, 1001, 2500])
@pytest.mark.parametrize("size", [1, 20, 30, 50])
def test_chunking_invariants(spark, n, size):
    if n == 0:
        df = payload_rows(spark, 1).where(F.lit(False))
    else:
        df = payload_rows(spark, n)
    a = batching.assign_requests(df, modes_df(spark, BATCH), batch_size=size, may_have_errors=False)
    rows = a.select("ord", "page_no", "request_no").collect()
    assert len(rows) == n
    sizes = {}
    pages = {}
    for r in rows:
        sizes[r.request_no] = sizes.get(r.request_no, 0) + 1
        pages.setdefault(r.request_no, set()).add(r.page_no)
    assert sum(sizes.values()) == n
    assert all(1 <= s <= size for s in sizes.values())
    assert all(len(p) == 1 for p in pages.values())  # never crosses a page
    per_page = math.ceil(1000 / size)
    expected = sum(math.ceil(min(1000, n - p * 1000) / size) for p in range(math.ceil(n / 1000)))
    assert len(sizes) == expected
    plan = batching.request_plan(spark.createDataFrame([("t", "d", n)], "table_name string, dt string, n long"),
                                 modes_df(spark, BATCH), batch_size=size).first()
    assert plan.best_calls == expected and plan.worst_calls == 3 * expected
    assert per_page >= 1


def test_single_mode_one_request_per_row(spark):
    a = batching.assign_requests(payload_rows(spark, 45), modes_df(spark, SINGLE), may_have_errors=False)
    ob = batching.outbox(a)
    assert ob.count() == 45
    assert {r.endpoint for r in ob.collect()} == {"/v2/event/json"}


def test_bad_rows_keep_page_slot_but_no_batch_slot(spark):
    df = payload_rows(spark, 1010, bad={0, 1, 2, 1005})
    a = batching.assign_requests(df, modes_df(spark, BATCH), batch_size=20)
    rows = {r.event_id: r for r in a.collect()}
    assert rows[0].request_no is None and rows[1005].request_no is None
    assert rows[3].request_no == 0 and rows[22].request_no == 0 and rows[23].request_no == 1
    assert rows[999].page_no == 0 and rows[1000].page_no == 1
    assert rows[1000].request_no == 50  # page 1 starts at ceil(1000/20)
    ob = batching.outbox(a).collect()
    assert sum(r.n_records for r in ob) == 1010 - 4
    first = [r for r in ob if r.request_no == 0][0]
    assert first.body.startswith("[b3,b4,")


def test_batch_size_range():
    with pytest.raises(ValueError):
        batching.check_batch_size(51)
    with pytest.raises(ValueError):
        batching.check_batch_size(0)


def test_bucket_path_equals_window_path_on_driver_data(spark):
    from relaykit.plans.report_run import ReportRun, RunConfig
    from relaykit.sources.tables import driver_tables
    tables = driver_tables(spark, "/root/testdata/sf0.01", "month")
    cols = ["table_name", "dt", "event_id", "ord", "page_no", "request_no"]
    small = ReportRun(spark, tables, RunConfig(batch_size=30)).assigned.select(*cols)
    bucketed = ReportRun(spark, tables, RunConfig(batch_size=30, bucket_rows=97)).assigned.select(*cols)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, bucketed.collect()))
    plan = bucketed._jdf.queryExecution().executedPlan().toString()
    assert "_b0" in plan  # the bucketed plan was used


@pytest.mark.parametrize("bucket_rows", [1 << 20, 16, 2])
def test_ordinal_keeps_null_keys(spark, bucket_rows):
    rows = [("t", "d", None if i % 10 == 0 else i, i) for i in range(120)]
    df = spark.createDataFrame(rows, "table_name string, dt string, event_id long, tb long")
    out = with_ordinal(df, ["table_name", "dt"], "event_id", bucket_rows=bucket_rows, tiebreak=("tb",)).collect()
    assert len(out) == 120
    assert sorted(r.ord for r in out) == list(range(120))
    nulls = sorted(r.ord for r in out if r.event_id is None)
    assert nulls == list(range(12))  # nulls first


def test_single_row_without_key_is_failed_not_lost(spark):
    df = payload_rows(spark, 5).withColumn("event_id", F.when(F.col("event_id") == 2, None).otherwise(F.col("event_id")))
    a = {r.body: r for r in batching.assign_requests(df, {"t": SINGLE}, may_have_errors=False).collect()}
    assert len(a) == 5
    assert a["b2"].request_no is None and a["b2"].error == batching.MISSING_KEY
    assert batching.outbox(batching.assign_requests(df, {"t": SINGLE})).count() == 4


def test_page_bounded_batches_match_survey_probe(spark):
    """All five tables as BATCH, size 30, one month partition each at sf0.01:
    341 batches, equal to the call plan."""
    from relaykit.plans.report_run import ReportRun, RunConfig
    from relaykit.sources.tables import driver_tables
    run = ReportRun(spark, driver_tables(spark, "/root/testdata/sf0.01", "month"),
                    RunConfig(batch_size=30, mode_overrides={"pay": "BATCH", "pay_result": "BATCH"}))
    assert run.outbox.count() == 341
    assert run.plan.agg(F.sum("best_calls")).first()[0] == 341
