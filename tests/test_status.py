from pyspark.sql import functions as F

from relaykit.operators import status_log as sl
from relaykit.operators import transform
from relaykit.registry import REGISTRY

# the three seed rows of the status-tracked schema, all pending
SEED = [(1, "user_001", "home", "product_list"), (2, "user_002", "search", "product_detail"),
        (3, "user_003", "product_list", "checkout")]


def seed(spark):
    rows = [("page_vidw", i, u, None, r, p, 0, 0) for i, u, r, p in SEED]
    return spark.createDataFrame(rows, "table_name string, id long, user_unique_id string, et long, "
                                       "refer_page_id string, page_id string, report_status int, retry_count int") \
                .withColumn("updated_at", F.to_timestamp(F.lit("2024-01-01 00:00:00"))) \
                .withColumn("dt", F.lit("2024-01-01"))


def test_seed_rows_flow(spark):
    base = seed(spark)
    page = sl.pending_scan(base, 0, 2)
    assert [r.id for r in page.orderBy("id").collect()] == [1, 2]
    spec = REGISTRY.get("page_vidw")
    p = transform.to_payloads(transform.project(page, spec, ("id",)), spec, 42, key_cols=("id",)).collect()
    assert {r.params for r in p} == {'{"report_type":"poc_v1","refer_page_id":"home","page_id":"product_list"}',
                                     '{"report_type":"poc_v1","refer_page_id":"search","page_id":"product_detail"}'}
    t0 = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    log = sl.status_changes(page.select("table_name", "id"), sl.PROCESSING, 1, t0) \
        .unionByName(sl.status_changes(page.where(F.col("id") == 1).select("table_name", "id"), sl.SUCCESS, 2, t0)) \
        .unionByName(sl.status_changes(page.where(F.col("id") == 2).select("table_name", "id"), sl.FAILED, 2, t0,
                                       error=F.lit("x" * 600), bump_retry=True))
    cur = {r.id: r for r in sl.apply_status(base, log).collect()}
    assert cur[1].report_status == 2 and cur[1].retry_count == 0
    assert cur[2].report_status == 3 and cur[2].retry_count == 1 and len(cur[2].error_msg) == 500
    assert cur[3].report_status == 0
    # bulk failed without error does not bump retry_count
    bulk = sl.status_changes(base.where(F.col("id") == 3).select("table_name", "id"), sl.FAILED, 1, t0)
    assert sl.apply_status(base, bulk).where(F.col("id") == 3).first().retry_count == 0
    prog = sl.task_progress(log).first()
    assert prog.last_processed_id == 2 and prog.success_count == 1 and prog.fail_count == 1
    assert [r.id for r in sl.incremental_pending(base, sl.task_progress(log)).collect()] == [3]


def test_id_membership(spark):
    base = seed(spark)
    ids = spark.createDataFrame([("page_vidw", 2), ("page_vidw", 9), ("pay", 1)], "table_name string, id long")
    assert [r.id for r in sl.rows_with_ids(base, ids).collect()] == [2]
    none = spark.createDataFrame([], "table_name string, id long")
    assert sl.rows_with_ids(base, none).count() == 0


def test_stale_processing_reset(spark):
    base = seed(spark).withColumn("report_status", F.when(F.col("id") == 2, 1).otherwise(F.col("report_status")))
    now = F.to_timestamp(F.lit("2024-01-01 05:00:00"))
    assert [r.id for r in sl.stale_processing(base, now).collect()] == [2]
    # numbered after the change that locked the row
    t0 = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    log = sl.status_changes(base.where("id = 2"), sl.PROCESSING, 1, t0)
    both = log.unionByName(sl.reset_stale(base, now, log=log))
    assert sl.apply_status(base, both).where("id = 2").first().report_status == 0
    reset = sl.reset_stale(base, now)
    assert sl.apply_status(base, reset).where(F.col("id") == 2).first().report_status == 0


def test_last_error_stays_and_progress_starts_with_the_first_change(spark):
    ids = spark.createDataFrame([("pay", 1)], "table_name string, id long")
    at = [F.to_timestamp(F.lit(f"2024-02-01 00:0{i}:00")) for i in range(3)]
    log = sl.status_changes(ids, sl.PROCESSING, 1, at[0]) \
        .unionByName(sl.status_changes(ids, sl.FAILED, 2, at[1], error=F.lit("HTTP 503"), bump_retry=True))
    assert str(sl.task_progress(log).first().start_time) == "2024-02-01 00:00:00"
    again = log.unionByName(sl.status_changes(ids, sl.PROCESSING, 3, at[2]))
    got = sl.latest_status(again).first()
    assert (got.status, got.error_msg, got.seq) == (sl.PROCESSING, "HTTP 503", 3)


def test_pending_scan_from_checkpoint_table(spark):
    base = seed(spark)
    last = spark.createDataFrame([("page_vidw", 1), ("page_vidw", 0), ("pay", 9)], "table_name string, last_id long")
    assert [r.id for r in sl.pending_scan(base, last, 10).orderBy("id").collect()] == [2, 3]
