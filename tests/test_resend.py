"""Resend job: rounds to the fixpoint, given-up records, and a job that died."""
import pytest
from pyspark.sql import functions as F

from relaykit.operators import delivery
from relaykit.operators import status_log as sl
from relaykit.plans import resend


def rows(spark, n=40):
    return spark.createDataFrame([(i, f"user_{i:08d}", 3 if i % 4 else 0, i % 3, "p") for i in range(1, n + 1)],
                                 "id long, user_unique_id string, report_status int, retry_count int, page_id string")


def answers(codes):
    """Attempts that fail in the rounds given, for all requests."""
    def send(outbox, round_no):
        return outbox.select(F.col("run_id"), "table_name", "dt", "request_no", F.lit(1).alias("attempt"),
                             F.lit(codes[round_no - 1]).alias("http_status"), F.lit("x").alias("body"),
                             F.lit(None).cast("string").alias("transport_error"),
                             F.lit("2024-02-01").cast("timestamp").alias("started_at"), F.lit(1).cast("long").alias("duration_ms"))
    return send


def test_until_sent_or_given_up(spark, tmp_path):
    cfg = resend.ResendConfig(max_retry=3, max_attempts=1)
    tables = {"page_vidw": rows(spark), "pay": rows(spark, 7)}
    job = resend.Resend(spark, tables, str(tmp_path), answers([500, 200, 200]), 42, config=cfg)
    base = rows(spark).withColumn("table_name", F.lit("page_vidw")).unionByName(rows(spark, 7).withColumn("table_name", F.lit("pay")))
    got = {(r.table_name, r.id): r for r in resend.resend_result(job.run(), 3, base).collect()}
    failed = base.where("report_status = 3").collect()
    assert got.keys() == {(r.table_name, r.id) for r in failed}
    for r in failed:
        g = got[r.table_name, r.id]
        if r.retry_count == 2:  # one more failure and it is given up
            assert (g.rounds, g.report_status, g.retry_count, g.given_up) == (1, 3, 3, True)
        else:
            assert (g.rounds, g.report_status, g.retry_count, g.given_up) == (2, 2, r.retry_count + 1, False)
        assert g.error_msg == ("Max retries exceeded" if r.table_name == "pay" else "Batch report failed: HTTP 500: x")


def test_job_that_died_goes_on(spark, tmp_path):
    cfg = resend.ResendConfig(max_retry=5, max_attempts=1)
    tables = {"page_vidw": rows(spark)}
    calls = []

    def dies(outbox, round_no):
        calls.append(round_no)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return answers([500, 500, 200])(outbox, round_no)

    with pytest.raises(RuntimeError):
        resend.Resend(spark, tables, str(tmp_path), dies, 42, config=cfg).run()
    again = resend.Resend(spark, tables, str(tmp_path), dies, 42, config=cfg).run()
    assert calls == [1, 2, 2, 3]  # the finished first round is not sent again
    whole = resend.Resend(spark, tables, str(tmp_path / "whole"), answers([500, 500, 200, 200]), 42, config=cfg).run()
    cols = ["round", "table_name", "id", "seq", "status", "error_msg", "updated_at", "bump_retry"]
    assert sorted(map(str, again.select(*cols).collect())) == sorted(map(str, whole.select(*cols).collect()))
    # a finished job is read, not run
    resend.Resend(spark, tables, str(tmp_path), dies, 42, config=cfg).run().count()
    assert calls == [1, 2, 2, 3]


def test_log_before_the_job_and_a_real_transport(spark, tmp_path):
    t0 = F.lit("2024-01-01").cast("timestamp")
    ids = rows(spark).where("id in (4, 8)").withColumn("table_name", F.lit("page_vidw"))
    log = sl.status_changes(ids.where("id = 4"), sl.FAILED, 7, t0, error=F.lit("x"), bump_retry=True) \
        .unionByName(sl.status_changes(ids.withColumn("id", F.lit(1).cast("long")).limit(1), sl.SUCCESS, 3, t0))
    cfg = resend.ResendConfig(max_retry=3)
    job = resend.Resend(spark, {"page_vidw": rows(spark)}, str(tmp_path),
                        resend.transport_sender(lambda endpoint, body: (200, "{}"), cfg), 42, log=log, config=cfg)
    done = job.run()
    assert done.where("status = 2").count() == done.select("id").distinct().count() == 30  # id 4 now, id 1 no more
    assert done.where("id = 4").agg(F.min("seq"), F.max("seq")).first() == (8, 9)
    assert done.where("id = 1").count() == 0
    now = sl.apply_status(rows(spark).withColumn("table_name", F.lit("page_vidw")).withColumn("updated_at", t0), log.unionByName(done.drop("round")))
    assert now.where("report_status = 3").count() == 0


def test_nothing_to_send_and_unknown_table(spark, tmp_path):
    none = rows(spark).where("id = 4")
    assert resend.Resend(spark, {"pay": none}, str(tmp_path), answers([]), 1).run().collect() == []
    with pytest.raises(ValueError, match="Unknown table name: nope"):
        resend.Resend(spark, {"nope": none}, str(tmp_path), answers([]), 1)
    assert delivery.MAX_ATTEMPTS == resend.ResendConfig().max_attempts
