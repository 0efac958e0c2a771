"""Latest status and timers of a streamed status log against the batch rules."""
import datetime as dt

from pyspark.sql import functions as F

from relaykit.operators import status_log as sl
from relaykit.streaming import runner
from relaykit.streaming import status as st

T0 = dt.datetime(2024, 2, 1)


def _at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


# (table_name, id, seq, status, error_msg, updated_at, bump_retry), a list per epoch
EPOCHS = [
    [("a", 1, 1, 1, None, _at(0), False), ("a", 2, 1, 1, None, _at(0), False), ("a", 3, 1, 1, None, _at(0), False),
     (None, 4, 1, 1, None, _at(0), False), ("a", 1, 1, 1, None, _at(0), False)],                 # a repeated change
    [("a", 1, 2, 3, "HTTP 503", _at(1), True), ("a", 2, 2, 2, None, _at(1), False), ("a", 6, None, None, None, _at(2), False)],
    [("a", 1, 3, 1, None, _at(90), False), ("a", 5, 1, 1, None, _at(200), False)],               # 1 is taken up again
    [("a", 1, 4, 2, None, _at(100), False)],
]


def _stream(spark, epochs, end, older_than_s=3600, watermark="10 minutes"):
    src, out, ckpt = (runner.scratch_path(spark, n) for n in ("t-st-in", "t-st-out", "t-st-ckpt"))
    log = None
    for rows in epochs:  # a run per epoch: state and timers live on in the checkpoint
        part = spark.createDataFrame(rows, sl.STATUS_LOG_SCHEMA)
        part.coalesce(1).write.mode("append").parquet(src)
        log = part if log is None else log.unionByName(part)
        st.start_status_stream(spark.readStream.schema(part.schema).parquet(src), out, ckpt, older_than_s, watermark).awaitTermination()
    st.end_changes(log, src, end)
    st.start_status_stream(spark.readStream.schema(log.schema).parquet(src), out, ckpt, older_than_s, watermark).awaitTermination()
    return log, out


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_latest_and_stale_over_epochs(spark):
    log, out = _stream(spark, EPOCHS, "2024-02-01 05:00:00", watermark="200 minutes")
    latest = st.read_latest(spark, out)
    assert spark.read.parquet(out).select("epoch").distinct().count() >= 4
    cols = ("table_name", "id", "seq", "status", "error_msg", "updated_at", "first_at")
    batch = sl.latest_status(log)
    assert _rows(latest.select(*cols)) == _rows(batch.select(*cols))
    bumps = {(r.table_name, r.id): r.retry_bumps for r in latest.collect()}
    assert bumps == {(r.table_name, r.id): r.retry_bumps for r in batch.collect()}
    # the watermark ends at 01:40: 3 and the record without a table are over an hour in process, 5 is not yet
    now = F.to_timestamp(F.lit("2024-02-01 01:40:00"))
    at = batch.withColumnRenamed("status", "report_status")
    assert _rows(st.read_stale(spark, out).select("table_name", "id")) == _rows(sl.stale_processing(at, now).select("table_name", "id"))


def test_a_record_that_goes_on_is_no_longer_stale(spark):
    epochs = [[("a", 1, 1, 1, None, _at(0), False)], [("b", 9, 1, 2, None, _at(300), False)], [("a", 1, 2, 2, None, _at(301), False)]]
    _, out = _stream(spark, epochs, "2024-02-02 00:00:00")
    kinds = {(r.id, r.kind) for r in spark.read.parquet(out).collect()}
    assert (1, "stale") in kinds                          # its timer ran out when the watermark passed
    assert st.read_stale(spark, out).collect() == []      # but it went on since
    assert spark.conf.get(st.PROVIDER) != st.ROCKSDB      # the caller's setting is back


def test_timers_are_sessions_of_spark_and_rows_leave_no_python(spark, tmp_path):
    log = spark.createDataFrame([], sl.STATUS_LOG_SCHEMA)
    log.write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "log"))
    for df in (st.latest_changes(stream), st.expired_timers(stream)):
        assert "InPandas" not in df._jdf.queryExecution().analyzed().toString()


def test_a_repeated_seq_starts_its_timer_anew(spark):
    epochs = [[("a", 1, 1, 1, None, _at(0), False), ("a", 2, 1, 1, None, _at(0), False)],
              [("a", 1, 1, 1, None, _at(200), False), ("b", 9, None, 2, None, _at(200), False)], [("a", 7, 1, 1, None, _at(201), False)]]
    _, out = _stream(spark, epochs, "2024-02-01 03:30:00")
    assert {r.id for r in st.read_stale(spark, out).collect()} == {2}  # the watermark ends at 03:20
    assert {(r.id, r.updated_at) for r in st.read_latest(spark, out).collect()} >= {(1, _at(200)), (2, _at(0)), (7, _at(201))}
