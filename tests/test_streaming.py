import os

from pyspark.sql import functions as F

from relaykit.plans import catalog
from relaykit.streaming import runner

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_outbox_equals_batch(spark):
    stream = catalog.QUERIES["stream_outbox"](spark, SF)
    batch = catalog.QUERIES["outbox_all"](spark, SF)
    assert {r.run_id for r in stream.select("run_id").distinct().collect()} == {"run-0"}
    cols = sorted(set(batch.columns) - {"run_id"})
    assert _rows(stream.select(*cols)) == _rows(batch.select(*cols))


def test_minute_rates_equal_batch(spark):
    stream = _rows(catalog.QUERIES["stream_rate_metrics"](spark, SF))
    assert stream and stream == _rows(catalog.QUERIES["processing_rate"](spark, SF))


def test_minute_rates_over_epochs_and_open_minutes(spark):
    att = catalog._run(spark, SF).attempts
    log, out, ckpt = (runner.scratch_path(spark, n) for n in ("t-log", "t-rates", "t-rates-ckpt"))
    for part in (F.col("attempt") == 1, F.col("attempt") > 1):  # both epochs change the same minutes
        att.where(part).write.mode("append").parquet(log)
        runner.start_rate_stream(spark.readStream.schema(att.schema).parquet(log), out, ckpt,
                                 "30 days").awaitTermination()
    assert _rows(runner.latest_rates(spark, out)) == _rows(catalog.QUERIES["processing_rate"](spark, SF))


def test_requests_of_two_epochs_never_mix(spark):
    from relaykit.sources.tables import events_view, load, tables_from_events
    src, out = runner.scratch_path(spark, "t-two"), runner.scratch_path(spark, "t-two-out")
    ev = load(spark, SF, "events")
    for odd in (0, 1):
        ev.where(F.col("event_id") % 2 == odd).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    runner.start_report_stream(stream, lambda b: tables_from_events(events_view(b)), out,
                               runner.scratch_path(spark, "t-two-ckpt")).awaitTermination()
    ob = spark.read.parquet(f"{out}/outbox")
    assert ob.select("epoch").distinct().count() == 2
    assert ob.select("run_id", "table_name", "dt", "request_no").distinct().count() == ob.count()


def test_stream_rerun_without_new_input_emits_nothing(spark):
    out = runner.scratch_path(spark, "t-out")
    ckpt = runner.scratch_path(spark, "t-ckpt")
    from relaykit.sources.tables import events_view, tables_from_events
    src = catalog._events_stream(spark, SF)
    for _ in range(2):
        q = runner.start_report_stream(src, lambda b: tables_from_events(events_view(b)), out, ckpt)
        q.awaitTermination()
    epochs = spark.read.parquet(f"{out}/outbox").select("epoch").distinct().count()
    assert epochs == 1


def test_dedupe_stream_drops_repeats(spark):
    base = catalog._run(spark, SF).payloads.select("table_name", "dt", "user_unique_id", "et", "local_time_ms",
                                                   "params").limit(50)
    path = runner.scratch_path(spark, "dup-src")
    base.unionByName(base).withColumn("ts", F.timestamp_millis("local_time_ms")).write.parquet(path)
    src = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    out = runner.scratch_path(spark, "dup-out")
    q = (runner.dedupe_stream(src, "ts").writeStream.format("parquet")
         .option("checkpointLocation", runner.scratch_path(spark, "dup-ckpt"))
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == base.distinct().count()


def test_stream_writes_dead_letters_and_results(spark):
    from relaykit.sources.tables import events_view, tables_from_events
    out = runner.scratch_path(spark, "t-out2")
    q = runner.start_report_stream(catalog._events_stream(spark, SF), lambda b: tables_from_events(events_view(b)),
                                   out, runner.scratch_path(spark, "t-ckpt2"))
    q.awaitTermination()
    tr = spark.read.parquet(f"{out}/table_results")
    assert tr.agg(F.sum("total")).first()[0] == 1000
    assert tr.agg(F.sum("unsent")).first()[0] == 1000
    dl_schema = ("run_id string, table_name string, dt string, user_masked string, reason string, "
                 "record_json string, record_json_raw string, epoch int")
    assert spark.read.schema(dl_schema).parquet(f"{out}/dead_letters").count() == 0


def _files(path):
    return {f for f in os.listdir(path) if f.endswith(".parquet")}


def test_an_arrival_is_written_by_every_task(spark, tmp_path):
    rows, at = spark.range(0, 4000, 1, 4), str(tmp_path / "rows")
    found = [_files(at) for _ in catalog._arrivals(rows, at, [F.col("id") % 2 == 0, F.col("id") % 2 == 1])]
    assert [len(f) for f in found] == [4, 8]
    assert sorted(r.id for r in spark.read.parquet(at).collect()) == list(range(4000))


def test_parts_in_the_order_of_time_are_written_by_every_task(spark, tmp_path):
    rows, at = spark.range(0, 3000, 1, 6).withColumn("at", F.timestamp_seconds("id")), str(tmp_path / "rows")
    before, tops = set(), []
    for _ in catalog._in_parts(rows, "at", at, 3):
        new, before = _files(at) - before, _files(at)
        assert len(new) >= 2
        tops.append(spark.read.parquet(at).agg(F.max("id")).first()[0])
    assert tops == [999, 1999, 2999] and spark.read.parquet(at).count() == 3000


def test_a_stream_of_several_files_dedupes_by_arrival(spark, monkeypatch):
    paths, real = {}, runner.scratch_path
    monkeypatch.setattr(runner, "scratch_path", lambda s, name: paths.setdefault(name, real(s, name)))
    got = catalog.QUERIES["stream_dedupe"](spark, SF)
    assert got.count() == got.distinct().count() == 1000
    assert len(_files(paths["keys-in"])) > 4  # four arrivals
