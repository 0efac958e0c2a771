"""Production layout end to end: tables written as dt-partitioned parquet,
reported through the CLI entry points; a rerun replaces its own outputs."""
import tempfile

from pyspark.sql import functions as F

from relaykit import cli
from relaykit.operators import delivery
from relaykit.plans import catalog
from relaykit.plans.report_run import DEFAULT_INGEST_MS
from relaykit.sources.tables import date_range, driver_tables

SF = "/root/testdata/sf0.001"


def _write_layout(spark, drop=()):
    root = tempfile.mkdtemp(prefix="relaykit-root-")
    for name, df in driver_tables(spark, SF).items():
        df.drop(*drop).write.mode("overwrite").partitionBy("dt").parquet(f"{root}/{name}")
    return root


def test_report_over_partitioned_tables(spark):
    root = _write_layout(spark)
    out = tempfile.mkdtemp(prefix="relaykit-out-")
    dates = date_range("2024-01-01", "2024-01-31")
    s1 = {r.dt: (r.total, r.success, r.fail) for r in
          cli.run_report(spark, root, out, dates, ingest_ms=DEFAULT_INGEST_MS).where(F.col("level") == "date").collect()}
    outbox = spark.read.parquet(f"{out}/outbox")
    expected = catalog.QUERIES["outbox_all"](spark, SF)
    cols = ["table_name", "dt", "request_no", "endpoint", "n_records", "body"]
    assert sorted(map(tuple, outbox.select(*cols).collect())) == sorted(map(tuple, expected.select(*cols).collect()))
    # rerun of the same run id: same files replaced, not duplicated
    cli.run_report(spark, root, out, dates)
    assert spark.read.parquet(f"{out}/outbox").count() == expected.count()
    assert sum(v[0] for v in s1.values()) == 1000
    assert sum(v[1] + v[2] for v in s1.values()) == 0  # no transport: nothing sent yet


def test_stats_one_date_includes_zero_tables(spark):
    root = _write_layout(spark)
    rows = cli.stats(spark, root, "2024-01-03").collect()
    names = [r.table_name for r in sorted(rows, key=lambda r: r.ordinal)]
    assert names == ["page_vidw", "element_click", "pay", "pay_result", "user_info", "TOTAL"]
    by = {r.table_name: r.n for r in rows}
    assert by["TOTAL"] == sum(v for k, v in by.items() if k != "TOTAL")


def test_main_stats_and_properties(spark, capsys, tmp_path):
    root = _write_layout(spark)
    assert cli.main(["stats", "--root", root, "--date", "2024-01-03"]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert len(lines) == 6 and lines[-1].startswith("2024-01-03   TOTAL")
    props = tmp_path / "job.properties"
    props.write_text("event.tables=pay,user_info\nbatch.report.size=10\nreport.mode.pay=batch\n")
    out = tmp_path / "out"
    assert cli.main(["once", "--root", root, "--out", str(out), "--date", "2024-01-03",
                     "--properties", str(props)]) == 0
    ob = spark.read.parquet(f"{out}/outbox")
    assert {r.table_name for r in ob.select("table_name").distinct().collect()} == {"pay", "user_info"}
    assert {r.endpoint for r in ob.collect()} == {"/v2/event/list"}  # pay overridden to BATCH
    assert max(r.n_records for r in ob.collect()) <= 10


def test_tables_without_a_row_id(spark):
    root, out = _write_layout(spark, ["event_id"]), tempfile.mkdtemp(prefix="relaykit-out-")
    dates = date_range("2024-01-01", "2024-01-31")
    s = cli.run_report(spark, root, out, dates, ingest_ms=DEFAULT_INGEST_MS)
    assert s.where("level = 'all'").select("total", "fail").first() == (1000, 0)
    ob = spark.read.parquet(f"{out}/outbox")
    expected = catalog.QUERIES["outbox_all"](spark, SF)
    single = F.col("endpoint") == "/v2/event/json"
    bodies = [sorted(r.body for r in df.where(single).select("body").collect()) for df in (ob, expected)]
    assert bodies[0] == bodies[1]
    assert ob.select("table_name", "dt", "request_no").distinct().count() == ob.count() == expected.count()


def test_copies_of_one_row_get_keys_of_their_own(spark):
    from relaykit.sources import tables
    df = spark.range(10_000).select(F.lit("u").alias("user_unique_id"), F.lit(None).cast("long").alias("et"))
    keyed = tables.with_row_key(df)
    assert keyed.columns == ["event_id", "user_unique_id", "et"]
    assert keyed.count() == keyed.select("event_id").distinct().count() == 10_000


def test_rerun_of_one_table_leaves_the_others(spark):
    root, out = _write_layout(spark), tempfile.mkdtemp(prefix="relaykit-out-")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    cli.run_report(spark, root, out, "2024-01-03")
    before = spark.read.parquet(f"{out}/outbox").count()
    cli.run_report(spark, root, out, "2024-01-03", tables="pay")
    assert spark.read.parquet(f"{out}/outbox").count() == before
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_rerun_takes_old_dead_letters_away(spark, tmp_path):
    root, out = _write_layout(spark), str(tmp_path / "out")
    dates = "2024-01-03"
    cli.run_report(spark, root, out, dates, run_id="r")

    def log(status, run="r"):
        path = tempfile.mkdtemp(prefix="relaykit-log-")
        ob = spark.read.parquet(f"{out}/outbox").where("run_id = 'r'")  # a rerun replaces its files
        rows = ob.select(F.lit(run).alias("run_id"), "table_name", "dt", "request_no", F.lit(1).alias("attempt"),
                         F.lit(status).alias("http_status"), F.lit("{}").alias("body"),
                         F.lit(None).cast("string").alias("transport_error"),
                         F.lit("2024-02-01").cast("timestamp").alias("started_at"), F.lit(5).cast("long").alias("duration_ms"))
        rows.select(*delivery.ATTEMPT_SCHEMA.fieldNames()).write.mode("overwrite").parquet(path)
        return path

    bad = cli.run_report(spark, root, out, dates, run_id="r", attempt_log=log(500))
    n = bad.where("level = 'date'").first().fail
    assert n > 0 and spark.read.parquet(f"{out}/dead_letters").count() == n
    good = cli.run_report(spark, root, out, dates, run_id="r", attempt_log=log(200))
    assert good.where("level = 'date'").first().fail == 0
    schema = "reason string, run_id string, table_name string, dt string"
    assert spark.read.schema(schema).parquet(f"{out}/dead_letters").count() == 0
    # attempts of another run are not this run's
    other = cli.run_report(spark, root, out, dates, run_id="r", attempt_log=log(200, "s"))
    assert other.where("level = 'date'").select("success", "fail").first() == (0, 0)


def test_processing_time_is_the_time_of_the_run(spark, tmp_path):
    import time
    root, start = _write_layout(spark), int(time.time() * 1000)
    cli.run_report(spark, root, str(tmp_path), "2024-01-03", tables="user_info")
    ms = spark.read.parquet(f"{tmp_path}/outbox").select(
        F.explode(F.expr("regexp_extract_all(body, 'local_time_ms\":([0-9]+)', 1)")).alias("t"))
    got = ms.select(F.col("t").cast("long")).agg(F.min("t"), F.max("t")).first()
    assert start <= got[0] == got[1] <= int(time.time() * 1000)


def test_date_without_rows_has_zeros(spark, capsys, tmp_path):
    root = _write_layout(spark)
    assert cli.main(["stats", "--root", root, "--date", "1999-12-31"]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert len(lines) == 6 and all(x.endswith(": 0") for x in lines)
    assert cli.main(["once", "--root", root, "--out", str(tmp_path), "--date", "1999-12-31"]) == 0
    assert capsys.readouterr().out.strip() == "1999-12-31 Summary: total=0, success=0, fail=0"


def test_write_of_uncached_run_is_complete(spark, tmp_path):
    from relaykit.plans.report_run import ReportRun, RunConfig
    run = ReportRun(spark, driver_tables(spark, SF), RunConfig(run_id="r1"))
    run.write(str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/members").count() == 1000
    tr = spark.read.parquet(f"{tmp_path}/table_results")
    assert tr.agg(F.sum("total")).first()[0] == 1000
    assert not run.assigned.is_cached
