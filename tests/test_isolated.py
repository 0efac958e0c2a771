"""Tables that fail, hang or cannot be read leave the others alone."""
import os

from pyspark.sql import functions as F

from relaykit.plans.isolated import IsolatedRun
from relaykit.plans.report_run import DEFAULT_INGEST_MS, RunConfig
from relaykit.sources.tables import driver_tables, read_partitioned
from relaykit.registry import REGISTRY

SF = "/root/testdata/sf0.001"


def test_damaged_files_leave_four_tables(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    for name, df in driver_tables(spark, SF).items():
        df.coalesce(1).write.partitionBy("dt").parquet(f"{root}/{name}")
    part = next(d for d in sorted(os.listdir(root / "pay")) if d.startswith("dt="))
    for f in os.listdir(root / "pay" / part):
        if f.endswith(".parquet"):
            (root / "pay" / part / f).write_bytes(b"no parquet")
            (root / "pay" / part / f".{f}.crc").unlink(missing_ok=True)
    tables = {n: (lambda n=n: read_partitioned(spark, f"{root}/{n}", REGISTRY.get(n))) for n in REGISTRY.names()}
    run = IsolatedRun(spark, tables, RunConfig(run_id="r", ingest_ms=DEFAULT_INGEST_MS), write_to=out)
    rows = run.run().collect()
    assert [f.table_name for f in run.failures] == ["pay"]
    errors = [r for r in rows if r.level == "error"]
    assert [(r.table_name, r.total, r.success, r.fail) for r in errors] == [("pay", 0, 0, 1)] and errors[0].error
    assert {r.table_name for r in rows if r.level == "table"} == set(REGISTRY.names()) - {"pay"}
    whole = spark.read.parquet(f"{SF}/events.parquet")
    good = whole.where("event_type <> 'purchase'").count()
    top = next(r for r in rows if r.level == "all")
    assert (top.total, top.fail, top.line) == (good, 1, f"Summary: total={good}, success=0, fail=1")
    written = spark.read.parquet(f"{out}/members")
    assert written.count() == good and written.where("table_name = 'pay'").count() == 0


def test_reader_that_fails_and_all_tables_failing(spark):
    def broken():
        raise OSError("no such folder")
    run = IsolatedRun(spark, {"pay": broken}, RunConfig(run_id="r"))
    rows = run.run().collect()
    assert [(r.table_name, r.fail, r.error) for r in rows if r.level == "error"] == [("pay", 1, "no such folder")]
    assert [(r.total, r.fail) for r in rows if r.level == "all"] == [(0, 1)]


def test_table_that_takes_too_long_is_cancelled_by_its_tag(spark):
    tables = driver_tables(spark, SF, names=["user_info"])

    def sleeps(batches):
        import time
        for b in batches:
            time.sleep(600)
            yield b
    slow = driver_tables(spark, SF, names=["pay"])["pay"]
    tables["pay"] = slow.mapInPandas(sleeps, slow.schema)
    run = IsolatedRun(spark, tables, RunConfig(run_id="r", ingest_ms=DEFAULT_INGEST_MS), timeout_s=60)
    rows = run.run().collect()
    assert [f.table_name for f in run.failures] == ["pay"] and "cancel" in run.failures[0].error.lower()
    assert {r.table_name for r in rows if r.level == "table"} == {"user_info"}
    assert spark.range(3).select(F.sum("id")).first()[0] == 3  # the session lives on
