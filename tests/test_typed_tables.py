"""Field types, unknown tables, footer counts, VARIANT and observed metrics."""
import decimal

import pytest
from pyspark.sql import functions as F

from relaykit.functions import jsonfn
from relaykit.operators import audit, transform
from relaykit.plans import catalog, metrics
from relaykit.plans.report_run import ReportRun, RunConfig
from relaykit.registry import REGISTRY, Registry, TableSpec
from relaykit.sources import footers
from relaykit.sources.tables import read_partitioned, table_schema
from relaykit.streaming import runner

SF = "/root/testdata/sf0.001"


def test_field_types(spark):
    spec = TableSpec("sold", "sold", ("price", "n"), field_types=(("price", "decimal(8,3)"), ("et", "timestamp")))
    types = {f.name: f.dataType.simpleString() for f in table_schema(spec)}
    assert types == {"event_id": "bigint", "user_unique_id": "string", "et": "timestamp", "price": "decimal(8,3)", "n": "string", "dt": "string"}
    with pytest.raises(ValueError, match="does not have: nope"):
        TableSpec("sold", "sold", ("price",), field_types=(("nope", "int"),))
    own, path = Registry(), runner.scratch_path(spark, "t-sold")
    own.register(spec)
    row = spark.createDataFrame([(1, "u", decimal.Decimal("1.250"), None, "2024-01-01")], "event_id long, user_unique_id string, price decimal(8,3), n string, dt string")
    row.write.partitionBy("dt").parquet(path)
    got = transform.payloads_all({"sold": read_partitioned(spark, path, spec)}, 5, own).first()
    assert got.params == '{"report_type":"poc_v1","price":1.250}' and got.local_time_ms == 5


def test_unknown_table_is_kept_apart(spark):
    known = spark.createDataFrame([(1, "2024-01-01", "user_1", 7, "p0", "p1")], "event_id long, dt string, user_unique_id string, et long, refer_page_id string, page_id string")
    bare = spark.createDataFrame([("x",), (None,)], "anything string")  # no key, no user, no date
    odd = spark.createDataFrame([(3, "2024-01-01", "user_12345678", "1")], "event_id long, dt string, user_unique_id string, `a.b` string")
    tables = {"page_vidw": known, "bare": bare, "odd": odd}
    with pytest.raises(ValueError, match="Unknown table name: bare"):
        ReportRun(spark, tables, RunConfig(ingest_ms=1)).payloads
    run = ReportRun(spark, tables, RunConfig(ingest_ms=1, reject_unknown=True))
    assert [(r.table_name, r.n_records) for r in run.outbox.collect()] == [("page_vidw", 1)]
    dead = sorted((r.table_name, r.reason, r.record_json_raw) for r in run.dead_letters.collect())
    assert dead == [("bare", "Unknown table name: bare", '{"anything":"x"}'), ("bare", "Unknown table name: bare", '{"anything":null}'),
                    ("odd", "Unknown table name: odd", '{"event_id":3,"dt":"2024-01-01","user_unique_id":"user_12345678","a.b":"1"}')]
    totals = {(r.table_name): (r.total, r.fail, r.unsent) for r in run.table_results.collect() if r.table_name != "bare"}
    assert totals == {"page_vidw": (1, 0, 1), "odd": (1, 1, 0)}


def test_footer_counts_read_no_column(spark):
    base = runner.scratch_path(spark, "t-foot")
    tables = catalog._tables(spark, SF, "month")
    for name in ("pay", "page_vidw"):
        tables[name].repartition("dt").write.partitionBy("dt").parquet(f"{base}/{name}")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    paths = {REGISTRY.get(n): f"{base}/{n}" for n in ("pay", "page_vidw", "user_info")}  # the last has no folder
    got = footers.partition_counts(spark, paths)
    want = audit.partition_counts({n: tables[n] for n in ("pay", "page_vidw")})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    one = footers.partition_counts(spark, paths, ["2024-01"]).collect()
    assert {r.dt for r in one} <= {"2024-01"} and footers.partition_counts(spark, paths, ["1999-01"]).collect() == []
    plan = footers.footer_counts(footers.footer_session(spark), f"{base}/pay", REGISTRY.get("pay"))._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [dt]" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_variant_keeps_nesting_and_types(spark):
    texts = ['{"a":{"b":[1,2.5,"x"]},"n":12345678901,"t":true,"z":null}', "[1]", "", None, "{broken", '"text"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", jsonfn.parse_variant(F.col("t")).alias("v"))
    f = jsonfn.variant_field
    got = {r.i: r for r in df.select("i", f(F.col("v"), "$.a.b[1]", "double").alias("half"), f(F.col("v"), "$.n", "bigint").alias("n"),
                                     f(F.col("v"), "$.n", "int").alias("narrow"), f(F.col("v"), "$.t", "boolean").alias("t"),
                                     F.to_json(f(F.col("v"), "$.a", "variant")).alias("a"), jsonfn.variant_kind(F.col("v")).alias("kind")).collect()}
    assert (got[0].half, got[0].n, got[0].narrow, got[0].t, got[0].a) == (2.5, 12345678901, None, True, '{"b":[1,2.5,"x"]}')
    assert [got[i].kind for i in (1, 2, 3, 4, 5)] == ["ARRAY<BIGINT>", None, None, None, "STRING"]
    assert got[1].n is None and got[4].n is None


def test_observed_metrics_equal_the_scanned_ones(spark):
    run, out = catalog._run(spark, SF), runner.scratch_path(spark, "t-acc")
    for _ in range(2):  # a second pass replaces the first
        got = {r.metric: r.value for r in metrics.write_observed(run, out).collect()}
    want = {r.metric: r.value for r in catalog.QUERIES["metrics_summary"](spark, SF).collect()}
    assert len(got) == 10 and {k: got[k] for k in want} == want and got["avg_query_ms"] > 0
    assert spark.read.parquet(f"{out}/record_outcomes").count() == want["records_processed"]


def test_observed_metrics_of_an_empty_run(spark):
    empty = catalog.driver_table(spark, SF, "pay").where("false")
    run = ReportRun(spark, {"pay": empty}, RunConfig(ingest_ms=1))
    got = {r.metric: r.value for r in metrics.write_observed(run, runner.scratch_path(spark, "t-acc0")).collect()}
    assert "avg_request_ms" not in got and "avg_batch_ms" not in got
    assert {v for k, v in got.items() if k != "avg_query_ms"} == {0.0}


def test_stream_over_files_and_a_restart(spark):
    rows = catalog.QUERIES["stream_epochs"](spark, SF)
    assert {r.run_id for r in rows.select("run_id").distinct().collect()} == {"run-0", "run-1", "run-2"}
