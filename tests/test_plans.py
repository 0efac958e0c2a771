import os
import tempfile

from pyspark.sql import functions as F

from relaykit.registry import REGISTRY
from relaykit.sources.tables import date_range, driver_table, read_partitioned

SF = "/root/testdata/sf0.001"


def test_partition_filter_and_column_pruning(spark):
    out = tempfile.mkdtemp(prefix="relaykit-test-")
    src = driver_table(spark, SF, "element_click")
    src.write.mode("overwrite").partitionBy("dt").parquet(f"{out}/element_click")
    df = read_partitioned(spark, f"{out}/element_click", REGISTRY.get("element_click"), date_range("2024-01-05", "2024-01-06"))
    plan = df.select("user_unique_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "2024-01-05" in plan
    assert "ReadSchema: struct<user_unique_id:string>" in plan
    assert df.count() == src.where(date_range("2024-01-05", "2024-01-06")).count()
    # dt stays a string; a malformed date matches nothing instead of failing
    assert dict(df.dtypes)["dt"] == "string"
    bad = read_partitioned(spark, f"{out}/element_click", REGISTRY.get("element_click"), "2024/01/05")
    assert bad.count() == 0
    assert os.path.isdir(out)


def test_no_unpartitioned_window_in_run(spark):
    from relaykit.plans import catalog
    df = catalog.QUERIES["outbox_all"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window [" not in plan or "SinglePartition" not in plan
