"""Rows whose group is null are numbered and accounted for like any others."""
import pytest
from pyspark.sql import functions as F

from relaykit.operators.audit import dead_letters, table_results
from relaykit.operators.ordinal import with_ordinal


@pytest.mark.parametrize("bucket_rows", [5, 1 << 20])
def test_ordinal_keeps_null_groups(spark, bucket_rows):
    df = spark.range(40).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.lit("2024-01-01")).alias("dt"))
    got = with_ordinal(df, ["dt"], "id", bucket_rows=bucket_rows).collect()
    assert sorted((r.dt or "", r.ord) for r in got) == sorted((d, i) for d in ("", "2024-01-01") for i in range(20))


def test_table_results_count_null_dates(spark):
    counts = spark.createDataFrame([("t", None, 2)], "table_name string, dt string, n long")
    records = spark.createDataFrame([("t", None, "success"), ("t", None, "failed")], "table_name string, dt string, status string")
    row = table_results(counts, records).collect()[0]
    assert (row.total, row.success, row.fail) == (2, 1, 1)


def test_dead_letters_mask_ids_with_any_characters(spark):
    ids = ["ab$cdefghijk", 'ab"cdefghijk', "ab\\cdefghijk", None, "ab$1cdefgh\\ijk"]
    rows = spark.createDataFrame([("t", "d", i, "failed", "r") for i in ids], "table_name string, dt string, user_unique_id string, status string, reason string")
    rows = rows.withColumn("record_json", F.to_json(F.struct(F.lit(1).alias("a"), "user_unique_id", F.lit("z").alias("b"))))
    for r in dead_letters(rows).collect():
        assert "cdefgh" not in r.record_json
        assert spark.createDataFrame([(r.record_json,)], "j string").select(F.from_json("j", "a int, b string").alias("x")).first().x == (1, "z")
