"""Delivery key and duplicate handling (off by default: identical rows are
legal events). The key hashes what the API would see for one event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What stands between the key's parts, and for a null part.
KEY_SEP, KEY_NULL = "\u0001", "\u0002"


def delivery_key(table: Column | str = "table_name", dt: Column | str = "dt",
                 user: Column | str = "user_unique_id", et: Column | str = "et",
                 params: Column | str = "params") -> Column:
    """Hash of an event as its source wrote it: the event time is the raw ``et``,
    not the processing time that stands in for it, so a rerun has the same key."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (table, dt, user, et, params)]
    return F.sha2(F.concat_ws(KEY_SEP, *[F.coalesce(p.cast("string"), F.lit(KEY_NULL)) for p in parts]), 256)


def duplicate_groups(payloads: DataFrame) -> DataFrame:
    """Keys seen more than once per (table, dt), with their count. Grouped
    by the key itself, so a group is one event's copies."""
    k = payloads.select("table_name", "dt", delivery_key().alias("delivery_key"))
    return k.groupBy("table_name", "dt", "delivery_key").agg(F.count(F.lit(1)).alias("n")) \
            .where(F.col("n") > 1)


def drop_duplicate_events(payloads: DataFrame) -> DataFrame:
    """Keep one row per delivery key (opt-in)."""
    return payloads.withColumn("_dk", delivery_key()).dropDuplicates(["_dk"]).drop("_dk")


def not_yet_delivered(payloads: DataFrame, delivered_keys: DataFrame) -> DataFrame:
    """Rows whose key is not in an earlier run's delivered keys (plain
    anti-join; for the keys of all runs see :mod:`operators.delivered`)."""
    k = payloads.withColumn("delivery_key", delivery_key())
    return k.join(delivered_keys.select("delivery_key"), "delivery_key", "left_anti")
