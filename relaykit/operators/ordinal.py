"""Exact dense ordinal per group without a whole-group window.

``row_number() over (partition by table, dt order by key)`` puts a whole
(table, dt) into one task; one such group may hold a third of all rows.
Instead:

1. per group: count, min and max of the key (one tiny aggregate);
2. split each group's key range into ``ceil(n / bucket_rows)`` equal-width
   buckets, so a bucket holds about ``bucket_rows`` rows for a dense key;
3. count rows per (group, bucket) and prefix-sum those counts per group
   (a table of about rows / bucket_rows + groups rows);
4. join the offsets back and add ``row_number()`` within (group, bucket).

The result equals the global ordinal exactly, is deterministic on recompute
(the key is unique within a group; partition ids are never used) and each
window task sorts about ``bucket_rows`` rows. Buckets that still come out
oversized (keys clustered in a narrow range) are split into finer key ranges
until none is, so the order stays the key order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Offset tables up to this many rows are broadcast (a few tens of MB at
# most); beyond it, a shuffle join on (group, bucket), balanced by design.
BROADCAST_MAX_ROWS = 2_000_000
HOT_FACTOR = 4


def _null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal ``cols``, where null equals null; the left's columns stay."""
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(right, same, how).drop(*[f"_r_{c}" for c in cols])


def with_ordinal(df: DataFrame, group_cols: Sequence[str], key: str,
                 ord_col: str = "ord", bucket_rows: int = 1 << 20,
                 max_refine: int = 4, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Add ``ord_col``: 0-based rank of ``key`` within ``group_cols``.

    ``key`` must be integral; rows with equal keys are ordered by ``tiebreak``
    (give columns that make the order total for a reproducible result). Rows
    with a null key come first; no row is ever dropped.
    """
    g = list(group_cols)
    nb = F.greatest(F.ceil(F.col("_n") / F.lit(bucket_rows)), F.lit(1)).cast("long")
    width = (F.floor((F.col("_hi") - F.col("_lo")) / nb) + 1).cast("long")
    stats = (df.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.min(key).alias("_lo"),
                                F.max(key).alias("_hi"))
             .select(*g, "_n", "_lo", nb.alias("_nb"), width.alias("_w"))
             .persist())
    # one row per group (tables x dates of a run); its size is checked below
    top = stats.agg(F.max("_n").alias("max_n"), F.sum("_nb").alias("buckets"),
                    F.count(F.lit(1)).alias("groups")).first()
    if top is None or top["max_n"] is None:
        stats.unpersist()
        return df.withColumn(ord_col, F.lit(None).cast("long"))
    if top["max_n"] <= bucket_rows:
        # every group fits one bucket: a window per group is already bounded
        stats.unpersist()
        w1 = Window.partitionBy(*g).orderBy(key, *tiebreak)
        return df.withColumn(ord_col, (F.row_number().over(w1) - 1).cast("long"))
    plan = stats.select(*g, "_lo", "_w")
    # a null key goes to bucket -1: first, as nulls sort first in the window
    # path, and never dropped by the bucket join
    b0 = F.coalesce(F.floor((F.col(key) - F.col("_lo")) / F.col("_w")).cast("long"), F.lit(-1).cast("long"))
    # broadcast the per-group plan only when the group count is within bounds
    plan_side = F.broadcast(plan) if top["groups"] <= BROADCAST_MAX_ROWS else plan
    keyed = _null_safe(df, plan_side, g).select(
        *df.columns, b0.alias("_b0"), (F.col("_lo") + b0 * F.col("_w")).alias("_blo"), F.col("_w").alias("_bw"))
    buckets = ["_b0"]
    counts = keyed.groupBy(*g, *buckets).agg(F.count(F.lit(1)).alias("_c"))
    n_buckets = int(top["buckets"])
    if top["max_n"] > HOT_FACTOR * bucket_rows:
        # some group is large enough to hold an oversized bucket: materialise
        # the (small) bucket counts and split hot buckets into finer ranges
        checkpoint_dir(df.sparkSession)
        counts = counts.checkpoint(eager=True)
        for level in range(1, max_refine + 1):
            hot = counts.where(F.col("_c") > HOT_FACTOR * bucket_rows)
            if hot.isEmpty():
                break
            # at most rows / (HOT_FACTOR * bucket_rows) hot buckets; counted below
            fan = F.ceil(F.col("_c") / F.lit(bucket_rows)).cast("long")
            hot_plan = hot.select(*g, *buckets, fan.alias("_fan"))
            sub = f"_b{level}"
            step = F.ceil(F.col("_bw") / F.col("_fan")).cast("long")
            st = F.when(F.col("_fan").isNull(), F.col("_bw")).otherwise(step)
            sb = F.coalesce(F.floor((F.col(key) - F.col("_blo")) / st).cast("long"), F.lit(-1).cast("long"))
            keep = [c for c in keyed.columns if c not in ("_blo", "_bw")]
            n_hot = hot.count()  # over the checkpointed (small) counts
            hot_side = F.broadcast(hot_plan) if n_hot <= BROADCAST_MAX_ROWS else hot_plan
            keyed = _null_safe(keyed, hot_side, [*g, *buckets], "left").select(
                *keep, sb.alias(sub), (F.col("_blo") + sb * st).alias("_blo"), st.alias("_bw"))
            buckets.append(sub)
            counts = keyed.groupBy(*g, *buckets).agg(F.count(F.lit(1)).alias("_c")).checkpoint(eager=True)
        n_buckets = counts.count()
    # Prefix sum over the bucket table; bucket tuples sort in key order.
    w = Window.partitionBy(*g).orderBy(*buckets).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*g, *buckets, F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    side = F.broadcast(offsets) if n_buckets <= BROADCAST_MAX_ROWS else offsets
    local = Window.partitionBy(*g, *buckets).orderBy(key, *tiebreak)
    ordinal = (F.col("_off") + F.row_number().over(local) - 1).cast("long")
    return _null_safe(keyed, side, [*g, *buckets]).select(*df.columns, ordinal.alias(ord_col))
