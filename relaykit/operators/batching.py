"""Request planning: ordinals, pages, batches, the outbox, the call plan.

A (table, dt) is read as consecutive pages of ``page_size`` rows (ordered by
the source key) and each page is cut into batches of ``batch_size``; batches
never cross a page. Rows whose transform failed keep their page slot but take
no batch slot. SINGLE tables send one request per row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..registry import BATCH, BATCH_ENDPOINT, SINGLE, SINGLE_ENDPOINT
from .ordinal import with_ordinal

MAX_BATCH = 50
MISSING_KEY = "Transform failed: missing record key"
GROUP = ("table_name", "dt")


def check_batch_size(size: int) -> int:
    """Valid range is 1..50; larger requests would be cut by the API."""
    if not 1 <= int(size) <= MAX_BATCH:
        raise ValueError(f"batch size must be within 1..{MAX_BATCH}, got {size}")
    return int(size)


def batches_per_page(page_size: int, batch_size: int) -> int:
    return -(-page_size // batch_size)


def batch_number(ord_col: Column, page_size: int, batch_size: int,
                 in_page_col: Column | None = None) -> Column:
    """``floor(ord/page)*ceil(page/size) + floor(in_page/size)``."""
    in_page = in_page_col if in_page_col is not None else F.pmod(ord_col, F.lit(page_size))
    page = F.floor(ord_col / F.lit(page_size))
    return (page * F.lit(batches_per_page(page_size, batch_size))
            + F.floor(in_page / F.lit(batch_size))).cast("long")


def assign_requests(payloads: DataFrame, modes: DataFrame | Mapping[str, str], batch_size: int = 20,
                    page_size: int = 1000, key: str = "event_id",
                    may_have_errors: bool = True, bucket_rows: int = 1 << 20,
                    unique_key: bool = True) -> DataFrame:
    """Give every payload row its mode, endpoint and request number, and BATCH
    rows their ordinal and page.

    ``payloads`` is :func:`transform.payloads_all` output; ``modes`` is a
    table → mode mapping (:func:`registry.mode_map`) or a (table_name, mode)
    DataFrame (:func:`registry.resolve_modes`, registry-sized, broadcast).
    SINGLE rows are one request each, numbered by their unique source key, so
    they skip the ordinal and its shuffle entirely; only BATCH rows are ranked,
    paged and chunked. Without a ``unique_key`` (tables without a row id, keyed
    by a hash) SINGLE rows are ranked too and numbered by their ordinal. Adds:
    ord, page_no (null for SINGLE), mode, endpoint, request_no (null for rows
    with an error).
    """
    check_batch_size(batch_size)
    if isinstance(modes, Mapping):
        # modes known from configuration: a literal test on table_name, which
        # Catalyst folds per union branch, so each table is read by one branch
        singles = sorted(t for t, m in modes.items() if m == SINGLE)
        mode = F.when(F.col("table_name").isin(singles), F.lit(SINGLE)).otherwise(F.lit(BATCH))
        tagged = payloads.select(*payloads.columns, mode.alias("mode"))
    else:
        tagged = payloads.join(F.broadcast(modes.select("table_name", F.col("mode").alias("_mode"))),
                               "table_name", "left")
        mode = F.coalesce("_mode", F.lit(BATCH))
        tagged = tagged.select(*payloads.columns, mode.alias("mode"))
    good = F.col("error").isNull()

    # a SINGLE row is numbered by its key; a row without one cannot be
    # addressed and is reported as failed rather than left unsent
    # equal hashes of different rows are told apart by what is sent
    ties = () if unique_key else tuple(c for c in ("body", "record_json") if c in payloads.columns)
    singles = tagged.where(F.col("mode") == SINGLE)
    if unique_key:
        s_err = F.coalesce(F.col("error"), F.when(F.col(key).isNull(), F.lit(MISSING_KEY)))
        number, order = F.col(key).cast("long"), F.lit(None).cast("long")
    else:
        singles = with_ordinal(singles, GROUP, key, "ord", bucket_rows=bucket_rows, tiebreak=ties)
        s_err, number, order = F.col("error"), F.col("ord"), F.col("ord")
    single = singles.select(
        *[c for c in payloads.columns if c != "error"], s_err.alias("error"), "mode",
        order.alias("ord"), F.lit(None).cast("long").alias("page_no"),
        F.when(s_err.isNull(), number).alias("request_no"),
        F.lit(SINGLE_ENDPOINT).alias("endpoint"))

    batch = with_ordinal(tagged.where(F.col("mode") == BATCH), GROUP, key, "ord", bucket_rows=bucket_rows, tiebreak=ties)
    page = F.floor(F.col("ord") / F.lit(page_size)).cast("long")
    if may_have_errors:
        # position among the good rows of the page; a page holds at most
        # page_size rows, so this window is bounded per task
        w = Window.partitionBy("table_name", "dt", page, good).orderBy("ord")
        in_page = F.row_number().over(w) - 1
    else:
        in_page = F.pmod(F.col("ord"), F.lit(page_size))
    bno = batch_number(F.col("ord"), page_size, batch_size, in_page)
    batch = batch.select(*payloads.columns, "mode", "ord", page.alias("page_no"),
                         F.when(good, bno).alias("request_no"), F.lit(BATCH_ENDPOINT).alias("endpoint"))
    return single.unionByName(batch)


def outbox(assigned: DataFrame, run_id: str = "run") -> DataFrame:
    """One row per request: (run_id, table_name, dt, request_no, endpoint,
    n_records, body). BATCH bodies are JSON arrays in source-key order; a
    batch holds at most 50 payloads, so each collected group is bounded."""
    good = assigned.where(F.col("request_no").isNotNull())
    single = good.where(F.col("mode") == SINGLE).select(
        F.lit(run_id).alias("run_id"), "table_name", "dt", "request_no", "endpoint",
        F.lit(1).alias("n_records"), "body")
    grouped = (good.where(F.col("mode") != SINGLE)
               .groupBy("table_name", "dt", "request_no", "endpoint")
               .agg(F.array_sort(F.collect_list(F.struct("ord", "body"))).alias("_items")))
    batch = grouped.select(
        F.lit(run_id).alias("run_id"), "table_name", "dt", "request_no", "endpoint",
        F.size("_items").alias("n_records"),
        F.concat(F.lit("["), F.array_join(F.transform("_items", lambda x: x["body"]), ","),
                 F.lit("]")).alias("body"))
    return single.unionByName(batch)


def members(assigned: DataFrame, key: str = "event_id") -> DataFrame:
    """Request membership: which source row went into which request."""
    cols = ["table_name", "dt", "request_no", key, "ord", "mode", "user_unique_id", "error"]
    if "record_json" in assigned.columns:
        cols.append("record_json")
    return assigned.select(*cols)


def request_plan(counts: DataFrame, modes: DataFrame, batch_size: int = 20,
                 page_size: int = 1000, max_attempts: int = 3) -> DataFrame:
    """Best- and worst-case calls per (table, dt) from counts alone.

    ``counts`` has (table_name, dt, n). SINGLE: n calls; BATCH: full pages
    times ceil(page/size) plus ceil(last page/size); worst case × attempts.
    """
    check_batch_size(batch_size)
    n = F.col("n")
    full_pages = F.floor(n / F.lit(page_size))
    rest = n - full_pages * F.lit(page_size)
    batch_calls = full_pages * F.lit(batches_per_page(page_size, batch_size)) + F.ceil(rest / F.lit(batch_size))
    df = counts.join(F.broadcast(modes.select("table_name", "mode")), "table_name", "left") \
               .withColumn("mode", F.coalesce("mode", F.lit(BATCH)))
    calls = F.when(F.col("mode") == SINGLE, n).otherwise(batch_calls).cast("long")
    return df.select("table_name", "dt", "mode", n.cast("long").alias("n_records"),
                     calls.alias("best_calls"), (calls * F.lit(max_attempts)).alias("worst_calls"))
