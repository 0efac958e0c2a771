"""Counts, statistics, run summaries, dead letters and metrics.

All are aggregations; outputs are small (per table × date, per minute, per
reason), inputs are read once per job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.masking import mask_user_id

# The total row label and the layouts of the stats line, the
# run summary line and the failed-record line.
TOTAL = "TOTAL"
STATS_LINE = "  %-20s : %d"
SUMMARY_LINE = "Summary: total=%d, success=%d, fail=%d"
FAILED_LINE = "FAILED: table=%s, dt=%s, user=%s, reason=%s, record=%s"


def tag_tables(tables: Mapping[str, DataFrame], cols: Sequence[str] = ("dt",)) -> DataFrame:
    """Union of the given tables' ``cols`` with a literal table_name column; a
    column that a table does not have is null."""
    def col(df: DataFrame, c: str) -> Column:
        return F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
    parts = [df.select(F.lit(name).alias("table_name"), *[col(df, c) for c in cols]) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def partition_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, dt, n) for every non-empty partition; one job for all."""
    return tag_tables(tables).groupBy("table_name", "dt").agg(F.count(F.lit(1)).alias("n"))


def _asked(df: DataFrame, dates: Sequence[str]) -> DataFrame:
    """The dates asked for, without a table: they get rows even without data."""
    return df.sparkSession.createDataFrame([(d,) for d in dates], "dt string") \
             .select(F.lit(None).cast("string").alias("table_name"), "dt")


def stats_by_date(tables: Mapping[str, DataFrame], names: Sequence[str], dates: Sequence[str] = ()) -> DataFrame:
    """Per date: one row per configured table (zeros included) and TOTAL;
    ``dates`` get their rows of zeros even when no table has the date.

    ``pivot`` over the known table list turns missing partitions into nulls
    (→ 0) without building a tables × dates grid by join; ``stack`` turns the
    columns back into rows. Output: dt, table_name, n, ordinal, line.
    """
    names = list(names)
    tagged = tag_tables(tables)
    if dates:
        tagged = tagged.unionByName(_asked(tagged, dates))
    counts = tagged.groupBy("dt").pivot("table_name", names).agg(F.count(F.lit(1)))
    stack_args = ", ".join(f"{i}, '{n}', coalesce(`{n}`, 0L)" for i, n in enumerate(names))
    long = counts.selectExpr("dt", f"stack({len(names)}, {stack_args}) as (ordinal, table_name, n)")
    total = long.groupBy("dt").agg(F.sum("n").alias("n")) \
                .select("dt", F.lit(len(names)).alias("ordinal"), F.lit(TOTAL).alias("table_name"), "n")
    both = long.unionByName(total)
    return both.select("dt", "table_name", F.col("n").cast("long").alias("n"),
                       F.col("ordinal").cast("int").alias("ordinal"),
                       F.format_string(STATS_LINE, F.col("table_name"), F.col("n")).alias("line"))


def table_results(counts: DataFrame, record_outcomes: DataFrame) -> DataFrame:
    """Per (table, dt): total from the scan count, success/fail from outcomes."""
    o = record_outcomes.groupBy("table_name", "dt").agg(
        F.sum(F.when(F.col("status") == "success", 1).otherwise(0)).cast("long").alias("success"),
        F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).cast("long").alias("fail"),
        F.sum(F.when(F.col("status") == "unsent", 1).otherwise(0)).cast("long").alias("unsent"))
    o = o.select(F.col("table_name").alias("_t"), F.col("dt").alias("_d"), "success", "fail", "unsent")
    return counts.join(o, F.col("table_name").eqNullSafe(F.col("_t")) & F.col("dt").eqNullSafe(F.col("_d")), "left").select(
        "table_name", "dt", F.col("n").cast("long").alias("total"),
        F.coalesce("success", F.lit(0)).cast("long").alias("success"),
        F.coalesce("fail", F.lit(0)).cast("long").alias("fail"),
        F.coalesce("unsent", F.lit(0)).cast("long").alias("unsent"))


def run_summary(table_results_df: DataFrame, dates: Sequence[str] = ()) -> DataFrame:
    """Totals per dt and overall (rollup); ``table_name``/``dt`` null on the
    total rows, with ``level`` telling which (rows of a null dt have a date
    row too). ``dates`` without any row get a date row of zeros."""
    counts = ("total", "success", "fail")
    rows = table_results_df.select("dt", "table_name", *counts)
    if dates:
        rows = rows.unionByName(_asked(rows, dates).withColumns({c: F.lit(0).cast("long") for c in counts}))
    r = rows.rollup("dt", "table_name").agg(
        *[F.sum(c).cast("long").alias(c) for c in counts], F.grouping_id().alias("_level"))
    r = r.where((F.col("_level") != 0) | F.col("table_name").isNotNull())
    level = F.when(F.col("_level") == 3, F.lit("all")).when(F.col("_level") == 1, F.lit("date")).otherwise(F.lit("table"))
    line = F.format_string(SUMMARY_LINE, "total", "success", "fail")
    return r.select("dt", "table_name", level.alias("level"), "total", "success", "fail", line.alias("line"))


def _id_field(user_id: Column) -> Column:
    """``"user_unique_id":"..."`` as the record's JSON writes it."""
    whole = F.to_json(F.struct(F.coalesce(user_id, F.lit("")).alias("user_unique_id")))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def dead_letters(record_outcomes_df: DataFrame, run_id: str = "run") -> DataFrame:
    """Failed rows: table, dt, masked user (``unknown`` → ``***``), reason and
    the record JSON with its user id masked too (raw one kept apart)."""
    f = record_outcomes_df.where(F.col("status") == "failed")
    uid = F.coalesce(F.col("user_unique_id"), F.lit("unknown"))
    masked = mask_user_id(uid)
    rec = F.col("record_json")
    # the field as it stands in the record, replaced as plain text: quotes,
    # backslashes and dollar signs in an id are no pattern
    rec_masked = F.replace(rec, _id_field(F.col("user_unique_id")), _id_field(masked))
    return f.select(F.lit(run_id).alias("run_id"), "table_name", "dt", masked.alias("user_masked"),
                    "reason", rec_masked.alias("record_json"), rec.alias("record_json_raw"))


def failed_line(dl: DataFrame) -> DataFrame:
    """The failed-records log line of each dead letter (raw record, as the
    reference log writes it)."""
    return dl.select(F.format_string(FAILED_LINE,
                                     "table_name", "dt", "user_masked", "reason",
                                     "record_json_raw").alias("value"))


def dead_letter_counts(dl: DataFrame) -> DataFrame:
    return dl.groupBy("dt", "table_name", "reason").agg(F.count(F.lit(1)).alias("n"))


def metrics_summary(record_outcomes_df: DataFrame, outcome: DataFrame, breaker: DataFrame) -> DataFrame:
    """Counters of a run as (metric, value) rows: records processed/success/
    failed, requests sent/success/failed, breaker opens, mean request time
    (absent when there were no requests)."""
    rec = record_outcomes_df.agg(
        F.count(F.lit(1)).cast("double").alias("records_processed"),
        F.sum(F.when(F.col("status") == "success", 1).otherwise(0)).cast("double").alias("records_success"),
        F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).cast("double").alias("records_failed"))
    req = outcome.agg(
        F.count(F.lit(1)).cast("double").alias("requests_sent"),
        F.sum(F.when(F.col("success"), 1).otherwise(0)).cast("double").alias("requests_success"),
        F.sum(F.when(F.col("success"), 0).otherwise(1)).cast("double").alias("requests_failed"),
        F.round(F.avg("duration_ms"), 3).alias("avg_request_ms"))
    br = breaker.agg(F.sum(F.col("opened").cast("int")).cast("double").alias("breaker_opens"))
    parts = [df.unpivot([], df.columns, "metric", "value") for df in (rec, req, br)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).where(F.col("value").isNotNull())


def processing_rate(classified: DataFrame, minutes: int = 1) -> DataFrame:
    """Attempts, successes and failures per minute window and table."""
    w = F.window(F.col("started_at").cast("timestamp"), f"{minutes} minute")
    g = classified.groupBy(w.alias("w"), "table_name").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.sum(F.col("ok").cast("int")).cast("long").alias("ok"),
        F.sum((~F.col("ok")).cast("int")).cast("long").alias("failed"))
    return g.select(F.date_format(F.col("w.start"), "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    "table_name", "attempts", "ok", "failed")


def attempt_success_rate(classified: DataFrame) -> DataFrame:
    """Per table: attempts, successes, failures by kind, success rate."""
    st = F.col("http_status")
    return classified.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.sum(F.col("ok").cast("int")).cast("long").alias("ok"),
        F.sum((st == 0).cast("int")).cast("long").alias("io_errors"),
        F.sum(((st != 0) & ~F.col("ok")).cast("int")).cast("long").alias("http_errors"),
        F.round(F.avg(F.col("ok").cast("double")), 6).alias("success_rate"))


def retry_histogram(outcome: DataFrame) -> DataFrame:
    """Requests by tries used and result."""
    return outcome.groupBy("table_name", "attempts_used", "success").agg(F.count(F.lit(1)).alias("n"))
