"""Status-tracked tables: scans by status, an append-only status log in
place of in-place UPDATEs, latest status per record, retries and progress.

An UPDATE ... WHERE id IN (...) becomes rows appended to a status log
(table_name, id, seq, status, error_msg, updated_at); the current state is
the base row overlaid with its latest change. Latest-per-id is an aggregate
(``max_by``) on the record key, so every group is one record's history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordinal import with_ordinal

PENDING, PROCESSING, SUCCESS, FAILED = 0, 1, 2, 3
# Status codes and their descriptions.
STATUS_NAMES = {0: "Pending", 1: "Processing", 2: "Success", 3: "Failed"}
ERROR_MAX_CHARS = 500

STATUS_LOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("error_msg", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("bump_retry", T.BooleanType()),
])


def status_dim(spark) -> DataFrame:
    return spark.createDataFrame(list(STATUS_NAMES.items()), "code int, description string")


def decode_status(df: DataFrame, code_col: str, dim: DataFrame) -> DataFrame:
    """Add ``description`` (null for an unknown code) and ``is_valid``.
    The dimension has four rows: broadcast."""
    d = dim.withColumnRenamed("code", "_code")
    j = df.join(F.broadcast(d), F.col(code_col) == F.col("_code"), "left").drop("_code")
    return j.withColumn("is_valid", F.col("description").isNotNull())


def decode_status_strict(c: Column) -> Column:
    """Description of a code; an unknown code fails the job."""
    out = None
    for code, name in STATUS_NAMES.items():
        out = F.when(c == code, F.lit(name)) if out is None else out.when(c == code, F.lit(name))
    return out.otherwise(F.raise_error(F.concat(F.lit("Unknown status code: "), c.cast("string"))))


def rows_with_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """``WHERE id IN (...)`` as a left-semi join on (table_name, id); an
    empty id set selects nothing (the reference's no-op update)."""
    return df.join(ids.select("table_name", "id").distinct(), ["table_name", "id"], "left_semi")


def truncate_error(c: Column) -> Column:
    return F.substring(c, 1, ERROR_MAX_CHARS)


def top_per_table(df: DataFrame, cond: Column, limit: int, order: str = "id") -> DataFrame:
    """``WHERE cond ORDER BY id LIMIT n`` for every table in one job.

    ``row_number() <= n`` per table is planned as a group limit applied
    before the shuffle, so each task forwards at most n rows per table.
    """
    w = Window.partitionBy("table_name").orderBy(order)
    return (df.where(cond).withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= limit).drop("_rn"))


def pending_scan(df: DataFrame, last_id: int | DataFrame = 0, limit: int = 1000) -> DataFrame:
    """Next keyset page of pending rows per table after ``last_id``
    (a number, or a (table_name, last_id) DataFrame such as progress)."""
    if isinstance(last_id, DataFrame):
        # one row per table; the join is left to AQE, which broadcasts it
        # when its measured size is small
        lo = last_id.groupBy("table_name").agg(F.max("last_id").alias("_last"))
        d = df.join(lo, "table_name", "left") \
              .withColumn("_last", F.coalesce("_last", F.lit(0)))
        return top_per_table(d, (F.col("id") > F.col("_last")) & (F.col("report_status") == PENDING),
                             limit).drop("_last")
    return top_per_table(df, (F.col("id") > last_id) & (F.col("report_status") == PENDING), limit)


def retryable_scan(df: DataFrame, max_retry: int = 3, limit: int = 1000) -> DataFrame:
    return top_per_table(df, (F.col("report_status") == FAILED) & (F.col("retry_count") < max_retry), limit)


def count_by_status(df: DataFrame, status: int) -> DataFrame:
    return df.where(F.col("report_status") == status).groupBy("table_name") \
             .agg(F.count(F.lit(1)).alias("n"))


def counts_with_total(df: DataFrame, names: list[str], status: int = PENDING) -> DataFrame:
    """Per registry table in registry order (zeros included) plus TOTAL."""
    p = df.where(F.col("report_status") == status).groupBy().pivot("table_name", names) \
          .agg(F.count(F.lit(1)))
    args = ", ".join(f"{i}, '{n}', coalesce(`{n}`, 0L)" for i, n in enumerate(names))
    long = p.selectExpr(f"stack({len(names)}, {args}) as (ordinal, table_name, n)")
    total = long.agg(F.sum("n").alias("n")).select(F.lit(len(names)).alias("ordinal"),
                                                   F.lit("TOTAL").alias("table_name"), "n")
    return long.unionByName(total).select(F.col("ordinal").cast("int"), "table_name",
                                          F.col("n").cast("long"))


def status_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy("table_name", "report_status").agg(F.count(F.lit(1)).alias("n"))


def batches_of_ids(df: DataFrame, size: int = 20) -> DataFrame:
    """Chunk each table's rows (id order) into batches of ``size``; per batch
    the ids (sorted, nulls skipped) and the max id (floor 0)."""
    o = with_ordinal(df.where(F.col("id").isNotNull()), ["table_name"], "id", "ord")
    b = o.withColumn("batch_no", F.floor(F.col("ord") / size).cast("long"))
    return b.groupBy("table_name", "batch_no").agg(
        F.array_sort(F.collect_list("id")).alias("record_ids"),
        F.greatest(F.coalesce(F.max("id"), F.lit(0)), F.lit(0)).cast("long").alias("max_record_id"))


def latest_status(log: DataFrame, *within: Column) -> DataFrame:
    """Current state per (table, id): the change with the highest seq (of equal
    ones the latest), the last error recorded (a later change without one
    leaves it), the time of the first change and the number of retry-bumping
    failures in the log. ``within``: further keys, such as a session of changes."""
    order = F.struct("seq", "updated_at", "status")
    return log.groupBy("table_name", "id", *within).agg(
        F.max(order).alias("_last"),
        F.max_by("error_msg", F.when(F.col("error_msg").isNotNull(), order)).alias("error_msg"),
        F.sum(F.when(F.col("bump_retry"), 1).otherwise(0)).cast("int").alias("retry_bumps"),
        F.min("updated_at").alias("first_at")).select(
        "table_name", "id", F.col("_last.seq").alias("seq"), F.col("_last.status").alias("status"),
        "error_msg", F.col("_last.updated_at").alias("updated_at"), "retry_bumps", "first_at")


def apply_status(base: DataFrame, log: DataFrame) -> DataFrame:
    """Base rows overlaid with their latest change (semi-join semantics for
    ids not in the base: they are ignored). retry_count grows by the number
    of failures recorded with an error message."""
    last = latest_status(log).select("table_name", "id", F.col("status").alias("_st"),
                                     F.col("error_msg").alias("_err"), F.col("updated_at").alias("_upd"),
                                     "retry_bumps")
    j = base.join(last, ["table_name", "id"], "left")
    out = j.withColumn("report_status", F.coalesce("_st", "report_status")) \
           .withColumn("retry_count", (F.col("retry_count") + F.coalesce("retry_bumps", F.lit(0))).cast("int")) \
           .withColumn("updated_at", F.coalesce("_upd", "updated_at"))
    if "error_msg" in base.columns:
        out = out.withColumn("error_msg", F.coalesce("_err", "error_msg"))
    else:
        out = out.withColumn("error_msg", F.col("_err"))
    return out.drop("_st", "_err", "_upd", "retry_bumps")


def status_changes(ids: DataFrame, status: int, seq: int | Column, at: Column,
                   error: Column | None = None, bump_retry: bool = False) -> DataFrame:
    """Log rows setting ``status`` for the (table_name, id) rows of ``ids``."""
    err = truncate_error(error) if error is not None else F.lit(None).cast("string")
    return ids.select("table_name", F.col("id").cast("long"), F.lit(seq).cast("long").alias("seq"),
                      F.lit(status).cast("int").alias("status"), err.alias("error_msg"),
                      at.cast("timestamp").alias("updated_at"), F.lit(bump_retry).alias("bump_retry"))


# Status codes of a task.
TASK_RUNNING, TASK_COMPLETED, TASK_FAILED = 1, 2, 3


def task_progress(log: DataFrame, task_type: str = "report") -> DataFrame:
    """Checkpoint per table: last id done, processed/success/fail counts and
    time span of the changes to the ids done, from the first one on; the task's
    id (type and table), its status (running while a row is in process, failed
    when nothing succeeded) and the error of its last failed row."""
    last = latest_status(log)
    ok, bad = F.col("status") == SUCCESS, F.col("status") == FAILED
    done = ok | bad
    out = last.groupBy("table_name").agg(
        F.max(F.when(done, F.col("id"))).alias("last_processed_id"),
        F.count(F.when(done, 1)).alias("processed_count"),
        F.count(F.when(ok, 1)).alias("success_count"),
        F.count(F.when(bad, 1)).alias("fail_count"),
        F.min(F.when(done, F.col("first_at"))).alias("start_time"), F.max(F.when(done, F.col("updated_at"))).alias("end_time"),
        F.max_by("error_msg", F.when(bad, F.struct("updated_at", "id"))).alias("error_msg"),
        F.count(F.when(F.col("status") == PROCESSING, 1)).alias("_open"))
    status = (F.when(F.col("_open") > 0, TASK_RUNNING).when((F.col("fail_count") > 0) & (F.col("success_count") == 0), TASK_FAILED)
              .otherwise(TASK_COMPLETED))
    return (out.where(F.col("processed_count") > 0).withColumn("task_type", F.lit(task_type))
            .withColumn("task_id", F.concat_ws("-", "task_type", "table_name")).withColumn("status", status).drop("_open"))


def incremental_pending(df: DataFrame, progress: DataFrame) -> DataFrame:
    """Pending rows after each table's checkpoint (all rows when none)."""
    p = progress.select("table_name", F.col("last_processed_id").alias("_last"))
    j = df.join(F.broadcast(p), "table_name", "left")  # one row per table
    return j.where((F.col("report_status") == PENDING) & (F.col("id") > F.coalesce("_last", F.lit(0)))) \
            .drop("_last")


def stale_processing(df: DataFrame, now: Column, older_than: str = "1 hour") -> DataFrame:
    """Rows stuck in Processing since before ``now - older_than``."""
    cutoff = now - F.expr(f"interval {older_than}")
    return df.where((F.col("report_status") == PROCESSING) & (F.col("updated_at") < cutoff))


def next_seq(ids: DataFrame, log: DataFrame | None) -> DataFrame:
    """``ids`` with column ``next_seq``: one more than the highest seq of the
    id in ``log``, 1 without any."""
    if log is None:
        return ids.withColumn("next_seq", F.lit(1).cast("long"))
    top = log.groupBy("table_name", "id").agg(F.max("seq").alias("_top"))
    return ids.join(top, ["table_name", "id"], "left") \
              .withColumn("next_seq", F.coalesce("_top", F.lit(0).cast("long")) + 1).drop("_top")


def reset_stale(df: DataFrame, now: Column, older_than: str = "1 hour", log: DataFrame | None = None) -> DataFrame:
    """Status-log rows returning stale Processing rows to Pending, numbered
    after the changes that ``log`` already holds."""
    stale = next_seq(stale_processing(df, now, older_than), log)
    return status_changes(stale, PENDING, F.col("next_seq"), now)
