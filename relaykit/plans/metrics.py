"""Metrics of a run taken while its outputs are written.

Each accounting output (record outcomes, request outcomes, failure-rate window) is
written once with an observation just before the write, so its counters come from
the rows that are stored and no table is read a second time. A lost task's rows are
counted by its rerun alone, since the observed stage is the one that writes.

Timers: ``avg_request_ms`` is the mean time of a request with its tries,
``avg_batch_ms`` that of batched requests only, ``avg_query_ms`` the mean wall time
of the jobs that read and wrote the outputs. A timer without events has no row.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.delivery import failure_rate_window
from ..registry import BATCH
from .report_run import ReportRun

METRICS = "metric string, value double"


def _count(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("double")


def write_observed(run: ReportRun, base_path: str, fmt: str = "parquet") -> DataFrame:
    """Write the run's accounting under ``base_path/<name>/run_id=...``, replacing
    an earlier pass of the same run; its metrics as (metric, value) rows."""
    status, ok, batched = F.col("status"), F.col("success"), F.col("mode") == BATCH
    outputs = {
        "record_outcomes": (run.record_outcomes, [
            F.count(F.lit(1)).cast("double").alias("records_processed"), _count(status == "success").alias("records_success"),
            _count(status == "failed").alias("records_failed")]),
        "request_outcomes": (run.outcome, [
            F.count(F.lit(1)).cast("double").alias("requests_sent"), _count(ok).alias("requests_success"), _count(~ok).alias("requests_failed"),
            F.round(F.avg("duration_ms"), 3).alias("avg_request_ms"),
            F.round(F.avg(F.when(batched, F.col("duration_ms"))), 3).alias("avg_batch_ms")]),
        "failure_rate": (failure_rate_window(run.classified), [_count(F.col("opened")).alias("breaker_opens")])}
    found: dict[str, float | None] = {}
    spent = []
    for name, (df, exprs) in outputs.items():
        seen, start = Observation(f"{name}-{run.cfg.run_id}"), time.monotonic()
        (df.withColumn("run_id", F.lit(run.cfg.run_id)).observe(seen, *exprs).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").format(fmt).save(f"{base_path}/{name}"))
        spent.append(1000 * (time.monotonic() - start))
        found.update(seen.get)
    found["avg_query_ms"] = sum(spent) / len(spent)
    timers = ("avg_request_ms", "avg_batch_ms", "avg_query_ms")
    rows = [(k, v if k in timers else v or 0.0) for k, v in found.items() if v is not None or k not in timers]
    return run.spark.createDataFrame(rows, METRICS)
