"""Structured Streaming: the report run as a resumable incremental job.

* ``start_report_stream`` — new source files are processed once each
  (checkpointed offsets); every micro-batch goes through the same batch plan
  (:class:`ReportRun`) inside ``foreachBatch`` and writes its outbox, members
  and dead letters under ``epoch=<id>`` with overwrite, so a replayed epoch
  replaces its own output instead of duplicating it. An epoch is a run of its
  own (``<run id>-<epoch>``), so request numbers of epochs never mix.
* ``minute_rates`` — per-minute attempt counts on a live attempt log with a
  watermark, so state for closed minutes is dropped. ``start_rate_stream``
  writes the minutes that an epoch changed, open ones too; ``latest_rates``
  reads the newest counts of each.
* ``dedupe_stream`` — optional drop of repeated delivery keys within the
  watermark.

Cron (outside Spark) starts the job with ``trigger(availableNow=True)``; a
run over unchanged input emits no batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedupe import delivery_key
from ..plans.report_run import ReportRun, RunConfig
from ..session import checkpoint_dir

TablesFromBatch = Callable[[DataFrame], dict[str, DataFrame]]
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: State on disk; an epoch stores its changes, not the whole state.
ON_DISK = {PROVIDER: ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


@contextmanager
def state_on_disk(spark: SparkSession, also: dict[str, str] | None = None) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, with the settings
    ``also``; the caller's are back afterwards (a query keeps those that it
    starts with)."""
    settings = {**ON_DISK, **(also or {})}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/relaykit-{name}-{uuid.uuid4().hex[:12]}"


def report_batch_writer(out_path: str, to_tables: TablesFromBatch, config: RunConfig,
                        fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: batch plan on the micro-batch, outputs keyed by
    epoch (idempotent on replay)."""

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        run = ReportRun(spark, to_tables(batch), replace(config, run_id=f"{config.run_id}-{epoch_id}"), cache=True)
        # dead letters hold this batch's failed transforms; table results count
        # its rows per (table, dt) with every request still unsent
        outs = {"outbox": run.outbox, "members": run.members,
                "dead_letters": run.dead_letters, "table_results": run.table_results}
        for name, df in outs.items():
            (df.withColumn("epoch", F.lit(int(epoch_id)))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("epoch").format(fmt).save(f"{out_path}/{name}"))
        run.assigned.unpersist()
        run.classified.unpersist()

    return write


def start_report_stream(source: DataFrame, to_tables: TablesFromBatch, out_path: str,
                        checkpoint: str, config: RunConfig | None = None,
                        available_now: bool = True) -> StreamingQuery:
    """Start the incremental report job over a streaming ``source``."""
    w = source.writeStream.foreachBatch(report_batch_writer(out_path, to_tables, config or RunConfig())) \
                          .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def minute_rates(attempts: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Attempts / ok / failed per 1-minute window and table, on a stream."""
    ok = F.col("http_status") == 200
    return (attempts.withWatermark("started_at", watermark)
            .groupBy(F.window("started_at", "1 minute").alias("w"), "table_name")
            .agg(F.count(F.lit(1)).alias("attempts"),
                 F.sum(ok.cast("int")).cast("long").alias("ok"),
                 F.sum((~ok).cast("int")).cast("long").alias("failed"))
            .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    "table_name", "attempts", "ok", "failed"))


RATES = "window_start string, table_name string, attempts long, ok long, failed long"


def start_rate_stream(attempts: DataFrame, out_path: str, checkpoint: str, watermark: str = "10 minutes",
                      available_now: bool = True) -> StreamingQuery:
    """Minute rates of a streamed attempt log: every epoch writes the counts so
    far of the minutes it changed (a replayed epoch replaces its own)."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        (batch.withColumn("epoch", F.lit(int(epoch_id))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out_path))

    w = (minute_rates(attempts, watermark).writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def latest_rates(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest counts of every minute and table."""
    got = spark.read.schema(RATES + ", epoch long").parquet(out_path)
    last = got.groupBy("window_start", "table_name").agg(F.max_by(F.struct("attempts", "ok", "failed"), "epoch").alias("_c"))
    return last.select("window_start", "table_name", "_c.attempts", "_c.ok", "_c.failed")


def dedupe_stream(payloads: DataFrame, event_time: str, watermark: str = "1 day") -> DataFrame:
    """Drop repeated delivery keys seen within the watermark (opt-in)."""
    return (payloads.withColumn("delivery_key", delivery_key())
            .withWatermark(event_time, watermark)
            .dropDuplicatesWithinWatermark(["delivery_key"]))
