"""Latest status and stuck records of a streamed status log.

Each record (table_name, id) has two keyed states, both of Spark's own streaming
aggregations. The first is the record as :func:`status_log.latest_status` gives
it; an epoch yields the records that it changed. The second is its timer: a
session of changes that ends ``older_than`` after the last one. When the
watermark passes that end and no change has come, the session leaves the state;
if its last change is in process, the record leaves as stale.

An epoch writes what it yields, a replayed one replaces its own; :func:`read_latest`
and :func:`read_stale` read the newest row of each record. A change that comes
when its session's end has been passed by the watermark (``watermark`` behind the
newest change) starts no timer, but counts in the latest status. A stream
without new rows does not move its watermark, so a run ends with a row of its own
(:func:`end_changes`). The state is kept by the RocksDB store, on disk, since it
holds a row for each record of the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import status_log as sl
from .runner import PROVIDER, ROCKSDB, state_on_disk  # noqa: F401

LATEST, STALE = "latest", "stale"
#: table_name of the row that ends a run; no table has this name.
END = "\u0003end"

YIELDED = T.StructType([T.StructField(n, t) for n, t in (
    ("table_name", T.StringType()), ("id", T.LongType()), ("seq", T.LongType()), ("status", T.IntegerType()),
    ("error_msg", T.StringType()), ("updated_at", T.TimestampType()), ("retry_bumps", T.IntegerType()), ("first_at", T.TimestampType()))])


class StatusStream:
    """The two running queries: latest rows and timers."""

    def __init__(self, *queries: StreamingQuery):
        self.queries = queries

    def awaitTermination(self) -> None:
        for q in self.queries:
            q.awaitTermination()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def end_changes(log: DataFrame, path: str, at: str) -> None:
    """Append the end of a run to the log at ``path``: a row that moves the watermark."""
    fixed = {"table_name": F.lit(END), "updated_at": F.lit(at).cast("timestamp")}
    row = log.sparkSession.range(1).select(*[fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in log.schema])
    row.write.mode("append").parquet(path)


def latest_changes(log: DataFrame) -> DataFrame:
    """Records that changed, as they stand then (:data:`YIELDED`), of a stream of changes."""
    return sl.latest_status(log)


def expired_timers(log: DataFrame, older_than_s: int = 3600, watermark: str = "10 minutes") -> DataFrame:
    """Records (:data:`YIELDED`) in process whose last change the watermark has left behind by ``older_than_s``."""
    session = F.session_window("updated_at", f"{older_than_s} seconds")
    return sl.latest_status(log.withWatermark("updated_at", watermark), session).where(F.col("status") == sl.PROCESSING)


def start_status_stream(log: DataFrame, out_path: str, checkpoint: str, older_than_s: int = 3600, watermark: str = "10 minutes",
                        available_now: bool = True) -> StatusStream:
    """Write :func:`latest_changes` and :func:`expired_timers` under ``out_path`` by kind and epoch."""
    def start(rows: DataFrame, kind: str, mode: str) -> StreamingQuery:
        def write(batch: DataFrame, epoch_id: int) -> None:
            (batch.where(F.col("table_name").isNull() | (F.col("table_name") != END)).withColumn("epoch", F.lit(int(epoch_id)))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(f"{out_path}/kind={kind}"))

        w = rows.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{checkpoint}/{kind}")
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()

    with state_on_disk(log.sparkSession):
        return StatusStream(start(latest_changes(log), LATEST, "update"), start(expired_timers(log, older_than_s, watermark), STALE, "append"))


def _newest(spark: SparkSession, out_path: str, kind: str) -> DataFrame:
    schema = T.StructType([*YIELDED, T.StructField("kind", T.StringType()), T.StructField("epoch", T.LongType())])
    got = spark.read.schema(schema).parquet(out_path).where(F.col("kind") == kind)
    fields = [c for c in YIELDED.names if c not in ("table_name", "id")]
    last = got.groupBy("table_name", "id").agg(F.max_by(F.struct(*fields), F.struct("seq", "updated_at", "status", "epoch")).alias("_r"))
    return last.select("table_name", "id", "_r.*")


def read_latest(spark: SparkSession, out_path: str) -> DataFrame:
    """Current state of every record written (as :func:`status_log.latest_status`)."""
    return _newest(spark, out_path, LATEST)


def read_stale(spark: SparkSession, out_path: str) -> DataFrame:
    """Records whose timer ran out and that have no change since."""
    ran_out, now = _newest(spark, out_path, STALE).alias("_s"), read_latest(spark, out_path).where(F.col("status") == sl.PROCESSING).alias("_n")
    same = F.lit(True)
    for c in ("table_name", "id", "seq", "updated_at"):
        same = same & F.col(f"_n.{c}").eqNullSafe(F.col(f"_s.{c}"))
    return now.join(ran_out, same, "left_semi")
