"""Record outcomes while a run is being delivered.

Members (with the time ``sent_at`` at which their request was handed over) and
attempts arrive as two streams. They are joined on the request within a horizon:
a member meets every attempt of its request that starts up to ``horizon`` after
it was sent. State is kept until both watermarks have passed that time; then a
member that met no attempt leaves as unsent. Rows of failed transforms have no
request and pass the join by.

An epoch writes the pairs it found, a replayed one replaces its own; the outcome
of a record is made from its pairs by the rules of the batch run. What arrives
later than ``watermark`` behind its stream is left out by Spark. The state is kept
on disk, by the RocksDB store, in one store for both sides.

A stream that has no more rows does not move its watermark. A run ends with rows
of its own in both logs (:func:`end_log`), at a time after all others plus
watermark and horizon, so the last members leave too. There are two, as members
with and without a request are streams of their own, each with a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import delivery
from .runner import state_on_disk

#: Both sides of the join in one store per partition.
JOIN_STATE = "spark.sql.streaming.join.stateFormatVersion"
MEMBER = ("run_id", "table_name", "dt", "request_no", "event_id", "user_unique_id", "error", "sent_at")
ATTEMPT = ("attempt", "http_status", "body", "transport_error", "started_at", "duration_ms")
#: table_name of the rows that end a run; no table has this name.
END = "\u0003end"


def end_log(rows: DataFrame, time_col: str, path: str, at: str) -> None:
    """Append the end of a run to the log at ``path``, which has ``rows``'s columns."""
    fixed = {"table_name": F.lit(END), time_col: F.lit(at).cast("timestamp"), "request_no": F.when(F.col("id") == 0, -1)}
    both = rows.sparkSession.range(2).select(*[fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema])
    both.coalesce(1).write.mode("append").parquet(path)


def join_outcomes(members: DataFrame, attempts: DataFrame, horizon: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """Pairs of member and attempt, and members without one, of two streams."""
    m = members.select(*MEMBER).withWatermark("sent_at", watermark)
    keys = [F.col(c).alias(f"_a_{c}") for c in delivery.REQ]
    a = attempts.select(*keys, *ATTEMPT).withWatermark("started_at", watermark)
    same = F.lit(True)
    for c in delivery.REQ:
        same = same & F.col(c).eqNullSafe(F.col(f"_a_{c}"))
    within = F.expr(f"started_at >= sent_at and started_at <= sent_at + interval {horizon}")
    sent = m.where(F.col("request_no").isNotNull()).join(a, same & within, "leftOuter").select(*MEMBER, *ATTEMPT)
    rejected = m.where(F.col("request_no").isNull())
    types = {f.name: f.dataType for f in attempts.schema}
    rejected = rejected.select(*MEMBER, *[F.lit(None).cast(types[c]).alias(c) for c in ATTEMPT])
    return sent.unionByName(rejected)


def start_outcome_stream(members: DataFrame, attempts: DataFrame, out_path: str, checkpoint: str, horizon: str = "1 hour",
                         watermark: str = "10 minutes", available_now: bool = True) -> StreamingQuery:
    """Write the pairs of :func:`join_outcomes` under ``out_path`` by epoch."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        # left out only here: a filter in the stream would go below its watermarks
        (batch.where(F.col("table_name") != END).withColumn("epoch", F.lit(int(epoch_id))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out_path))

    w = (join_outcomes(members, attempts, horizon, watermark).writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    with state_on_disk(members.sparkSession, {JOIN_STATE: "3"}):
        return w.start()


def read_outcomes(spark: SparkSession, out_path: str, modes: DataFrame, max_attempts: int = delivery.MAX_ATTEMPTS) -> DataFrame:
    """Outcome of every record whose pairs are written (:func:`delivery.record_outcomes`)."""
    pairs = spark.read.parquet(out_path)
    attempts = pairs.where("attempt is not null").select(*delivery.REQ, *ATTEMPT).dropDuplicates([*delivery.REQ, "attempt"])
    members = pairs.select(*MEMBER).distinct()
    return delivery.record_outcomes(members, delivery.outcomes(delivery.classify(attempts), modes, max_attempts))
