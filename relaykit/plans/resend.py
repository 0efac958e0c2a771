"""Send failed records again until each is delivered or given up.

A round takes every record that is Failed with tries left, marks it Processing,
reports it like a normal run (payloads, batches, delivery, outcomes) and appends
its new status: Success, or Failed with the error and one more retry. What is
still retryable is the next round; a record leaves after ``max_retry`` retries,
so there are at most that many rounds.

Each round works on the records that are still open, not on the whole table, and
keeps its steps as tables under ``path``:

    round=<n>/open      records of the round with their retry count and sequence
    round=<n>/members   which record goes into which request
    round=<n>/outbox    the requests
    round=<n>/attempts  the attempt log
    round=<n>/changes   status-log rows, in the order of ``seq``

A step that is there in full (its ``_SUCCESS`` file) is read, not made again: a
job that died is started again with the same path and goes on where it stopped.
Records keep their requests, and a finished attempt log is never sent twice; the
step that was being delivered is sent again (at least once).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batching, delivery, transform
from ..operators import status_log as sl
from ..registry import REGISTRY, Registry, mode_map, resolve_modes

#: (outbox, round) -> attempt log
Sender = Callable[[DataFrame, int], DataFrame]


@dataclass
class ResendConfig:
    run_id: str = "resend"
    max_retry: int = 3
    batch_size: int = 20
    page_size: int = 1000
    max_attempts: int = delivery.MAX_ATTEMPTS
    #: time of the first status change; a round takes ``round_minutes``
    started_at: str = "2024-02-01 00:00:00"
    round_minutes: int = 10
    dt: str = "2024-02-01"
    mode_overrides: Mapping[str, str] = field(default_factory=dict)


def transport_sender(transport: Callable[[str, str], tuple[int, str]], config: ResendConfig, partitions: int | None = None) -> Sender:
    """Deliver each round's outbox with ``transport`` (see :func:`delivery.deliver`)."""
    def send(outbox: DataFrame, round_no: int) -> DataFrame:
        ob = outbox.repartition(partitions) if partitions else outbox
        return delivery.deliver(ob, transport, config.max_attempts, f"{config.run_id}-{round_no}")
    return send


class Resend:
    """One restartable resend job.

    ``tables``: table name → status-tracked rows (id, user_unique_id, the
    registry fields it has, report_status, retry_count); their current status is
    what ``log`` makes of it. ``ingest_ms``: processing time for rows without
    an event time. Unknown table names raise."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame], path: str, sender: Sender, ingest_ms: int,
                 log: DataFrame | None = None, config: ResendConfig | None = None, registry: Registry = REGISTRY):
        unknown = [n for n in tables if registry.get(n) is None]
        if unknown:
            raise ValueError(f"Unknown table name: {unknown[0]}")
        self.spark, self.tables, self.path, self.sender = spark, dict(tables), path.rstrip("/"), sender
        self.ingest_ms, self.log, self.registry = ingest_ms, log, registry
        self.cfg = config or ResendConfig()

    # -- steps ----------------------------------------------------------------
    def _at(self, round_no: int, name: str) -> str:
        return f"{self.path}/round={round_no}/{name}"

    def _done(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def _step(self, round_no: int, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = self._at(round_no, name)
        if not self._done(path):
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def _payloads(self) -> DataFrame:
        """Payloads of all tables with the columns that tell who is retryable."""
        parts = []
        for name, df in self.tables.items():
            spec = self.registry.get(name)
            keep = ("id", "report_status", "retry_count")
            rows = df.withColumn("dt", F.lit(self.cfg.dt))
            parts.append(transform.to_payloads(rows, spec, self.ingest_ms, key_cols=keep)
                         .select("table_name", "dt", *keep, "user_unique_id", "body", "error"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _first(self) -> DataFrame:
        """Retryable records by the table and the log before the job, with the
        number of their last change."""
        rows = self._payloads()
        if self.log is None:
            return self._retryable(rows.withColumn("seq", F.lit(0).cast("long")))
        last = sl.latest_status(self.log).select("table_name", "id", F.col("status").alias("_st"), "retry_bumps", "seq")
        now = rows.join(last, ["table_name", "id"], "left")
        return self._retryable(now.withColumn("report_status", F.coalesce("_st", "report_status"))
                               .withColumn("retry_count", (F.col("retry_count") + F.coalesce("retry_bumps", F.lit(0))).cast("int"))
                               .withColumn("seq", F.coalesce("seq", F.lit(0).cast("long"))).drop("_st", "retry_bumps"))

    def _retryable(self, rows: DataFrame) -> DataFrame:
        return rows.where((F.col("report_status") == sl.FAILED) & (F.col("retry_count") < self.cfg.max_retry))

    def _assigned(self, rows: DataFrame) -> DataFrame:
        modes = mode_map(self.registry, dict(self.cfg.mode_overrides))
        return batching.assign_requests(rows, modes, self.cfg.batch_size, self.cfg.page_size, key="id")

    def _time(self, round_no: int, done: bool) -> Column:
        minutes = (round_no - 1) * self.cfg.round_minutes + (self.cfg.round_minutes // 2 if done else 0)
        return F.lit(self.cfg.started_at).cast("timestamp") + F.expr(f"interval {minutes} minutes")

    def _outcomes(self, members: DataFrame, attempts: DataFrame) -> DataFrame:
        """Members with their result and the reason of a failure."""
        overrides = None
        if self.cfg.mode_overrides:
            overrides = self.spark.createDataFrame(list(self.cfg.mode_overrides.items()), "table_name string, mode string")
        modes = resolve_modes(self.registry.to_df(self.spark), overrides)
        result = delivery.outcomes(delivery.classify(attempts).drop("run_id"), modes, self.cfg.max_attempts)
        found = delivery.record_outcomes(members, result, key="id").select("table_name", "id", "status", "reason")
        return members.select("table_name", "id", "seq", "retry_count").join(found, ["table_name", "id"])

    def _changes(self, members: DataFrame, attempts: DataFrame, round_no: int) -> DataFrame:
        rows = self._outcomes(members, attempts)
        locked = sl.status_changes(members, sl.PROCESSING, F.col("seq") + 1, self._time(round_no, False))
        after = self._time(round_no, True)
        ok = sl.status_changes(rows.where("status = 'success'"), sl.SUCCESS, F.col("seq") + 2, after)
        bad = sl.status_changes(rows.where("status <> 'success'"), sl.FAILED, F.col("seq") + 2, after,
                                error=F.coalesce("reason", F.lit("not sent")), bump_retry=True)
        return locked.unionByName(ok).unionByName(bad)

    # -- the job --------------------------------------------------------------
    def run(self) -> DataFrame:
        """All rounds; the status-log rows of the job with their round."""
        round_no = 1
        rows = self._step(1, "open", self._first)
        while not rows.isEmpty():
            assigned = self._step(round_no, "members", lambda: self._assigned(rows))
            outbox = self._step(round_no, "outbox", lambda: batching.outbox(assigned, f"{self.cfg.run_id}-{round_no}"))
            attempts = self._step(round_no, "attempts", lambda: self.sender(outbox, round_no))
            changes = self._step(round_no, "changes", lambda: self._changes(assigned, attempts, round_no))
            rows = self._step(round_no + 1, "open", lambda: self._next(rows, changes))
            round_no += 1
        return self.changes(round_no - 1)

    def _next(self, rows: DataFrame, changes: DataFrame) -> DataFrame:
        """Records of a round that failed and have tries left."""
        bad = changes.where(F.col("status") == sl.FAILED).select("table_name", "id")
        again = rows.join(bad, ["table_name", "id"], "left_semi")
        return self._retryable(again.withColumn("retry_count", (F.col("retry_count") + 1).cast("int"))
                               .withColumn("seq", F.col("seq") + 2)).select(*rows.columns)

    def changes(self, rounds: int) -> DataFrame:
        """Status-log rows of the first ``rounds`` rounds, with ``round``."""
        out = self.spark.createDataFrame([], sl.STATUS_LOG_SCHEMA).withColumn("round", F.lit(0))
        for n in range(1, rounds + 1):
            out = out.unionByName(self.spark.read.schema(sl.STATUS_LOG_SCHEMA).parquet(self._at(n, "changes")).withColumn("round", F.lit(n)))
        return out


def resend_result(changes: DataFrame, max_retry: int, base: DataFrame) -> DataFrame:
    """(table_name, id, rounds, report_status, retry_count, given_up, error_msg)
    of every record that the job took up; ``base`` has the retry counts before
    (table_name, id, retry_count)."""
    last = sl.latest_status(changes).select("table_name", "id", "status", "error_msg", "retry_bumps")
    rounds = changes.groupBy("table_name", "id").agg(F.max("round").alias("rounds"))
    before = base.select("table_name", "id", F.col("retry_count").alias("_before"))
    count = (F.col("_before") + F.col("retry_bumps")).cast("int")
    return (last.join(rounds, ["table_name", "id"]).join(before, ["table_name", "id"])
            .select("table_name", "id", "rounds", F.col("status").alias("report_status"), count.alias("retry_count"),
                    ((F.col("status") == sl.FAILED) & (count >= max_retry)).alias("given_up"), "error_msg"))


def round_summary(changes: DataFrame) -> DataFrame:
    """Per round and table: records taken up, delivered and failed."""
    s = F.col("status")
    return changes.groupBy("round", "table_name").agg(
        F.count(F.when(s == sl.PROCESSING, 1)).alias("sent"), F.count(F.when(s == sl.SUCCESS, 1)).alias("success"),
        F.count(F.when(s == sl.FAILED, 1)).alias("fail"))
