"""The report run as one Spark plan: every table and every date in parallel.

    tables ─► payloads ─► ordinals/pages/batches ─► outbox ─► (transport)
                                   │                               │
                                members ◄──── outcomes ◄──── attempt log
                                   │
                     record outcomes ─► dead letters, table results, summary

``ReportRun`` keeps the intermediate DataFrames lazily; ``write`` persists
the outputs (outbox, members, dead letters, table results) so that a rerun of
the same ``run_id`` replaces its tables and dates instead of duplicating them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, batching, delivery, transform
from ..registry import REGISTRY, Registry, mode_map, parse_mode, resolve_modes

DEFAULT_INGEST_MS = 1706745600000  # 2024-02-01T00:00:00Z: processing time of test runs


@dataclass
class RunConfig:
    """``ingest_ms``: processing time of the run; None takes the time at which
    the run is made. ``dates``: dates asked for, summed up even without rows.
    ``unique_key``: whether ``key`` tells rows apart; False for tables without
    a row id, keyed by a hash (:func:`sources.tables.with_row_key`)."""
    run_id: str = "run"
    ingest_ms: int | None = None
    batch_size: int = 20
    page_size: int = 1000
    max_attempts: int = 3
    mode_overrides: Mapping[str, str] = field(default_factory=dict)
    key: str = "event_id"
    bucket_rows: int = 1 << 20
    unique_key: bool = True
    dates: Sequence[str] = ()
    #: Rows of tables outside the registry become dead letters instead of an error.
    reject_unknown: bool = False

    def __post_init__(self):
        batching.check_batch_size(self.batch_size)
        if not 1 <= self.page_size <= 10000:
            raise ValueError("page size must be within 1..10000")
        if not 0 <= self.max_attempts <= 10:
            raise ValueError("max attempts must be within 0..10")


def _materialize(df: DataFrame) -> DataFrame:
    """Persist and fill the cache with one job. Filling it lazily would let
    every branch that reads it (both halves of the outbox, members, attempts)
    start its own computation of the same shuffle."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.write.format("noop").mode("overwrite").save()
    return df


class ReportRun:
    """One report run over ``tables`` (name → DataFrame with ``dt``, the key
    and the registry fields).

    ``cache``: fill the assigned rows and the attempt log once and share them
    between all outputs (use when several outputs are read).
    ``reject_if``: per table, a condition marking rows as failed transforms.
    ``scripted_attempts``: account from a deterministic test attempt log
    instead of an empty one (no network in tests). ``send`` or
    ``use_attempts`` replaces either.
    """

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame],
                 config: RunConfig | None = None, registry: Registry = REGISTRY,
                 reject_if: Mapping[str, Column] | None = None, cache: bool = False,
                 scripted_attempts: bool = False):
        self.cache = cache
        self.scripted_attempts = scripted_attempts
        self.spark = spark
        self.tables = dict(tables)
        self.cfg = config or RunConfig()
        if self.cfg.ingest_ms is None:
            self.cfg = replace(self.cfg, ingest_ms=time.time_ns() // 1_000_000)
        self.registry = registry
        self.reject_if = reject_if

    @cached_property
    def registry_df(self) -> DataFrame:
        return self.registry.to_df(self.spark)

    @cached_property
    def modes(self) -> DataFrame:
        ov = None
        if self.cfg.mode_overrides:
            ov = self.spark.createDataFrame(list(self.cfg.mode_overrides.items()), "table_name string, mode string")
        return resolve_modes(self.registry_df, ov)

    @cached_property
    def payloads(self) -> DataFrame:
        return transform.payloads_all(self.tables, self.cfg.ingest_ms, self.registry,
                                      (self.cfg.key,), with_record=True, reject_if=self.reject_if, reject_unknown=self.cfg.reject_unknown)

    @cached_property
    def counts(self) -> DataFrame:
        return audit.partition_counts(self.tables)

    @cached_property
    def assigned(self) -> DataFrame:
        """Every source row with its ordinal, page, mode and request number.

        With ``cache`` the rows are persisted (memory, spilling to disk): the
        outbox, the members and the dead letters all read them. A lost
        executor's blocks are recomputed from lineage, which is exact since
        the ordinal is deterministic."""
        # only what the outbox, members and dead letters read crosses the
        # shuffle (the payload struct is already serialised in ``body``)
        needed = ["table_name", "dt", self.cfg.key, "user_unique_id", "body", "error", "record_json"]
        modes = mode_map(self.registry, dict(self.cfg.mode_overrides))
        a = batching.assign_requests(self.payloads.select(*needed), modes, self.cfg.batch_size,
                                     self.cfg.page_size,
                                     self.cfg.key, may_have_errors=self.reject_if is not None or self.cfg.reject_unknown,
                                     bucket_rows=self.cfg.bucket_rows, unique_key=self.cfg.unique_key)
        return _materialize(a) if self.cache else a

    @cached_property
    def outbox(self) -> DataFrame:
        return batching.outbox(self.assigned, self.cfg.run_id)

    @cached_property
    def members(self) -> DataFrame:
        return batching.members(self.assigned, self.cfg.key).withColumn("run_id", F.lit(self.cfg.run_id))

    @cached_property
    def plan(self) -> DataFrame:
        return batching.request_plan(self.counts, self.modes, self.cfg.batch_size, self.cfg.page_size,
                                     self.cfg.max_attempts)

    # delivery -----------------------------------------------------------
    attempts_override: DataFrame | None = None

    # everything computed from the attempt log
    _ATTEMPT_DEPENDENT = ("attempts", "classified", "outcome", "record_outcomes",
                          "dead_letters", "table_results", "summary")

    def use_attempts(self, attempts: DataFrame) -> ReportRun:
        """Account from ``attempts`` from now on; results built from an
        earlier log are dropped (and an old cached log released)."""
        old = self.__dict__.get("classified")
        if old is not None and self.cache:
            old.unpersist()
        self.attempts_override = attempts
        for k in self._ATTEMPT_DEPENDENT:
            self.__dict__.pop(k, None)
        return self

    def send(self, transport: Callable[[str, str], tuple[int, str]], log_path: str | None = None,
             retry_delay_ms: int = 0, partitions: int | None = None) -> DataFrame:
        """Deliver the outbox and keep the attempt log.

        The log is written once (to ``log_path``, else a fresh folder under
        the session's ``spark.checkpoint.dir``) and read back, so later uses
        of outcomes or dead letters never call the transport again. A task
        retried after a lost executor may resend its own requests
        (at-least-once); the delivery key lets the receiver drop repeats.
        """
        if log_path is None:
            import uuid

            from ..session import checkpoint_dir
            log_path = f"{checkpoint_dir(self.spark).rstrip('/')}/attempts-{self.cfg.run_id}-{uuid.uuid4().hex[:12]}"
        # the number of outbox partitions is the number of concurrent senders
        ob = self.outbox.repartition(partitions) if partitions else self.outbox
        log = delivery.deliver(ob, transport, self.cfg.max_attempts, self.cfg.run_id, retry_delay_ms)
        log.write.mode("overwrite").parquet(log_path)
        stored = self.spark.read.schema(delivery.ATTEMPT_SCHEMA).parquet(log_path)
        self.use_attempts(stored)
        return stored

    @cached_property
    def attempts(self) -> DataFrame:
        """This run's attempt log: given (``use_attempts`` / ``send``; other
        runs' attempts in it are left out), the scripted test log when asked
        for, else empty (every request still unsent)."""
        if self.attempts_override is not None:
            return self.attempts_override.where(F.col("run_id") == self.cfg.run_id)
        if self.scripted_attempts:
            return delivery.scripted_attempts(self.outbox, self.cfg.run_id)
        return self.spark.createDataFrame([], delivery.ATTEMPT_SCHEMA)

    @cached_property
    def classified(self) -> DataFrame:
        """Attempts with ok flag, error text and parsed response. Cached runs
        keep it (a stored table in production: the transport's log)."""
        c = delivery.classify(self.attempts)
        return _materialize(c) if self.cache else c

    @cached_property
    def outcome(self) -> DataFrame:
        return delivery.outcomes(self.classified, self.modes, self.cfg.max_attempts)

    @cached_property
    def record_outcomes(self) -> DataFrame:
        return delivery.record_outcomes(self.members, self.outcome, self.cfg.key)

    @cached_property
    def dead_letters(self) -> DataFrame:
        return audit.dead_letters(self.record_outcomes, self.cfg.run_id)

    @cached_property
    def table_results(self) -> DataFrame:
        return audit.table_results(self.counts, self.record_outcomes)

    @cached_property
    def summary(self) -> DataFrame:
        return audit.run_summary(self.table_results, self.cfg.dates)

    def write(self, base_path: str, fmt: str = "parquet") -> None:
        """Persist run outputs under
        ``base_path/<name>/run_id=.../table_name=.../dt=...``.

        Dynamic partition overwrite replaces only the partitions this run
        wrote; what an earlier run of the id left for a (table, dt) of this
        run that has no rows any more is taken away, so a rerun is idempotent
        and leaves other tables and dates alone. The four outputs share the
        assigned rows: an uncached run persists them for the duration of the
        writes, so the ordinal shuffle runs once.
        """
        shared = None if self.cache else self.assigned.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            outs = {"outbox": self.outbox, "members": self.members,
                    "dead_letters": self.dead_letters,
                    "table_results": self.table_results.withColumn("ingest_ms", F.lit(self.cfg.ingest_ms).cast("long"))}
            # one row per table and date of the run
            scope = {(r[0], r[1]) for r in self.counts.select("table_name", "dt").collect()}
            scope |= {(t, d) for t in self.tables for d in self.cfg.dates}
            for name, df in outs.items():
                d = df if "run_id" in df.columns else df.withColumn("run_id", F.lit(self.cfg.run_id))
                (d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("run_id", "table_name", "dt").format(fmt).save(f"{base_path}/{name}"))
                if name in ("outbox", "dead_letters"):  # the others have rows wherever the run has
                    has = {(r[0], r[1]) for r in df.select("table_name", "dt").distinct().collect()}
                    self._drop_partitions(f"{base_path}/{name}", scope - has)
        finally:
            if shared is not None:
                shared.unpersist()

    def _drop_partitions(self, path: str, parts: set[tuple[str, str]]) -> None:
        jvm = self.spark._jvm
        escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table, dt in sorted(parts, key=str):
            day = "__HIVE_DEFAULT_PARTITION__" if dt is None else escape(dt)
            at = jvm.org.apache.hadoop.fs.Path(f"{path}/run_id={escape(self.cfg.run_id)}/table_name={table}/dt={day}")
            at.getFileSystem(conf).delete(at, True)


def parse_overrides(pairs: Mapping[str, str]) -> dict[str, str]:
    """Raw ``report.mode.<table>`` texts → SINGLE/BATCH, unknown tables dropped."""
    out = {}
    for t, m in pairs.items():
        if REGISTRY.is_valid(t):
            out[t] = "SINGLE" if (m or "").strip().upper() == "SINGLE" else "BATCH"
    return out


__all__ = ["ReportRun", "RunConfig", "parse_overrides", "parse_mode"]


LOG_TS = "2024-02-01 00:00:00.000"


def run_log(run: ReportRun, ts: str = LOG_TS) -> DataFrame:
    """The run's main log as text lines: per-table results and per-date
    summaries (INFO), failed attempts (WARN), failed records (ERROR)."""
    from ..sources.logs import main_line

    t = F.lit(ts)
    tr = run.table_results.select(main_line(t, "INFO", "relaykit.run", F.format_string(
        "%s: %d rows, %d delivered, %d not delivered", "table_name", "total", "success", "fail"))
        .alias("value"))
    sm = run.summary.where(F.col("level") == "date").select(
        main_line(t, "INFO", "relaykit.run", F.col("line")).alias("value"))
    warn = run.classified.where(~F.col("ok")).select(main_line(t, "WARN", "relaykit.run", F.format_string(
        "try %d of a request of %s: %s", "attempt", "table_name", "error")).alias("value"))
    err = audit.failed_line(run.dead_letters).select(
        main_line(t, "ERROR", "FAILED_RECORDS", F.col("value")).alias("value"))
    return tr.unionByName(sm).unionByName(warn).unionByName(err)


def failed_records_file(run: ReportRun, ts: str = LOG_TS) -> DataFrame:
    """The failed-records file: ``<ts> - FAILED: ...`` per dead letter."""
    from ..sources.logs import failed_file_line
    return audit.failed_line(run.dead_letters).select(
        failed_file_line(F.lit(ts), F.col("value")).alias("value"))
