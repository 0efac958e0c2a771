"""A report run in which a failing table does not end the others.

Every table is reported under a job tag of its own, several at a time. A table
whose jobs fail, or take longer than allowed (then its tag is cancelled), has no
results; the summary has an error row in their place and counts one failure, and
the other tables run to their end. An interrupt cancels what is still running.

The tables share the executors through Spark's scheduler; the driver holds one
thread per running table and one outcome per table.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit
from ..registry import REGISTRY, Registry
from .report_run import ReportRun, RunConfig

#: A table's reader: called under the table's tag, so a reader that fails is
#: a failed table too.
Reader = Callable[[], DataFrame]
ERROR_CHARS = 500
RESULTS = "table_name string, dt string, total long, success long, fail long, unsent long"
ERRORS = "table_name string, error string"


@dataclass
class TableFailure:
    table_name: str
    error: str


def error_text(e: BaseException) -> str:
    """The message that the failing expression or task gave, on one line."""
    text = str(e).strip()
    for line in text.splitlines():
        if "[" in line and "]" in line:  # Spark's errors name a condition in brackets
            text = line[line.index("["):]
            break
    return text.replace("\n", " ")[:ERROR_CHARS] or type(e).__name__


class IsolatedRun:
    """``tables``: name → DataFrame or reader. ``write_to``: folder for the run's
    outputs (see :meth:`ReportRun.write`); a table that fails leaves none of this
    run there. ``attempts``: called with a table's run, gives its attempt log."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame | Reader], config: RunConfig | None = None,
                 registry: Registry = REGISTRY, at_once: int = 4, timeout_s: float | None = None,
                 write_to: str | None = None, attempts: Callable[[ReportRun], DataFrame] | None = None):
        self.spark, self.tables, self.registry = spark, dict(tables), registry
        self.cfg = config or RunConfig()
        self.at_once, self.timeout_s = max(1, at_once), timeout_s
        self.write_to, self.attempts = write_to, attempts
        self.failures: list[TableFailure] = []
        self._rows: list[tuple] = []
        self._mark = f"{self.cfg.run_id}-{uuid.uuid4().hex[:8]}".replace(",", "_")

    def tag(self, name: str) -> str:
        return f"{self._mark}-{name}".replace(",", "_")

    def _report(self, name: str) -> list[tuple]:
        """Results of one table per date: a row for each date it has."""
        sc = self.spark.sparkContext
        sc.addJobTag(self.tag(name))
        clock = threading.Timer(self.timeout_s, lambda: sc.cancelJobsWithTag(self.tag(name))) if self.timeout_s else None
        if clock:
            clock.start()
        run = None
        try:
            df = self.tables[name]
            run = ReportRun(self.spark, {name: df() if callable(df) else df}, self.cfg, self.registry, cache=True)
            if self.attempts:
                run.use_attempts(self.attempts(run))
            if self.write_to:
                run.write(self.write_to)
            return [tuple(r) for r in run.table_results.select(*[c.split()[0] for c in RESULTS.split(", ")]).collect()]
        except BaseException:
            if self.write_to:
                self._take_back(name)
            raise
        finally:
            if clock:
                clock.cancel()
            for kept in ("assigned", "classified"):
                if run is not None and kept in run.__dict__:
                    getattr(run, kept).unpersist()
            sc.removeJobTag(self.tag(name))

    def _take_back(self, name: str) -> None:
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        run_id = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(self.cfg.run_id)
        for out in ("outbox", "members", "dead_letters", "table_results"):
            at = jvm.org.apache.hadoop.fs.Path(f"{self.write_to}/{out}/run_id={run_id}/table_name={name}")
            at.getFileSystem(conf).delete(at, True)

    def run(self) -> DataFrame:
        """Report every table; the summary (:meth:`summary`)."""
        with ThreadPoolExecutor(self.at_once) as pool:
            jobs = {n: pool.submit(inheritable_thread_target(self.spark)(self._report), n) for n in self.tables}
            try:
                for name, job in jobs.items():
                    e = job.exception()
                    if e is None:
                        self._rows += job.result()
                    else:
                        self.failures.append(TableFailure(name, error_text(e)))
            except BaseException:
                for name, job in jobs.items():
                    job.cancel()
                    self.spark.sparkContext.cancelJobsWithTag(self.tag(name))
                raise
        return self.summary()

    def summary(self) -> DataFrame:
        """Totals per date and table and overall, as :func:`audit.run_summary`
        gives them, and level ``error`` with the text for each failed table. An
        error row counts one failure, in the overall row too."""
        s = audit.run_summary(self.spark.createDataFrame(self._rows, RESULTS), self.cfg.dates).withColumn("error", F.lit(None).cast("string"))
        if not self.failures:
            return s
        n = len(self.failures)
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        if not self._rows and not self.cfg.dates:  # no table has a row: the overall row is still there
            s = self.spark.createDataFrame([("all",)], "level string").select(
                *[(F.lit("all") if f.name == "level" else F.lit(None)).cast(f.dataType).alias(f.name) for f in s.schema])
        bad = (self.spark.createDataFrame([(f.table_name, f.error) for f in self.failures], ERRORS)
               .select(F.lit(None).cast("string").alias("dt"), "table_name", F.lit("error").alias("level"), none.alias("total"),
                       none.alias("success"), one.alias("fail"), F.lit(audit.SUMMARY_LINE % (0, 0, 1)).alias("line"), "error"))
        fail = F.when(F.col("level") == "all", F.coalesce("fail", none) + n).otherwise(F.col("fail"))
        s = s.withColumn("fail", fail).withColumns({c: F.coalesce(c, none) for c in ("total", "success")})
        line = F.format_string(audit.SUMMARY_LINE, "total", "success", "fail")
        return s.withColumn("line", line).unionByName(bad)
