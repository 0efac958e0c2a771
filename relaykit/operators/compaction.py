"""Compaction of the status log into its base table.

Plain files have no UPDATE, so changes are appended to a status log and the
current rows are base and log together (:func:`status_log.apply_status`). When
the log grows, :func:`compact` folds it in and rewrites only the partitions that
it touches.

    <base>/rows/table_name=.../id_block=...   the rows, by blocks of ``block`` ids
    <base>/folded/batch=<n>                    one empty folder per compaction:
                                               the log up to batch n is in the rows
    <base>/staged/batch=<n>                    rewritten partitions on their way
    <log>/batch=<n>                            appended changes, numbered upwards

The block of a change follows from its id, so touched partitions are known from
the log alone; they reach the scan of the rows as a dynamic partition filter, and
other partitions are neither read nor written: their files keep their names.

Rewritten partitions are staged in full before they replace the old ones. A
compaction that died before its staging was complete has changed nothing; one
that died later is finished by the next call from the staged rows (replacing a
partition twice gives the same), so a change is never counted twice. Compactions
of one base run one at a time, and readers wait for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import status_log as sl

BLOCK_IDS = 1 << 20
#: Rows of all tables that a block of :func:`block_for` holds, about.
BLOCK_ROWS = 1 << 20
PARTITION = ("table_name", "id_block")
#: Touched partitions that are sent to every task; more are left to the optimiser.
BROADCAST_PARTITIONS = 100_000
LOG_SCHEMA = T.StructType([*sl.STATUS_LOG_SCHEMA.fields, T.StructField("batch", T.LongType())])


def id_block(block: int = BLOCK_IDS, col: str = "id") -> Column:
    return F.floor(F.col(col) / F.lit(block)).cast("long")


def block_for(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> int:
    """Ids per block for a table with these rows: as many blocks as ``block_rows``
    asks for, so files grow in size before they grow in number. The ids' span is
    taken without the outer twentieths, where a few far ids may lie."""
    n, ends = rows.agg(F.count("id"), F.percentile_approx("id", [0.05, 0.95], F.lit(1000))).first()
    if not n:
        return BLOCK_IDS
    return max(1, int((ends[1] - ends[0] + 1) / 0.9 / -(-n // block_rows)))


class StatusTable:
    """A base table with its status log. ``schema``: the rows' columns, with
    table_name, id, report_status, retry_count, updated_at and error_msg."""

    def __init__(self, spark: SparkSession, base: str, log: str, schema: T.StructType, block: int = BLOCK_IDS):
        self.spark, self.base, self.log, self.block = spark, base.rstrip("/"), log.rstrip("/"), block
        kept = [f for f in schema.fields if f.name not in PARTITION]
        self.columns = [f.name for f in schema.fields]
        self.schema = T.StructType([*kept, T.StructField("table_name", T.StringType()), T.StructField("id_block", T.LongType())])

    # -- files ------------------------------------------------------------------
    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _batches(self, path: str, whole: bool = False) -> list[int]:
        """Numbers of the ``batch=<n>`` folders, with ``whole`` those that a job finished."""
        at, fs = self._fs(path)
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]
        found = sorted(int(n[6:]) for n in names if n.startswith("batch="))
        return [b for b in found if not whole or self._has(f"{path}/batch={b}/_SUCCESS")]

    def _has(self, path: str) -> bool:
        at, fs = self._fs(path)
        return fs.exists(at)

    def _delete(self, path: str) -> None:
        at, fs = self._fs(path)
        fs.delete(at, True)

    # -- rows and log -------------------------------------------------------------
    def create(self, rows: DataFrame) -> None:
        """Write the first rows; fails where there are some."""
        (rows.select(*self.columns).withColumn("id_block", id_block(self.block))
         .repartition(*PARTITION).write.partitionBy(*PARTITION).mode("error").parquet(f"{self.base}/rows"))

    def append(self, changes: DataFrame) -> int:
        """Add status-log rows (:func:`status_log.status_changes`) as the next
        batch; its number."""
        n = max([0, *self._batches(self.log), *self._batches(f"{self.base}/folded")]) + 1
        changes.select(*sl.STATUS_LOG_SCHEMA.fieldNames()).write.mode("error").parquet(f"{self.log}/batch={n}")
        return n

    def folded(self) -> int:
        """The last batch that the rows hold."""
        return max(self._batches(f"{self.base}/folded"), default=0)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.base}/rows")

    def changes(self, after: int, upto: int | None = None) -> DataFrame:
        """Log rows of the finished batches after ``after``; other batches are
        not read."""
        batches = [b for b in self._batches(self.log, whole=True) if b > after and (upto is None or b <= upto)]
        if not batches:
            return self.spark.createDataFrame([], LOG_SCHEMA)
        log = self.spark.read.schema(LOG_SCHEMA).option("basePath", self.log)
        # the predicate is what lets the optimiser prune the rows by the log
        return log.parquet(*[f"{self.log}/batch={b}" for b in batches]).where(F.col("batch") > after)

    def current(self) -> DataFrame:
        """The rows with all changes, folded or not."""
        self.recover()
        return sl.apply_status(self.rows(), self.changes(self.folded()).drop("batch")).select(*self.columns)

    # -- compaction ---------------------------------------------------------------
    def touched(self, changes: DataFrame) -> DataFrame:
        return changes.select("table_name", id_block(self.block).alias("id_block")).distinct()

    def _pruned(self, changes: DataFrame) -> DataFrame:
        """Rows of the touched partitions. The filter is a join on partition
        columns, so it reaches the scan at run time."""
        t = self.touched(changes)
        if t.limit(BROADCAST_PARTITIONS + 1).count() <= BROADCAST_PARTITIONS:
            t = F.broadcast(t)
        return self.rows().join(t, list(PARTITION), "left_semi")

    def compact(self) -> int:
        """Fold the log in; the number of the last batch that the rows hold."""
        self.recover()
        done = self.folded()
        new = [b for b in self._batches(self.log, whole=True) if b > done]
        if not new:
            return done
        changes = self.changes(done, new[-1]).drop("batch")
        staged = f"{self.base}/staged/batch={new[-1]}"
        rewritten = sl.apply_status(self._pruned(changes), changes)
        (rewritten.select(*self.columns, "id_block").repartition(*PARTITION)
         .write.partitionBy(*PARTITION).mode("overwrite").parquet(staged))
        return self.recover()

    def recover(self) -> int:
        """Finish a compaction that was staged in full, drop one that was not."""
        for b in self._batches(f"{self.base}/staged"):
            staged = f"{self.base}/staged/batch={b}"
            if self._has(f"{staged}/_SUCCESS") and b > self.folded():
                rows = self.spark.read.schema(self.schema).parquet(staged)
                (rows.repartition(*PARTITION).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy(*PARTITION).parquet(f"{self.base}/rows"))
                at, fs = self._fs(f"{self.base}/folded/batch={b}")
                fs.mkdirs(at)
            self._delete(staged)
        return self.folded()
