"""Row counts of stored partitions from their files' footers.

A ``count(*)`` grouped by partition columns needs no data: Parquet keeps the
number of rows in the footer. Spark pushes the count into its second-generation
Parquet source, which reads footers only (the plan shows ``PushedAggregation`` and
an empty read of columns). The setting belongs to a session of its own, so the
caller's plans stay as they are; the counts, a row per table and date, come back
into the caller's session.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import TableSpec
from .tables import dt_predicate, table_schema

PUSHED = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "",
          "spark.sql.sources.partitionColumnTypeInference.enabled": "false"}
COUNTS = "table_name string, dt string, n long"


def footer_session(spark: SparkSession) -> SparkSession:
    """A session over the same context that pushes counts into Parquet."""
    own = spark.newSession()
    for k, v in PUSHED.items():
        own.conf.set(k, v)
    return own


def footer_counts(own: SparkSession, path: str, spec: TableSpec, dates: Iterable[str] | Column | None = None,
                  key_col: str | None = "event_id") -> DataFrame:
    """(table_name, dt, n) of one stored table; ``own`` is a :func:`footer_session`."""
    df = own.read.schema(table_schema(spec, key_col)).parquet(path)
    if dates is not None:
        df = df.where(dt_predicate(dates))
    return df.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).select(F.lit(spec.table_name).alias("table_name"), "dt", "n")


def partition_counts(spark: SparkSession, paths: Mapping[TableSpec, str], dates: Iterable[str] | Column | None = None,
                     key_col: str | None = "event_id") -> DataFrame:
    """(table_name, dt, n) of every stored table, as :func:`audit.partition_counts`,
    for dates with files; a table without a folder has no rows."""
    own = footer_session(spark)
    parts = []
    for spec, path in paths.items():
        try:
            parts.append(footer_counts(own, path, spec, dates, key_col))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    rows = []
    if parts:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        rows = [tuple(r) for r in out.where("n > 0").collect()]  # a row per table and date
    return spark.createDataFrame(rows, COUNTS)
