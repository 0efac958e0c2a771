"""Spark session helpers.

The library never creates its own cluster settings beyond what a job needs
to be deterministic: UTC session time, string partition columns, AQE on.
``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session and only
falls back to a scratch folder when the session has none (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a run depends on for correct, reproducible results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # dt=2024-01-05 must stay a string; inference would turn it into DATE
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "relaykit") -> SparkSession:
    """Session for tests and local runs (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Apply the result-relevant settings to an existing session."""
    for k, v in REQUIRED_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on an already started session
            pass


def session_key(spark: SparkSession) -> tuple[int, str]:
    """Identity of a live session for plan caches: a new session, or a new
    context after a stop, never matches an old entry."""
    return id(spark), spark.sparkContext.applicationId


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster, else a local scratch one.

    On a cluster ``spark.checkpoint.dir`` points to shared storage and is used
    as is. Only when it is unset in local mode (tests, a laptop) do we make our
    own; off it, executors would each write to their own disk, so it must be set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="relaykit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local
