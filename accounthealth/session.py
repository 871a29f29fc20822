"""Spark session helpers.

On a cluster the session comes from the platform; ``configure`` only sets the
SQL options this library relies on (AQE, skew join, UTC). ``local_session``
is for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # an aggregate or window on the join key stands above the join: split a hot
    # key all the same, at the price of one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL options the operators assume."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "accounthealth") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no extra ports)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cpus
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ACCOUNTHEALTH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoints taken for shared frames are removed once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    return sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder on the storage all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a private one only where unset.

    A configured cluster value is always kept; the fallback exists for a local
    master alone, where the driver and executors share one machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    folder = sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="accounthealth-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()
