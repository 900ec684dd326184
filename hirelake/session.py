"""Spark session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC calendar for month grains, AQE for
# runtime coalescing and skew splitting, Arrow for any pandas hand-off.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of materialised intermediates are removed once the
    # DataFrame that owns them is garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "hirelake") -> SparkSession:
    """Session for tests, bench and local runs; a cluster passes its own conf."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        # One machine: its own temporary folder is shared by all threads.
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="hirelake-ckpt-"))
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("HIRELAKE_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin_session(spark)
    return spark


def pin_session(spark: SparkSession) -> None:
    """Settings results depend on; applied to any session we are handed."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates: ``spark.checkpoint.dir``.

    Where that is unset the warehouse folder is used: every executor of a
    session must reach it anyway.  A machine-local folder is never made up.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique folder below the shared checkpoint root for written tables."""
    import uuid

    return f"{checkpoint_root(spark)}/hirelake/{name}-{uuid.uuid4().hex[:12]}"
