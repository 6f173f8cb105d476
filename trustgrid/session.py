"""Session helpers.

The library never hard-codes cluster settings. ``get_session`` is for tests,
benchmarks and local runs; on a cluster the caller's session is used as is.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "trustgrid") -> SparkSession:
    """Build (or reuse) a local session with AQE on and the UI off."""
    master = master or os.environ.get("TRUSTGRID_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.driver.memory", os.environ.get("TRUSTGRID_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder comes from the session conf and is never
    overridden. When it is unset the caller has to name one (``fallback``);
    a machine-local folder is never made up.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        if not fallback:
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        configured = fallback
        spark.conf.set(CHECKPOINT_CONF, configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured
