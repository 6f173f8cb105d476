"""Tables between the steps of a job, kept in the folder that all executors share.

A staged table cuts lineage and survives lost executors. It goes below ``spark.checkpoint.dir``; only a local session
without that setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from trustgrid.session import CHECKPOINT_CONF, ensure_checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    local = spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")
    fallback = None
    if local and not spark.conf.get(CHECKPOINT_CONF, None):
        fallback = tempfile.mkdtemp(prefix="trustgrid-")
    return ensure_checkpoint_dir(spark, fallback).rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh place in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/trustgrid-stage/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
