"""Publishing a partitioned table: staged write, manifest, swap of the partitions that the run holds, check.

A run is written to a place of its own first, so readers never see half of it and a lost executor costs a task, not the
table. Its manifest (rows and a hash per partition) is made from the staged rows. Then the partitions that occur in the
run replace those of the target (dynamic partition overwrite); all others stay. The target's partitions are read back
and compared with the manifest, which is kept beside the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_manifest"


class PublishError(RuntimeError):
    """The published partitions differ from the run's manifest."""


def partition_manifest(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """(partition, row_count, row_hash) per partition: one algebraic aggregation; the hash does not depend on order.

    Equal rows would cancel in an exclusive or, so hashes are added up (as decimals, so that a sum of any length fits).
    """
    values = [F.coalesce(F.col(c).cast("string"), F.lit("__null__")) for c in partition_by]
    name = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), v) for c, v in zip(partition_by, values)])
    hashed = F.xxhash64(*[F.col(c).cast("string") if c in partition_by else F.col(c) for c in sorted(df.columns)])
    return df.groupBy(name.alias("partition")).agg(
        F.count("*").alias("row_count"), F.sum(hashed.cast("decimal(38,0)")).alias("row_hash"))


def publish(df: DataFrame, target: str, partition_by: Sequence[str], run_id: str) -> DataFrame:
    """Publish the rows of a run; returns its manifest, also kept as a partition of ``target``/_manifest.

    ``run_id`` names the run: publishing the same run again replaces what it published. An empty run changes nothing.
    """
    spark = df.sparkSession
    base = target.rstrip("/")
    staged_at = f"{base}/_staged/{run_id}"
    df.write.mode("overwrite").parquet(staged_at)
    staged = spark.read.schema(df.schema).parquet(staged_at)
    manifest = partition_manifest(staged, partition_by).withColumn("run_id", F.lit(run_id))
    dynamic = {"partitionOverwriteMode": "dynamic"}
    manifest.write.mode("overwrite").options(**dynamic).partitionBy("run_id").parquet(f"{base}/{MANIFEST}")
    staged.write.mode("overwrite").options(**dynamic).partitionBy(*partition_by).parquet(f"{base}/data")
    kept = manifests(spark, base).where(F.col("run_id") == run_id)
    now = partition_manifest(published(spark, base, df), partition_by).select(
        F.col("partition").alias("p"), F.col("row_count").alias("n"), F.col("row_hash").alias("h"))
    wrong = kept.join(now, F.col("partition") == F.col("p"), "left").where(
        F.col("n").isNull() | (F.col("n") != F.col("row_count")) | (F.col("h") != F.col("row_hash")))
    if lost := [r["partition"] for r in wrong.select("partition").orderBy("partition").limit(20).collect()]:
        raise PublishError(f"{base}: partitions differ from run {run_id}: {lost}")
    return kept


def published(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    """The published table with the columns and types of ``like`` (partition columns are not guessed from their paths)."""
    return spark.read.schema(like.schema).parquet(f"{target.rstrip('/')}/data").select(*like.columns)


def manifests(spark: SparkSession, target: str) -> DataFrame:
    """The manifests of all runs."""
    return spark.read.schema("partition string, row_count long, row_hash decimal(38,0), run_id string").parquet(
        f"{target.rstrip('/')}/{MANIFEST}")
