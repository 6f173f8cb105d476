"""Corroboration: two independent estimates of one indicator, banded by gap.

Tolerance widens with how reconcilable the sources are (fixed values):

  indicator                 green if gap <   red if gap >
  institutional_delivery          8               20
  full_immunization              15               35
  anc_4_plus                     12               28

A gap on a cut-off is amber. The threshold table is a constant of three
rows: a broadcast join with a proven size bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLDS = (
    ("institutional_delivery", 8.0, 20.0),
    ("full_immunization", 15.0, 35.0),
    ("anc_4_plus", 12.0, 28.0),
)
# Never corroboration targets (contested method, diverging definitions).
EXCLUDED = ("anaemia", "c_section")


def thresholds_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(THRESHOLDS), "indicator string, green_gap_points double, red_gap_points double")


def gap_band(gap, green, red):
    """green if gap < green cut-off, red if gap > red cut-off, amber between (cut-offs are amber)."""
    return (F.when(gap < green, F.lit("green")).when(gap > red, F.lit("red"))
            .when(gap.isNotNull(), F.lit("amber")))


def corroboration_rejects(pairs: DataFrame, spark: SparkSession) -> DataFrame:
    """The rows of ``pairs`` that ``corroboration_bands`` cannot band, with the reason."""
    th = F.broadcast(thresholds_frame(spark).select(F.col("indicator").alias("_known")))
    why = (F.when(F.col("indicator").isNull(), "missing_indicator")
           .when(F.col("indicator").isin(*EXCLUDED), "excluded_indicator")
           .when(F.col("_known").isNull(), "no_threshold"))
    return (pairs.join(th, F.col("indicator") == F.col("_known"), "left")
            .withColumn("reject_reason", why).where(F.col("reject_reason").isNotNull()).drop("_known"))


def corroboration_bands(pairs: DataFrame, spark: SparkSession) -> DataFrame:
    """``pairs``: entity columns, ``indicator``, ``source_a``, ``source_b`` (percent points)."""
    th = F.broadcast(thresholds_frame(spark))
    gap = F.abs(F.col("source_a") - F.col("source_b"))
    return (pairs.where(~F.col("indicator").isin(*EXCLUDED))
            .join(th, "indicator", "inner")
            .withColumn("gap_points", gap)
            .withColumn("band", gap_band(F.col("gap_points"), F.col("green_gap_points"), F.col("red_gap_points"))))
