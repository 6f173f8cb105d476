"""Connected components of an edge table, and joins that filter by a list of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

BROADCAST_IDS = 500_000       # about 40 MB as a hash table


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b): comp is the smallest node reachable.

    Alternates the large-star and small-star steps: each node of an edge hands its larger, then its smaller
    neighbours to the smallest one. Every step is a pre-aggregated minimum and a join, written to the shared folder;
    no neighbour list is gathered. Ends when a round changes nothing.
    """
    now = saved(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                "edges")
    mark = None
    while True:
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(sums) == mark or not sums[0]:
            break
        mark = tuple(sums)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large, "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = saved(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small_star")
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def small_filter(docs: DataFrame, ids: DataFrame, id_col: str, keep: bool = True) -> DataFrame:
    """Rows of ``docs`` whose id is (or is not) listed: a counted list is broadcast, a longer one is joined by shuffle."""
    ids = saved(ids, "ids")
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, id_col, "left_semi" if keep else "left_anti")
