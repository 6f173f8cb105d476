"""Global places in an order without a single-task window.

Rows are dealt into ranges of the sort key and sorted inside them; the table is staged once, so that the ranges stand.
Counts per (group, range) give every range its offset: at most one row per group and range is summed up in a window.
A row's place is its range's offset plus its number inside the range. A group that holds a third of all rows is spread
over as many ranges as its rows fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgrid.sources.staging import staged

RANGE, ROW = "__range", "__row"
IN_PARTITION = (1 << 33) - 1        # the low bits of monotonically_increasing_id count rows inside a partition


def places(rows: DataFrame, order: Sequence[str | Column], group: Sequence[str] = (), pos: str = "pos",
           size: str | None = "n", partitions: int | None = None) -> DataFrame:
    """``rows`` with ``pos``, the place from 0 in the group by ``order``, and ``size``, the rows of the group.

    Null groups are a group. Rows that ``order`` does not tell apart get neighbouring places in any order. An empty
    table stays empty. All columns pass through.
    """
    spark = rows.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group, *order]
    ranged = staged(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumns({
        RANGE: F.spark_partition_id(), ROW: F.monotonically_increasing_id().bitwiseAND(F.lit(IN_PARTITION))}), "ranged")
    per = ranged.groupBy(*group, RANGE).agg(F.min(ROW).alias("__first"), F.count("*").alias("__rows"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    names = {g: f"__group{i}" for i, g in enumerate(group)}
    offsets = per.select(
        *[F.col(g).alias(n) for g, n in names.items()], F.col(RANGE).alias("__of"),
        (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__offset"),
        F.sum("__rows").over(whole).alias("__size"))
    on = F.col(RANGE) == F.col("__of")
    for g, n in names.items():
        on = on & F.col(g).eqNullSafe(F.col(n))
    # without groups there is one row per range
    joined = ranged.join(offsets if group else F.broadcast(offsets), on)
    out = [*rows.columns, (F.col(ROW) + F.col("__offset")).alias(pos)]
    return joined.select(*out, *([F.col("__size").alias(size)] if size else []))
