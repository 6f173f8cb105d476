"""Sharding by best-fit-decreasing bin packing of indivisible groups.

A group is all rows of one text (by 64-bit hash: a collision only binds two groups together). Groups sorted by size
enter the bin with the tightest remaining capacity that still holds them, found in a balanced tree.

Groups of one size are interchangeable, so the driver packs runs (size, how many): the tightest bin that holds one
group of a size stays the tightest until it holds no other, so a run fills bin after bin exactly as its groups would one
by one. The driver holds one entry per distinct size of a group and per share of a run in a bin. Distinct sizes are
at most twice the root of all bytes (small sizes are few, large groups are few), in practice as many as lengths of
texts. Inside a run the groups' places, found in ranges of (size, hash), decide which share they belong to. Sizes, hashes,
places and slots are computed by Spark; texts are never shuffled.

Null texts count as empty: size 16 and one group. Repeated rows are rows of their own. A group larger than its fair
share gets a shard to itself and the rest is levelled over the other shards. An empty table gives no rows.
"""

from __future__ import annotations

import random
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustgrid.operators.joins import many_to_one_join
from trustgrid.operators.ranking import places

from .common import saved

ROW_BYTES = 16
HOT_GROUPS = 10_000
ROWS_PER_SLOT_BLOCK = 1024


class CapacityTree:
    """Balanced tree (treap) over (remaining capacity, bin): insert, and take the tightest one that holds a size."""

    def __init__(self) -> None:
        self._root = None
        self._random = random.Random(7)

    def insert(self, key: tuple[int, int]) -> None:
        less, more = self._split(self._root, key)
        node = [key, self._random.random(), None, None]
        self._root = self._merge(self._merge(less, node), more)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the smallest key with remaining capacity >= size."""
        less, more = self._split(self._root, (size, -1))
        node = more
        while node is not None and node[2] is not None:
            node = node[2]
        if node is None:
            self._root = less
            return None
        _, rest = self._split(more, (node[0][0], node[0][1] + 1))
        self._root = self._merge(less, rest)
        return node[0]

    def _split(self, node, key):
        """Trees of the keys below ``key`` and of the rest."""
        if node is None:
            return None, None
        if node[0] < key:
            less, more = self._split(node[3], key)
            return [node[0], node[1], node[2], less], more
        less, more = self._split(node[2], key)
        return less, [node[0], node[1], more, node[3]]

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return [a[0], a[1], a[2], self._merge(a[3], b)]
        return [b[0], b[1], self._merge(a, b[2]), b[3]]


Shares = list[list[tuple[int, int]]]        # per run: (bin, groups of the run in it), in the order of the fill


def best_fit_decreasing(runs: list[tuple[int, int]], capacity: int, most: int | None = None) -> Shares | None:
    """Bins of runs (size, how many), sizes descending; a new bin opens when none has room. None if there are more than
    ``most``."""
    tree, bins, out = CapacityTree(), 0, []
    for size, many in runs:
        shares = []
        while many:
            hit = tree.take(size)
            if hit is None:
                hit = (max(capacity, size), bins)
                bins += 1
                if most is not None and bins > most:
                    return None
            k = min(many, hit[0] // size)
            shares.append((hit[1], k))
            many -= k
            tree.insert((hit[0] - k * size, hit[1]))
        out.append(shares)
    return out


def level_bins(runs: list[tuple[int, int]], n: int) -> Shares:
    """Pack into at most ``n`` bins with the least capacity found: own bins for oversize groups, then a bisection."""
    total, alone, out, rest = sum(s * k for s, k in runs), 0, [], []
    for size, many in runs:
        own = []
        while many and not rest and n - alone > 1 and size * (n - alone) > total:
            own.append((alone, 1))
            total, alone, many = total - size, alone + 1, many - 1
        out.append(own)
        rest.append((size, many)) if many else None
    left = n - alone
    if not rest:
        return out
    low = max(-(-total // left), rest[0][0])
    step, best = 0, best_fit_decreasing(rest, low, left)
    while best is None:
        step = step * 2 or max(1, low // 4096)
        best = best_fit_decreasing(rest, low + step, left)
    floor = step // 2
    while step - floor > max(1, low // 100_000):
        middle = (step + floor) // 2
        packed = best_fit_decreasing(rest, low + middle, left)
        if packed is None:
            floor = middle
        else:
            step, best = middle, packed
    for shares, more in zip(out[len(out) - len(rest):], best):
        shares += [(b + alone, k) for b, k in more]
    return out


def pack_shards(docs: DataFrame, n_shards: int | None = 40, capacity: int | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Rows (id, size, text_crc32, shard, slot). Either level ``n_shards`` shards, or the fewest of ``capacity`` bytes."""
    spark = docs.sparkSession
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = saved(docs.select(F.col(id_col), (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
                             F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("grp")), "rows")
    groups = saved(rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    classes = groups.groupBy("bytes").agg(F.count("*").alias("many"), F.sum("n").alias("n")).collect()
    n_rows = sum(r["n"] for r in classes)
    runs = sorted(((r["bytes"], r["many"]) for r in classes), reverse=True)
    shares = best_fit_decreasing(runs, capacity) if n_shards is None else level_bins(runs, n_shards)
    plan = spark.createDataFrame(
        [(size, list(accumulate(k for _, k in own)), [b for b, _ in own]) for (size, _), own in zip(runs, shares)],
        "run long, ends array<long>, bins array<int>")
    placed = many_to_one_join(places(groups, ["grp"], ["bytes"], size=None), plan, ["bytes"], ["run"], "inner")
    before = F.size(F.filter("ends", lambda end: end <= F.col("pos")))
    placed = saved(placed.select("grp", "n", F.element_at("bins", before + 1).alias("shard")), "placed")
    # texts with many copies (at most ``HOT_GROUPS`` of them) go to the rows; the others' rows are joined by text
    hot = F.col("n") * HOT_GROUPS >= n_rows
    large = placed.filter(hot).select(F.col("grp").alias("g"), F.col("shard").alias("hot_shard"))
    split = rows.join(F.broadcast(large), F.col("grp") == F.col("g"), "left").drop("g")
    keep = [id_col, "size", "text_crc32", "shard", "grp"]
    cold = split.filter("hot_shard is null").drop("hot_shard").join(placed.filter(~hot).select("grp", "shard"), "grp")
    sent = split.filter("hot_shard is not null").withColumnRenamed("hot_shard", "shard").select(*keep).unionByName(cold.select(*keep))
    count = n_shards or 1 + max((b for own in shares for b, _ in own), default=0)
    return with_slots(sent, id_col, max(1, -(-n_rows // (count * ROWS_PER_SLOT_BLOCK)))).drop("grp")


def with_slots(placed: DataFrame, id_col: str, blocks: int) -> DataFrame:
    """Gapless ``slot`` per shard: counts of small blocks give offsets, row numbers run inside a block only."""
    keyed = placed.withColumn("block", F.pmod(F.xxhash64(id_col, "text_crc32"), F.lit(blocks)))
    counts = keyed.groupBy("shard", "block").agg(F.count("*").alias("block_rows"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("shard").alias("s"), F.col("block").alias("b"),
                            F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "block").orderBy(F.col(id_col), "text_crc32", "grp", "size")
    return (keyed.withColumn("nth", F.row_number().over(inside))
            .join(offsets, (F.col("shard") == F.col("s")) & (F.col("block") == F.col("b")))
            .withColumn("slot", (F.col("offset") + F.col("nth") - 1).cast("long"))
            .drop("s", "b", "block", "nth", "offset"))


def op9_bin_packing(docs: DataFrame) -> DataFrame:
    """All documents in shards 0 to 39, near equal in bytes."""
    return pack_shards(docs, 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))
