"""N-gram Jaccard join with PartEnum signatures.

A document's set holds its distinct shingles of ``SHINGLE`` words (hashes of 64 bits). Two sets link when their
Jaccard similarity is ``percent`` / 100 or more. Sizes fall into bands whose members may link with the same or the
next band only; in a band a linking pair differs in at most k shingles. The domain of shingles is dealt into n1 * n2
partitions; k differences leave, in one of the n1 groups, at most k2 changed partitions, so the two sets agree on all
partitions of some subset of size n2 - k2. Every subset's content is one signature: sets that link share one.

Candidates are settled without listing all pairs of a bucket. Equal sets are one node. In each bucket the node that
shares most signatures is the centre, and every other member is compared with it. Buckets whose members are then in
one component are done. In the rest, members of different components are compared in blocks of ``BLOCK`` rows inside
a task, which returns only links that join components; no pair is left out.

Documents without words have an empty set and link with nothing; documents with a null id get no component. Repeated
rows (equal id) are copies of one document. Extra columns are ignored. Only signatures and the sets of candidate
nodes are shuffled. A signature shared by very many rows is reduced to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import INVERSE, chunks, code_table, mix, powers, prefix_sums, saved, span_hashes, text_buffers, unused, width
from .components import connected_components, small_filter

SHINGLE = 3
PERCENT = 90
CHUNK = 1 << 20
FLUSH = 1 << 20
BLOCK = 512
SPARE = 10          # one partition in so many is there to be left out


# --- sets ----------------------------------------------------------------------------

def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, concatenated, and their offsets."""
    n = len(offsets) - 1
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    solid = ~((low == 32) | ((low >= 9) & (low <= 13)))
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid & (np.concatenate([[True], ~solid[:-1]]) | edge[:-1])) if len(low) else np.zeros(0, int)
    ends = np.flatnonzero(solid & (np.concatenate([~solid[1:], [True]]) | edge[1:])) + 1 if len(low) else starts
    words = span_hashes(prefix_sums(code_table()[low]), powers(len(low), INVERSE), starts, ends)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    per_doc = np.bincount(owner, minlength=n)
    first = np.concatenate([[0], np.cumsum(per_doc)])
    tag = np.uint64(0x9E3779B97F4A7C15)
    full = max(0, len(words) - size + 1)
    grams = np.zeros(full, np.uint64)
    for j in range(size):
        grams = mix(grams * tag + words[j:j + full]) if full else grams
    inside = owner[:full] == owner[size - 1:size - 1 + full]
    values, owners = [grams[inside]], [owner[:full][inside]]
    few = np.flatnonzero((per_doc > 0) & (per_doc < size))
    if len(few):
        short = np.zeros(len(few), np.uint64)
        for j in range(size - 1):
            has = per_doc[few] > j
            short[has] = mix(short[has] * tag + words[first[few[has]] + j] + np.uint64(j + 1))
        values.append(mix(short + np.uint64(77)))
        owners.append(few)
    value, owned = np.concatenate(values), np.concatenate(owners)
    if len(few):
        order = np.argsort(owned, kind="stable")
        value, owned = value[order], owned[order]
    cuts = np.concatenate([[0], np.cumsum(np.bincount(owned, minlength=n))])
    for a, b in zip(cuts[:-1], cuts[1:]):
        value[a:b].sort()
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owned[1:] != owned[:-1])
    value, owned = value[fresh], owned[fresh]
    return value, np.concatenate([[0], np.cumsum(np.bincount(owned, minlength=n))]).astype(np.int64)


def set_nodes(value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit name of every set: equal sets, equal names."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(value ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    total = sums[offsets[1:]] - sums[offsets[:-1]]
    return mix(total + np.diff(offsets).astype(np.uint64)).view(np.int64)


# --- signatures --------------------------------------------------------------------------

class PartEnum:
    """Signature scheme for one similarity; bands are made as larger sets come."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.lows, self.highs = [1], [100 // percent]
        self.schemes: dict[int, tuple[int, int, np.ndarray]] = {}

    def band(self, size: int) -> int:
        while self.highs[-1] < size:
            self.lows.append(self.highs[-1] + 1)
            self.highs.append(100 * self.lows[-1] // self.percent)
        return int(np.searchsorted(self.lows, size, side="right")) - 1

    def differences(self, band: int) -> int:
        """Most shingles in which a linking pair of this band (or the one below and this) differs."""
        self.band(self.lows[-1])
        while len(self.highs) <= band:
            self.band(self.highs[-1] + 1)
        # |A| + |B| = union + common, common >= p * union  =>  union - common <= (1 - p) / (1 + p) * (|A| + |B|)
        return (100 - self.percent) * 2 * self.highs[band] // (100 + self.percent)

    def scheme(self, band: int) -> tuple[int, int, np.ndarray]:
        """(n1, n2, subsets): n1 * (k2 + 1) > k, each subset names n2 - k2 of n2 partitions.

        Small sets get large subsets, so that a signature always stands for several shingles. Larger ones have single
        partitions, some more than needed, so that each set can leave out its lightest (see ``lightest``).
        """
        if band not in self.schemes:
            k = self.differences(band)
            if k == 0:
                n1, n2, k2 = 1, 1, 0
            elif k <= 3:
                n1, n2, k2 = 1, k + 3, k
            elif k <= 8:
                n1, n2, k2 = 1, k + 2, k
            else:
                n1, n2, k2 = k + 1 + k // SPARE, 1, 0
            subsets = np.zeros((n2, len(list(combinations(range(n2), n2 - k2)))))
            for i, s in enumerate(combinations(range(n2), n2 - k2)):
                subsets[list(s), i] = 1
            self.schemes[band] = (n1, n2, subsets)
        return self.schemes[band]

    def lightest(self, band: int, size: int, loads: np.ndarray) -> int:
        """Fewest shingles of a partition that a set of ``size`` has to show in an instance of single partitions.

        A linking partner changes at most k of this set's partitions. If more than k hold ``t`` shingles or more, one
        of them is unchanged, whatever the light ones do; of two sets the one with the larger ``t`` proves it, and the
        other shows that partition too. Without enough such partitions all are shown (0), empty ones included.
        """
        partner = min(self.highs[band], 100 * size // self.percent)
        k = (100 - self.percent) * (size + partner) // (100 + self.percent)
        return int(np.partition(loads, len(loads) - k - 1)[len(loads) - k - 1])

    def signatures(self, value: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Signatures of one set: in its own band's instance and, as the smaller partner, in the next one's.

        ``low`` and ``high`` are the halves of the shingles' mixed hashes as floats: their sums stay exact.
        """
        out = []
        own = self.band(len(value))
        for band in (own, own + 1):
            n1, n2, subsets = self.scheme(band)
            parts = n1 * n2
            place = ((value >> np.uint64(9)) % np.uint64(parts)).astype(np.int64)
            a = (np.bincount(place, low, parts).reshape(n1, n2) @ subsets).ravel()
            b = (np.bincount(place, high, parts).reshape(n1, n2) @ subsets).ravel()
            slot = np.uint64(band << 32) + np.arange(len(a), dtype=np.uint64)
            if n2 == 1 and n1 > 1:
                loads = np.bincount(place, minlength=parts)
                shown = loads >= self.lightest(band, len(value), loads)
                a, b, slot = a[shown], b[shown], slot[shown]
            out.append(mix(mix(a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64))
                           + mix(slot + np.uint64(1))))
        return np.concatenate(out)


def local_rows(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (sig, node, known) of one task: a signature of several nodes is known here; one row of it travels on."""
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    if not len(sig):
        return sig, node, np.zeros(0, bool)
    fresh = np.ones(len(sig), bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node = sig[fresh], node[fresh]
    first = np.concatenate([[True], sig[1:] != sig[:-1]])
    many = np.diff(np.append(np.flatnonzero(first), len(sig)))[np.cumsum(first) - 1] > 1
    return (np.concatenate([sig[first], sig[many]]), np.concatenate([node[first], node[many]]),
            np.concatenate([np.zeros(int(first.sum()), bool), np.ones(int(many.sum()), bool)]))


def each_set(batch: pa.RecordBatch, text_at: int, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, values, offsets) for stretches of a batch."""
    data, offsets = text_buffers(batch.column(text_at))
    for a, b in chunks(offsets, CHUNK):
        yield (a, b, *shingle_sets(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], size))


def document_nodes(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, node, n_shingles) of every document."""
    schema = T.StructType([docs.schema[id_col], T.StructField("node", T.LongType()),
                           T.StructField("n_shingles", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, value, offs in each_set(batch, 1, size):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(set_nodes(value, offs)), pa.array(np.diff(offs))],
                    names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def shared_signatures(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """(sig, node) rows of the signatures that different sets share."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme = PartEnum(percent)
        sigs, nodes, held = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            rows = local_rows(np.concatenate(sigs).view(np.int64), np.concatenate(nodes))
            sigs.clear()
            nodes.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=["sig", "node", "known"])

        for batch in batches:
            for _, _, value, offs in each_set(batch, 0, size):
                names = set_nodes(value, offs)
                mixed = mix(value)
                low = (mixed & np.uint64(0xFFFFFFFF)).astype(np.float64)
                high = (mixed >> np.uint64(32)).astype(np.float64)
                for i, (x, y) in enumerate(zip(offs[:-1], offs[1:])):
                    if x < y:
                        s = scheme.signatures(value[x:y], low[x:y], high[x:y])
                        sigs.append(s)
                        nodes.append(np.full(len(s), names[i], np.int64))
                        held += len(s)
                if held > FLUSH:
                    yield flush()
        if held:
            yield flush()

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_sig = rest_node = np.zeros(0, np.int64)
        for batch in batches:
            known = batch.column(2).to_numpy(zero_copy_only=False)
            sig, node = (batch.column(i).to_numpy() for i in (0, 1))
            if known.any():
                yield pa.RecordBatch.from_arrays([pa.array(sig[known]), pa.array(node[known])], names=["sig", "node"])
            sig, node = np.concatenate([rest_sig, sig[~known]]), np.concatenate([rest_node, node[~known]])
            cut = int(np.searchsorted(sig, sig[-1])) if len(sig) else 0     # the last signature may go on
            rest_sig, rest_node = sig[cut:], node[cut:]
            yield from repeated(sig[:cut], node[:cut])
        yield from repeated(rest_sig, rest_node)

    def repeated(sig: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(sig):
            first = np.concatenate([[True], sig[1:] != sig[:-1]])
            at = np.flatnonzero(first)
            differs = np.minimum.reduceat(node, at) != np.maximum.reduceat(node, at)
            keep = differs[np.cumsum(first) - 1]
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(sig[keep]), pa.array(node[keep])], names=["sig", "node"])

    rows = docs.filter(F.col(id_col).isNotNull()).select(text_col).mapInArrow(local, "sig long, node long, known boolean")
    spread = F.when(F.col("known"), F.xxhash64("sig", "node")).otherwise(F.col("sig"))
    return (rows.repartition(width(docs.sparkSession), spread).sortWithinPartitions("known", "sig")
            .mapInArrow(shared, "sig long, node long"))


# --- verification ---------------------------------------------------------------------------

def node_sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    schema = "node long, shingles array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, value, offs in each_set(batch, 0, size):
                sets = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(set_nodes(value, offs)), sets], names=["node", "shingles"])

    return docs.select(text_col).mapInArrow(run, schema)


def compared(edges: DataFrame, sets: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """Edges (a: centre, b) with ``linked``, the centre's size, and how b differs: shingles it lacks and has besides."""
    # only the centres' sets travel a second time
    one = small_filter(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")),
                       centres.select(F.col("centre").alias("a")).distinct(), "a")
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    common = F.col("n_a") - F.size("lacks")
    return (edges.join(two, "b").join(one, "a")
            .select("a", "b", F.size("set_a").alias("n_a"), F.array_except("set_a", "set_b").alias("lacks"),
                    F.array_except("set_b", "set_a").alias("besides"))
            .withColumn("linked", 100 * common >= percent * (F.col("n_a") + F.size("besides"))))


def indicator(lists: list[np.ndarray]) -> np.ndarray:
    """0/1 matrix of lists over the values that two or more of them hold."""
    values, place, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    out = np.zeros((len(lists), int((counts > 1).sum())), np.float32)
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    use = counts[place] > 1
    out[rows[use], column[place[use]]] = 1
    return out


def block_links(table: pa.Table, percent: int) -> pa.Table:
    """Links between members of different components of one block pair, as a spanning forest.

    With c the centre's set: common(x, y) = |c| - |c - x| - |c - y| + |(c - x) & (c - y)| + |(x - c) & (y - c)|.
    """
    node, comp, centre = (table.column(c).to_numpy() for c in ("node", "comp", "n_a"))
    _, keep = np.unique(node, return_index=True)
    node, comp, centre = node[keep], comp[keep], centre[keep].astype(np.int64)
    own = {}
    for name in ("lacks", "besides"):
        lists = table.column(name).combine_chunks()
        values, offs = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        own[name] = [values[offs[i]:offs[i + 1]] for i in keep]
    lack, more = (np.array([len(x) for x in own[name]], np.int64) for name in ("lacks", "besides"))
    both, extra = (indicator(own[name]) for name in ("lacks", "besides"))
    sizes = centre - lack + more
    common = centre[:, None] - lack[:, None] - lack[None, :] + (both @ both.T + extra @ extra.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    links = np.argwhere(np.triu((100 * common >= percent * union) & (comp[:, None] != comp[None, :]), 1))
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in links:
        x, y = root(int(comp[i])), root(int(comp[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(node[i]), int(node[j])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def rest_links(members: DataFrame, centres: DataFrame, comps: DataFrame, edges: DataFrame, percent: int) -> DataFrame:
    """Links that the comparison with the centres did not show, from buckets that still hold several components."""
    others = (members.join(centres, "sig").filter(F.col("node") != F.col("centre"))
              .join(comps, "node", "left").select("sig", "centre", "node", F.coalesce("comp", "node").alias("comp")))
    buckets = others.groupBy("sig").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                        F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("name"))
    # buckets with the same members are compared once
    once = buckets.filter("lo != hi").groupBy("name", "n").agg(F.min("sig").alias("sig"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    mine = F.pmod(F.xxhash64("node"), blocks)
    pairs = (others.join(once.select("sig", "n"), "sig").withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
             .select("sig", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                     F.col("centre").alias("a"), F.col("node").alias("b"), "comp"))
    return (pairs.join(edges.drop("linked"), ["a", "b"])
            .select("sig", "i", "j", F.col("b").alias("node"), "comp", "n_a", "lacks", "besides")
            .groupBy("sig", "i", "j").applyInArrow(lambda t: block_links(t, percent), "a long, b long").distinct())


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                       percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id): the smallest id reachable by links; one row per document."""
    nodes = saved(document_nodes(docs, id_col, text_col, size), "nodes")
    members = saved(shared_signatures(docs, id_col, text_col, size, percent), "shared")
    members = saved(members.distinct(), "members")
    share = members.groupBy("node").agg(F.count("*").alias("n"))
    centres = (members.join(share, "node").groupBy("sig").agg(F.max(F.struct("n", "node")).alias("top"))
               .select("sig", F.col("top.node").alias("centre")))
    centres = saved(centres, "centres")
    edges = (members.join(centres, "sig").filter(F.col("node") != F.col("centre"))
             .select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())
    # one document of every candidate node gives its set
    wanted = (nodes.join(members.select("node").distinct(), "node", "left_semi")
              .groupBy("node").agg(F.min(id_col).alias(id_col)).select(id_col).distinct())
    sets = saved(node_sets(small_filter(docs.select(id_col, text_col), wanted, id_col), id_col, text_col, size)
                 .dropDuplicates(["node"]), "sets")
    edges = saved(compared(edges, sets, centres, percent), "compared")
    links = edges.filter("linked").select("a", "b")
    more = saved(rest_links(members, centres, connected_components(links), edges, percent), "more_links")
    comps = connected_components(saved(links.unionByName(more), "all_links"))
    named = nodes.filter(f"n_shingles > 0 and {id_col} is not null").groupBy("node").agg(F.min(id_col).alias("low"))
    named = named.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    by_node = named.join(lowest, "comp").select("node", "component_id")
    return (nodes.join(by_node, "node", "left")
            .withColumn("component_id", F.when((F.col("n_shingles") > 0) & F.col(id_col).isNotNull(), F.col("component_id"))
                        .otherwise(F.col(id_col)))
            .select(id_col, "n_shingles", "component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
             percent: int = PERCENT) -> DataFrame:
    """``docs`` without the members of a component other than its smallest id; null ids come last.

    Where ids are null or repeated, rows go by a hash of id and text, and of rows with equal id and text one stays.
    """
    if docs.groupBy(id_col).count().filter(F.col(id_col).isNull() | (F.col("count") > 1)).limit(1).count():
        return keep_one_row(docs, id_col, text_col, size, percent)
    drop = (jaccard_components(docs, id_col, text_col, size, percent)
            .filter(F.col(id_col) != F.col("component_id")).select(id_col).distinct())
    return small_filter(docs, drop, id_col, keep=False)


def keep_one_row(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """``keep_one`` for tables with null or repeated ids."""
    key = unused(docs.columns, "key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col).isNull(), id_col, F.col(text_col).isNull(), text_col))
    again = saved(keyed.groupBy(key).count().filter("count > 1").select(key), "repeated")
    keyed = saved(small_filter(keyed, again, key, keep=False).unionByName(
        small_filter(keyed, again, key).dropDuplicates([key])), "keyed")
    comps = jaccard_components(keyed, key, text_col, size, percent).filter("n_shingles > 0")
    found = saved(comps.join(keyed.select(key, F.col(id_col).alias("__id")), key), "found")
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("__id").isNull(), "__id", F.col(key).alias("__key"))).alias("first"))
    drop = found.join(first, "component_id").filter(F.col(key) != F.col("first.__key")).select(key)
    return small_filter(keyed, drop, key, keep=False).select(*docs.columns)


def op7_shingle_join(docs: DataFrame) -> DataFrame:
    """Component of every document under 3-word shingles and Jaccard 0.9."""
    return jaccard_components(docs).select("doc_id", "n_shingles", F.col("component_id").cast("long"))
