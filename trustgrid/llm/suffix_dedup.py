"""Removal of repeated substrings: every byte covered by a ``LENGTH``-byte string that also starts elsewhere goes.

Anchors. Of the ``GRAM``-byte strings inside each window of ``LENGTH`` bytes the one with the least hash (the leftmost
of several) is the window's anchor. Equal windows have equal anchors at the same place, so a window can only be
repeated if its anchor's hash occurs twice. Anchors are some 2 in 100 positions; hashes of the corpus are counted once
and only repeated anchors go on.

Suffix runs. The context of a repeated anchor, ``LENGTH - GRAM`` bytes before it and ``LENGTH`` bytes from it, enters
two distributed merge sorts (``suffix_merge``): one by the suffix that starts at the anchor, one by the text read
backwards from the anchor's end. In the order of suffixes the longest match to the right of an anchor stands next to
it, in the other order the longest match to the left. From each neighbour the common lengths r to the right and l to
the left give repeated windows: those that begin d bytes before the anchor with LENGTH - r <= d <= l. Windows beyond
the longest r or l of all are not repeated. Windows between that no neighbour proves (an anchor whose left match and
right match are different places) are compared themselves.

Texts are UTF-8 bytes, null is empty; matches never cross documents; repeated rows count as different places. Hashes
have 64 bits. The driver gets splitters and the two border strings of each range, both bounded by the number of ranges.
Equal contexts are joined in each task before the exchange, so a passage that a third of all documents share sends
one string per task.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHasher, saved, text_buffers, width
from .suffix_merge import common_prefix, front_coded_blocks, merged, pick_splitters

LENGTH, GRAM = 200, 100
SEGMENT = 1 << 20
FLUSH = 1 << 18
RUN_STRINGS = 40_000
ROWS = 256           # texts taken from a batch at a time
SAMPLE_PER_RANGE = 24


# --- anchors ------------------------------------------------------------------------

def window_anchors(text: np.ndarray, length: int, gram: int, segment: int = SEGMENT,
                   hasher: SpanHasher | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash, anchor, nearest, farthest) arrays: the windows from anchor - farthest to anchor - nearest share an anchor.

    Long texts go in segments of window starts; an anchor whose windows reach over the border is given once.
    """
    hasher, reach = hasher or SpanHasher(), length - gram + 1
    held = [np.zeros(0, kind) for kind in (np.uint64, np.int64, np.int64, np.int64)]      # the last, still open anchor
    for first in range(0, len(text) - length + 1, segment):
        part = text[first:first + segment + length - 1]
        n = len(part) - gram + 1
        at = np.arange(n)
        hasher.load(part)
        h = hasher(at, at + gram)
        # order by hash, then by place: the place stands in the low bits
        key = (h & ~np.uint64((1 << 22) - 1)) | at.astype(np.uint64)
        blocks = -(-n // reach)
        padded = np.full(blocks * reach, np.iinfo(np.uint64).max, np.uint64)
        padded[:n] = key
        grid = padded.reshape(blocks, reach)
        ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        behind = np.minimum.accumulate(grid, axis=1).ravel()
        least = np.minimum(ahead[:n - reach + 1], behind[reach - 1:n])
        place = (least & np.uint64((1 << 22) - 1)).astype(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        end = np.concatenate([begin[1:], [len(place)]]) - 1
        anchor = place[begin]
        found = [h[anchor], anchor + first, anchor - end, anchor - begin]
        if len(held[1]) and held[1][0] == found[1][0]:
            found[3][0] = held[3][0]
        else:
            found = [np.concatenate(c) for c in zip(held, found)]
        held = [c[-1:] for c in found]
        yield tuple(c[:-1] for c in found)
    yield tuple(held)


def pack(anchor, nearest, farthest):
    return (anchor << 16) | (nearest << 8) | farthest


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 16, (packed >> 8) & 255, packed & 255


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(hash, doc, packed, known): anchors; those that a task sees twice are known, one row of each travels as 2."""
    names = ["hash", "doc", "packed", "known"]

    def local(hashes, keys, packs) -> pa.RecordBatch:
        h, k, p = np.concatenate(hashes).view(np.int64), np.concatenate(keys), np.concatenate(packs)
        order = np.argsort(h, kind="stable")
        h, k, p = h[order], k[order], p[order]
        first = np.concatenate([[True], h[1:] != h[:-1]])
        many = np.diff(np.append(np.flatnonzero(first), len(h)))[np.cumsum(first) - 1] > 1
        lead = first & many
        known = np.where(many, 1, 0)
        cols = [np.concatenate([c, c[lead]]) for c in (h, k, p)] + [np.concatenate([known, np.full(lead.sum(), 2)])]
        return pa.RecordBatch.from_arrays([pa.array(c[:], pa.int64()) for c in cols[:3]]
                                          + [pa.array(cols[3].astype(np.int8))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, keys, packs, held = [], [], [], 0
        hasher = SpanHasher()
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            docs_ = batch.column(0).to_numpy()
            for i in range(len(docs_)):
                for h, anchor, near, far in window_anchors(data[offsets[i]:offsets[i + 1]], length, gram, hasher=hasher):
                    hashes.append(h)
                    keys.append(np.full(len(h), docs_[i], np.int64))
                    packs.append(pack(anchor, near, far))
                    held += len(h)
                if held > FLUSH:
                    yield local(hashes, keys, packs)
                    hashes, keys, packs, held = [], [], [], 0
        if held:
            yield local(hashes, keys, packs)

    return docs.select("doc", "text").mapInArrow(run, "hash long, doc long, packed long, known byte")


def repeated_anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(hash, doc, packed) of the anchors whose hash occurs twice."""
    names = ["hash", "doc", "packed"]

    def groups(h, k, p, known) -> Iterator[pa.RecordBatch]:
        if len(h):
            first = np.concatenate([[True], h[1:] != h[:-1]])
            many = np.diff(np.append(np.flatnonzero(first), len(h)))[np.cumsum(first) - 1] > 1
            keep = many & (known == 0)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (h, k, p)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            cols = [batch.column(i).to_numpy().astype(np.int64) for i in range(4)]
            sure = cols[3] == 1
            if sure.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[sure]) for c in cols[:3]], names=names)
            rest = [np.concatenate([r, c[~sure]]) for r, c in zip(rest, cols)]
            cut = int(np.searchsorted(rest[0], rest[0][-1])) if len(rest[0]) else 0
            yield from groups(*[c[:cut] for c in rest])
            rest = [c[cut:] for c in rest]
        yield from groups(*rest)

    spread = F.when(F.col("known") == 1, F.xxhash64("doc", "packed")).otherwise(F.col("hash"))
    return (anchor_rows(docs, length, gram).withColumn("sure", F.col("known") == 1)
            .repartition(width(docs.sparkSession), spread).sortWithinPartitions("sure", "hash").drop("sure")
            .mapInArrow(run, "hash long, doc long, packed long"))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.slice(a, ROWS)


# --- contexts -------------------------------------------------------------------------

def context(raw: bytes, anchor: int, length: int, gram: int) -> tuple[bytes, bytes]:
    """The two sort strings of an anchor: forwards from it, then backwards before it; and backwards from its end,
    then forwards. Places outside the text are 255, which no text holds."""
    before = length - gram
    left = raw[max(0, anchor - before):anchor][::-1].ljust(before, b"\xff")
    right = raw[anchor:anchor + length].ljust(length, b"\xff")
    return right + left, right[:gram][::-1] + left + right[gram:]


def texts_with(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc, text, packs): texts that hold the given anchors; texts are hashed to their partition, not sorted."""
    lists = rows.groupBy("doc").agg(F.array_sort(F.collect_set("packed")).alias("packs"))
    return docs.select("doc", "text").join(lists.hint("shuffle_hash"), "doc")


def sampled_splitters(docs: DataFrame, rows: DataFrame, parts: int, length: int, gram: int) -> list[list[bytes]]:
    """Splitters of both orders from ``SAMPLE_PER_RANGE`` contexts a range, those with the smallest hashes."""
    sample = rows.select("doc", "packed").orderBy(F.xxhash64("doc", "packed")).limit(parts * SAMPLE_PER_RANGE)
    lists = saved(sample.groupBy("doc").agg(F.collect_set("packed").alias("packs")), "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [context(t, p >> 16, length, gram) for t, ps in zip(*(c.to_pylist() for c in batch.columns)) for p in ps]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)],
                                             names=["f", "g"])

    held = docs.select("doc", "text").join(F.broadcast(lists), "doc")       # at most parts * SAMPLE_PER_RANGE rows
    got = held.select(F.col("text").cast("binary"), "packs").mapInArrow(run, "f binary, g binary").collect()
    return [pick_splitters([bytes(r[i]) for r in got], parts) for i in (0, 1)]


def sorted_runs(held: DataFrame, splitters: list[list[bytes]], parts: int, length: int, gram: int) -> DataFrame:
    """Rows (part, run, seq, block): front-coded runs of both orders (parts 0.. and parts..), and part -1 - n with the
    anchors whose context this task holds twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings: list[tuple[bytes, bytes, int, int]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            name = uuid.uuid4().hex
            rows, twice, own = [], [], strings
            for order in (0, 1):
                by = [s[order] for s in own]
                ranked = sorted(range(len(by)), key=by.__getitem__)
                if order == 0:                  # equal contexts are equal in both orders: one of them goes on
                    lead = [i for k, i in enumerate(ranked) if not k or by[ranked[k - 1]] != by[i]]
                    if len(lead) < len(ranked):
                        times = Counter(by)
                        twice = [s[2:] for s, key in zip(own, by) if times[key] > 1]
                    ranked = lead
                keys, idents = [by[i] for i in ranked], [own[i][2:] for i in ranked]
                rows += [(order * parts + part, name, seq, block)
                         for part, seq, block in front_coded_blocks(keys, idents, splitters[order])]
                own = [own[i] for i in ranked]
            for i in range(0, len(twice), 4096):
                rows.append((-1 - i // 4096 % (2 * parts), name, i // 4096,
                             np.array(twice[i:i + 4096], np.int64).tobytes()))
            strings.clear()
            for i in range(0, len(rows), 256):
                cols = list(zip(*rows[i:i + 256]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.string(), pa.int64(), pa.binary()))],
                    names=["part", "run", "seq", "block"])

        for batch in slices(batches):
            for doc, raw, packs in zip(*(c.to_pylist() for c in batch.columns)):
                for p in packs:
                    strings.append((*context(raw, p >> 16, length, gram), doc, p))
                    if len(strings) >= RUN_STRINGS:
                        yield from flush()
        if strings:
            yield from flush()

    return held.select("doc", F.col("text").cast("binary").alias("raw"), "packs").mapInArrow(
        run, "part int, run string, seq long, block binary")


MATCH = "doc long, packed long, low int, high int, right int, left int, border binary, part int"


def match_rows(runs: DataFrame, parts: int, length: int, gram: int) -> DataFrame:
    """Merge each range. Rows per anchor: repeated windows low..high, or the longest match to the right or left;
    and two border rows per range (first and last string)."""
    before = length - gram

    def lengths(order: int, a: bytes, b: bytes, shared: int) -> tuple[int, int]:
        """Common length to the right from the anchor and to the left of it, of two contexts in one order."""
        if shared < gram:
            return 0, 0
        if order == 0:
            right = min(shared, length)
            return right, common_prefix(a[length:], b[length:], max(0, shared - length))
        left = min(shared - gram, before)
        return gram + common_prefix(a[length:], b[length:], max(0, shared - length)), left

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, runs_, out = None, {}, []

        def merge() -> Iterator[list]:
            order = int(part >= parts)
            last = None                      # (string, ident) of the string before
            best: list | None = None         # its longest match, windows, whether it is repeated whole
            first = None

            def close() -> list[tuple]:
                doc, p = last[1]
                if best[3]:         # repeated whole: the first order says so, its first row stands for the others
                    return [(doc, p, 0, before, length, None, None, None)] if order == 0 else []
                rows = [(doc, p, a, b, None, None, None, None) for a, b in best[2] if a <= b]
                rows.append((doc, p, None, None, best[0] if order == 0 else None, best[1] if order else None, None, None))
                return rows

            for shared, string, ident in merged(list(runs_.values())):
                if last is not None and shared == len(string) == len(last[0]):
                    best[3] = True
                    if order == 0:
                        yield (*ident, 0, before, None, None, None, None)
                    continue
                seen = [0, 0, [], False]
                if last is None:
                    first = (string, ident)
                else:
                    right, left = lengths(order, last[0], string, shared)
                    for b in (best, seen):
                        b[0], b[1] = max(b[0], right), max(b[1], left)
                        if right:
                            b[2].append((length - right, left))
                    yield from close()
                last, best = (string, ident), seen
            if last is not None:
                yield from close()
                yield (*first[1], None, None, None, 0, first[0], part)
                yield (*last[1], None, None, None, 1, last[0], part)

        def send() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int32())
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                               names=[f.split()[0] for f in MATCH.split(", ")])
            out.clear()
            return batch

        def flush() -> Iterator[pa.RecordBatch]:
            for row in merge() if part is not None and part >= 0 else ():
                out.append(row)
                if len(out) >= 8192:
                    yield send()
            runs_.clear()

        for batch in batches:
            for p, name, _, block in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    yield from flush()
                    part = p
                if p < 0:
                    for doc, packed in np.frombuffer(block, np.int64).reshape(-1, 2).tolist():
                        out.append((doc, packed, 0, before, None, None, None, None))
                    yield send()
                else:
                    runs_.setdefault(name, []).append(block)
        yield from flush()
        if out:
            yield send()

    spread = F.when(F.col("part") < 0, -1 - F.col("part")).otherwise(F.col("part"))
    return (runs.repartitionById(2 * parts, spread).sortWithinPartitions("part", "run", "seq")
            .mapInArrow(run, MATCH))


def border_rows(matches: DataFrame, parts: int, length: int, gram: int) -> DataFrame:
    """What the last string of a range and the first of the next say about each other: two strings per range."""
    ends = sorted(((r["part"], r["left"], bytes(r["border"]), r["doc"], r["packed"]) for r in
                   matches.filter("border is not null").collect()), key=lambda r: r[:2])
    before, out = length - gram, []
    for (pa_, ka, a, *ia), (pb, kb, b, *ib) in zip(ends, ends[1:]):
        if pa_ == pb or (pa_ < parts) != (pb < parts):
            continue
        shared = common_prefix(a, b)
        if shared < gram:
            continue
        rest = common_prefix(a[length:], b[length:])
        right, left = (min(shared, length), rest) if pa_ < parts else (gram + rest, min(shared - gram, before))
        for doc, p in (ia, ib):
            if length - right <= left:
                out.append((doc, p, length - right, left, None, None))
            out.append((doc, p, None, None, right if pa_ < parts else None, left if pa_ >= parts else None))
    spark = matches.sparkSession
    return spark.createDataFrame(out, "doc long, packed long, low int, high int, right int, left int")


# --- windows that no neighbour decides ---------------------------------------------------

def distinct_contexts(facts: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per distinct context: (doc, packed, low, high, ds). Its windows d in low..high may be repeated, those in
    ``ds`` without a neighbour that shows it."""
    near, far = F.shiftright("packed", 8).bitwiseAND(255), F.col("packed").bitwiseAND(255)
    per = facts.groupBy("doc", "packed").agg(
        F.collect_set(F.when(F.col("low") <= F.col("high"), F.struct("low", "high"))).alias("spans"),
        F.max("right").alias("right"), F.max("left").alias("left"))
    low = F.greatest(near, F.lit(length) - F.col("right")).cast("int")
    high = F.least(far, F.coalesce("left", F.lit(length - gram))).cast("int")
    proved = F.flatten(F.transform("spans", lambda s: F.sequence(s["low"], s["high"])))
    return (per.filter("right is not null").withColumn("low", low).withColumn("high", high).filter("low <= high")
            .select("doc", "packed", "low", "high", F.array_except(F.sequence("low", "high"), proved).alias("ds")))


def decide(docs: DataFrame, anchors: DataFrame, contexts: DataFrame, length: int) -> DataFrame:
    """(doc, packed, low, high) of undecided windows that are repeated: they and the windows of distinct contexts that
    could equal them (same anchor hash, same distance from it, not ruled out) are compared themselves."""
    hashed = saved(contexts.join(anchors.distinct(), ["doc", "packed"]), "hashed")
    wanted = hashed.select("hash", F.explode("ds").alias("d")).distinct().groupBy("hash").agg(F.collect_list("d").alias("ds"))
    rows = hashed.drop("ds").join(wanted, "hash").withColumn(
        "ds", F.filter("ds", lambda d: (d >= F.col("low")) & (d <= F.col("high")))).filter(F.size("ds") > 0)
    lists = rows.groupBy("doc").agg(F.collect_set(F.struct("packed", "ds")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, raw, places in zip(*(c.to_pylist() for c in batch.columns)):
                cut = [(p["packed"], d, raw[(p["packed"] >> 16) - d:(p["packed"] >> 16) - d + length])
                       for p in places for d in p["ds"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(cut), pa.int64()), pa.array([c[0] for c in cut], pa.int64()),
                     pa.array([c[1] for c in cut], pa.int32()), pa.array([c[2] for c in cut], pa.binary())],
                    names=["doc", "packed", "d", "piece"])

    pieces = saved(docs.join(lists.hint("shuffle_hash"), "doc")
                   .select("doc", F.col("text").cast("binary").alias("raw"), "places")
                   .mapInArrow(run, "doc long, packed long, d int, piece binary"), "pieces")
    twice = pieces.groupBy(F.sha2("piece", 256).alias("name")).count().filter("count > 1").select("name")
    return (pieces.withColumn("name", F.sha2("piece", 256)).join(twice, "name")
            .select("doc", "packed", F.col("d").alias("low"), F.col("d").alias("high")))


# --- result ----------------------------------------------------------------------------------

def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, spans): byte ranges [start, end) covered by repeated strings, per text that has any. ``docs`` is
    (doc, text) with a 64-bit key per row; rows with equal keys are equal rows."""
    if not 0 < gram <= length <= gram + 255:        # distances from the anchor travel in a byte
        raise ValueError("length has to be between gram and gram + 255")
    parts = width(docs.sparkSession)
    anchors = saved(repeated_anchors(docs, length, gram), "anchors")
    splitters = sampled_splitters(docs, anchors, parts, length, gram)
    runs = sorted_runs(texts_with(docs, anchors), splitters, parts, length, gram)
    matches = saved(match_rows(runs, parts, length, gram), "matches")
    facts = matches.filter("border is null").select("doc", "packed", "low", "high", "right", "left")
    facts = facts.unionByName(border_rows(matches, parts, length, gram))
    contexts = saved(distinct_contexts(facts, length, gram), "contexts")
    proved = facts.filter("low <= high").select("doc", "packed", "low", "high")
    if contexts.filter(F.size("ds") > 0).limit(1).count():
        proved = proved.unionByName(decide(docs, anchors, contexts, length))
    near, far = F.shiftright("packed", 8).bitwiseAND(255), F.col("packed").bitwiseAND(255)
    low, high = F.greatest(F.col("low"), near), F.least(F.col("high"), far)
    anchor = F.shiftright("packed", 16)
    spans = proved.filter(low <= high).select("doc", (anchor - high).alias("start"), (anchor - low + length).alias("end"))
    return spans.groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))


def maximal(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                     gram: int = GRAM) -> DataFrame:
    """One row per document: id, ``kept`` (the remaining bytes), ``removed`` (array of byte ranges), ``n_bytes``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col), text.alias("text")).withColumn("doc", F.xxhash64(id_col, "text"))
    spans = saved(repeated_spans(keyed.select("doc", "text"), length, gram), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, removed = [], []
            for raw, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                cut = maximal([(s["start"], s["end"]) for s in found or ()])
                at, pieces = 0, []
                for a, b in cut:
                    pieces.append(raw[at:a])
                    at = b
                pieces.append(raw[at:])
                kept.append(b"".join(pieces))
                removed.append([{"start": a, "end": b} for a, b in cut])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array(removed, kind),
                 pa.array([len(r) for r in batch.column(1).to_pylist()], pa.int64())],
                names=[id_col, "kept", "removed", "n_bytes"])

    from pyspark.sql import types as T
    schema = T.StructType([docs.schema[id_col], T.StructField("kept", T.BinaryType()),
                           T.StructField("removed", T.ArrayType(T.StructType([
                               T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
                           T.StructField("n_bytes", T.LongType())])
    return (keyed.join(spans.hint("shuffle_hash"), "doc", "left")
            .select(id_col, F.col("text").cast("binary").alias("raw"), "spans").mapInArrow(run, schema))


def op4_suffix_dedup(docs: DataFrame) -> DataFrame:
    """What the removal of repeated 200-byte strings leaves of every document."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    return dedup_substrings(docs).select("doc_id", "n_bytes", gone.alias("n_removed"),
                                         F.size("removed").cast("long").alias("n_spans"),
                                         F.sha2("kept", 256).alias("kept_sha256"))
