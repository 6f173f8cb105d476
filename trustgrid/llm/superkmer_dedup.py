"""Removal of repeated passages of ``WORDS`` words: every word covered by a window that also starts earlier goes.

Words are runs of characters other than blanks (0x20, 0x09 to 0x0D), unchanged; a window is ``WORDS`` consecutive words
of one document. Windows are ordered by document (id, nulls first; then a hash of the text), then by place; of equal
windows the first stays and the words of all others go. Windows are judged on the input, not on what is left.

Super-k-mers. The minimiser of a window is the least hash of the ``GRAM``-word strings in it, so equal windows have equal
minimisers. Consecutive windows with one minimiser travel as one packed string (their words with single blanks between
them) to the minimiser's bucket; ``SPLIT`` windows at most go into one string. A bucket's windows are sorted by hash, and
those whose hash occurs twice are told apart by their bytes, so equality is exact.

Packed strings hold each word some three times, so minimisers are dealt into ``ROUNDS`` classes that are shuffled one
after the other: the disk holds one class at a time, for one more reading of the texts per class.

Skew. Equal packed strings of a chunk of texts meet before the shuffle: the first travels, the others are known to be
repeated. A bucket whose minimiser is frequent (a phrase that a third of all documents hold in different surroundings)
is not kept whole: its windows travel one by one, dealt by the hash of the whole window, so that only equal windows
meet. Frequent minimisers are found in a pass of its own on one string in ``SAMPLE``; which ones they are decides on
routes, never on results, and there are ``FREQUENT`` at most, whatever the input (8 bytes each, sent to the tasks).

Null and empty texts have no words: nothing is removed and nothing is left. Rows with equal id and text are copies of
one document: they get equal results and do not count as earlier than each other. Empty tables give no rows; extra
columns are ignored. Rows are joined back by two 64-bit hashes of id and text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BASE, SpanHasher, chunks, mix, saved, text_buffers, width

WORDS = 20
GRAM = 4
SPLIT = 64
ROUNDS = 2
SAMPLE = 16
FREQUENT = 1_000_000
LEAST_FREQUENT = 1024       # sampled strings: 16,384 in all
CHUNK = 1 << 20
SEEN = 100_000
BLANKS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class Words:
    """The words of some texts, each after one blank: ``raw`` holds them all, ``starts`` and ``ends`` their places."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        ink = ~BLANKS[data]
        first = ink.copy()
        first[1:] &= ~ink[:-1]
        inner = offsets[:-1][offsets[:-1] < len(data)]
        first[inner] = ink[inner]                           # a word does not cross texts
        at = np.flatnonzero(first)
        place = np.cumsum(ink, dtype=np.int64) - 1
        place += np.cumsum(first, dtype=np.int64)
        self.raw = np.full(int(ink.sum()) + len(at), 0x20, np.uint8)
        self.raw[place[ink]] = data[ink]
        self.starts = place[at]
        self.ends = np.append(self.starts[1:] - 1, len(self.raw))[:len(at)]
        self.docs = np.searchsorted(at, offsets)            # text t has the words docs[t] to docs[t + 1]

    def counts(self) -> np.ndarray:
        return np.diff(self.docs)


def cut(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as a binary column."""
    sizes = ends - starts
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    index = np.arange(offsets[-1], dtype=np.int64)
    index += np.repeat(starts - offsets[:-1], sizes)
    data = raw[index]
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def minimisers(words: Words, hasher: SpanHasher, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, valid) of the window that starts at each word, and the hash of the gram that starts there."""
    n = len(words.starts)
    least = np.zeros(n, np.uint64)
    valid = np.zeros(n, bool)
    if n < size:
        return least, valid, least
    last = np.repeat(words.docs[1:], words.counts())
    valid = np.arange(n) + size <= last
    grams = found = hasher(words.starts[:n - gram + 1], words.ends[gram - 1:])
    left = size - gram + 1                                   # grams in a window
    step = 1
    while step * 2 <= left:
        found = np.minimum(found[:-step], found[step:])
        step *= 2
    if left > step:
        found = np.minimum(found[:step - left], found[left - step:])
    least[:len(found)] = found
    return least, valid, grams


def recurring(first: np.ndarray, n: np.ndarray, least: np.ndarray, grams: np.ndarray, left: int) -> np.ndarray:
    """Super-k-mers that hold their minimiser twice: only these can hold one window twice."""
    times = np.zeros(len(first), np.int64)
    for k in range(2 * left - 1):                            # a gram is in ``left`` windows at most
        times += (grams[np.minimum(first + k, len(grams) - 1)] == least[first]) & (k < n + left - 1)
    return (n > left) | (times > 1)


def super_kmers(least: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, windows) of the runs of windows with one minimiser, ``SPLIT`` windows at most."""
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    at = np.flatnonzero(valid)
    if not len(at):
        return at, at
    run = np.flatnonzero(new[at])                            # places in ``at`` where runs begin
    inside = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
    first = np.flatnonzero(inside % SPLIT == 0)
    return at[first], np.diff(np.append(first, len(at)))


def ranks(docs: pa.Table) -> np.ndarray:
    """Dense ranks of rows by all columns in order, nulls first; equal rows have equal ranks."""
    order = pc.sort_indices(docs, sort_keys=[(c, "ascending") for c in docs.column_names],
                            null_placement="at_start").to_numpy()
    new = np.zeros(len(order), np.int64)
    for c in docs.column_names:
        codes = docs.column(c).combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)[order]
        new[1:] |= codes[1:] != codes[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        data, offsets = text_buffers(batch.column(text))
        for a, b in chunks(offsets, CHUNK):
            yield batch.slice(a, b - a), data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def frequent_minimisers(docs: DataFrame, size: int, gram: int) -> bytes:
    """Minimisers of very many super-k-mers, as sorted 64-bit numbers; ``FREQUENT`` at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for _, data, offsets in _slices(batches, 0):
            words = Words(data, offsets)
            hasher.load(words.raw)
            least, valid, _ = minimisers(words, hasher, size, gram)
            first, _ = super_kmers(least, valid)
            found, times = np.unique(least[first[::SAMPLE]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times, pa.int64())],
                                             names=["h", "times"])

    counts = saved(docs.select("text").mapInArrow(run, "h long, times long").groupBy("h").agg(F.sum("times").alias("times")),
                   "minimisers")
    least = max(LEAST_FREQUENT, -(-(counts.agg(F.sum("times")).first()[0] or 0) // FREQUENT))
    rows = counts.filter(F.col("times") >= least).select("h").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64)).tobytes()


def packed_strings(docs: DataFrame, frequent: bytes, size: int, gram: int, of_class: int) -> DataFrame:
    """(h, id, k1, k2, start, n, twice, packed): super-k-mers of one class of minimisers for their buckets, ``twice`` if the minimiser occurs twice in
    it; without ``packed``, n windows from ``start`` on that are known to be repeated."""
    kind = docs.schema["id"].dataType
    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("id", kind), T.StructField("k1", T.LongType()),
                           T.StructField("k2", T.LongType()), T.StructField("start", T.IntegerType()),
                           T.StructField("n", T.IntegerType()), T.StructField("twice", T.BooleanType()),
                           T.StructField("packed", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = np.frombuffer(frequent, np.int64)
        hasher, seen = SpanHasher(), {}
        for batch, data, offsets in _slices(batches, 3):
            words = Words(data, offsets)
            hasher.load(words.raw)
            least, valid, grams = minimisers(words, hasher, size, gram)
            first, n = super_kmers(least, valid)
            own = least[first] % np.uint64(ROUNDS) == of_class
            first, n = first[own], n[own]
            if not len(first):
                continue
            h, twice = least[first].view(np.int64), recurring(first, n, least, grams, size - gram + 1)
            if len(hot):                                     # windows of frequent minimisers go one by one
                is_hot = hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h
                many = n[is_hot]
                each = np.repeat(first[is_hot], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                alone = hasher(words.starts[each], words.ends[each + size - 1]) ^ np.uint64(BASE)
                first, n = np.append(first[~is_hot], each), np.append(n[~is_hot], np.ones(len(each), np.int64))
                h, twice = np.append(h[~is_hot], alone.view(np.int64)), np.append(twice[~is_hot], np.zeros(len(each), bool))
            packed = cut(words.raw, words.starts[first], words.ends[first + n + size - 2])
            doc = np.searchsorted(words.docs, first, side="right") - 1
            start = first - words.docs[doc]
            ids = pa.Table.from_arrays([batch.column(i) for i in range(3)], names=["id", "k1", "k2"])
            rank = ranks(ids)[doc]
            codes = packed.dictionary_encode().indices.to_numpy()
            order = np.lexsort((start, rank, codes))
            lead = np.append(True, codes[order][1:] != codes[order][:-1])
            leader = np.empty(len(order), np.int64)          # the first row with the same string
            leader[order] = order[np.flatnonzero(lead)][np.cumsum(lead) - 1]
            goes = leader == np.arange(len(order))
            late = ~goes & ((rank != rank[leader]) | (start != start[leader]))
            for i in np.flatnonzero(goes & (np.bincount(codes)[codes] > 1)):     # strings that came before in this task
                key, own = packed[i].as_py(), _place(ids, int(doc[i]), int(start[i]))
                known = seen.get(key)
                if known is not None and known < own:
                    goes[i], late[i] = False, True
                elif known is None or own < known:
                    seen[key] = own
            if len(seen) > SEEN:
                seen = {}
            use = np.flatnonzero(goes | late)
            rows, is_late = ids.take(pa.array(doc[use])), late[use]
            text = pc.if_else(pa.array(is_late), None, packed.take(pa.array(use))).cast(pa.binary())
            spread = mix(rows.column("k1").to_numpy().view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(is_late, spread, h[use])), *(rows.column(c).combine_chunks() for c in ("id", "k1", "k2")),
                 pa.array(start[use], pa.int32()), pa.array(n[use], pa.int32()), pa.array(twice[use]), text],
                names=schema.names)

    return docs.select("id", "k1", "k2", "text").mapInArrow(run, schema)


def _place(ids: pa.Table, row: int, start: int) -> tuple:
    value = ids.column("id")[row].as_py()
    return (value is not None, value, ids.column("k1")[row].as_py(), ids.column("k2")[row].as_py(), start)


def repeated_windows(rows: pa.Table, size: int, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """(row, window) of all windows of ``rows``, super-k-mers of some buckets, that equal an earlier one."""
    data, offsets = text_buffers(rows.column("packed").combine_chunks())
    words = Words(data, offsets)
    n = rows.column("n").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    word = words.docs[row] + window
    starts, ends = words.starts[word], words.ends[word + size - 1]
    hasher.load(words.raw)
    found = hasher(starts, ends)
    place = ranks(rows.select(["id", "k1", "k2", "start"]))[row] * SPLIT + window
    order = np.argsort(found, kind="stable")
    same = found[order][1:] == found[order][:-1]
    order = order[np.append(same, False) | np.append(False, same)]
    hit = []
    edges = np.flatnonzero(np.append(True, found[order][1:] != found[order][:-1])) if len(order) else []
    total = np.append(0, np.cumsum((ends - starts)[order]))
    a = 0
    while a < len(order):                                    # whole groups of equal hashes, some megabytes of text at a time
        b = int(np.searchsorted(total, total[a] + 8 * CHUNK))
        after = edges[np.searchsorted(edges, max(b, a + 1)):]
        b = int(after[0]) if len(after) else len(order)
        part = order[a:b]
        codes = cut(words.raw, starts[part], ends[part]).dictionary_encode().indices.to_numpy()
        earliest = np.full(int(codes.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(earliest, codes, place[part])
        hit.append(part[place[part] > earliest[codes]])
        a = b
    hits = np.sort(np.concatenate(hit)) if hit else np.zeros(0, np.int64)
    return row[hits], window[hits]


def repeated_spans(strings: DataFrame, size: int) -> DataFrame:
    """(k1, k2, start, stop): spans of words covered by windows that start earlier elsewhere."""
    names = ["k1", "k2", "start", "stop"]

    def spans(rows: pa.Table, at: np.ndarray, first: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
        got = [rows.column(c).combine_chunks().take(pa.array(at)) for c in ("k1", "k2")]
        return pa.RecordBatch.from_arrays([*got, pa.array(first, pa.int32()), pa.array(stop, pa.int32())], names=names)

    def bucket(rows: pa.Table, hasher: SpanHasher) -> Iterator[pa.RecordBatch]:
        """Whole buckets: rows ordered by h."""
        known = rows.column("packed").is_null().to_numpy()
        start, n = (rows.column(c).to_numpy().astype(np.int64) for c in ("start", "n"))
        if known.any():
            at = np.flatnonzero(known)
            yield spans(rows, at, start[at], start[at] + n[at] + size - 1)
        h = rows.column("h").to_numpy()
        open_ = np.flatnonzero(~known)
        same = h[open_][1:] == h[open_][:-1]
        twice = rows.column("twice").to_numpy()[open_]
        pick = open_[np.append(same, False) | np.append(False, same) | twice] if len(open_) else open_
        if not len(pick):
            return
        chosen = rows.take(pa.array(pick))
        row, window = repeated_windows(chosen, size, hasher)
        if len(row):
            new = np.append(True, (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1))
            a, b = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(row)) - 1
            begin = start[pick][row[a]]
            yield spans(chosen, row[a], begin + window[a], begin + window[b] + size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, waiting, held = SpanHasher(), [], 0
        for batch in batches:
            waiting.append(batch)
            held += batch.nbytes
            if held < 4 * CHUNK:
                continue
            rows = pa.Table.from_batches(waiting)
            h = rows.column("h").to_numpy()
            last = int(np.searchsorted(h, h[-1]))            # the last bucket may go on
            if last:
                yield from bucket(rows.slice(0, last).combine_chunks(), hasher)
            rest = rows.slice(last).combine_chunks()
            waiting, held = rest.to_batches(), 0
        if waiting:
            yield from bucket(pa.Table.from_batches(waiting).combine_chunks(), hasher)

    dealt = strings.repartition(width(strings.sparkSession), "h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, "k1 long, k2 long, start int, stop int")


def dedup_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS,
                  gram: int = GRAM) -> DataFrame:
    """One row per document: id, ``n_words``, ``removed`` (maximal spans of words), ``n_removed`` and ``kept``, the words
    that stay with single blanks between them."""
    if not 0 < gram <= size or size < 2:
        raise ValueError("a window has two words or more, a gram at most as many")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumns({
        "k1": F.xxhash64("id", "text"), "k2": F.xxhash64("text", "id", F.lit(1))})
    frequent = frequent_minimisers(keyed, size, gram)
    rounds = [saved(repeated_spans(packed_strings(keyed, frequent, size, gram, r), size), "spans") for r in range(ROUNDS)]
    spans = reduce(DataFrame.unionByName, rounds)
    lists = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("removed", T.ArrayType(T.StructType([
            T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))),
        T.StructField("kept", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _slices(batches, 1):
            words = Words(data, offsets)
            n = words.counts()
            found = batch.column(2)
            held = pc.list_parent_indices(found).to_numpy()
            flat = found.flatten()
            change = np.zeros(len(words.starts) + 1, np.int64)
            base = words.docs[held]
            np.add.at(change, base + flat.field("start").to_numpy(), 1)
            np.add.at(change, base + flat.field("stop").to_numpy(), -1)
            gone = np.cumsum(change)[:-1] > 0
            doc = np.repeat(np.arange(len(n)), n)
            edge = np.flatnonzero(gone & np.append(True, ~gone[:-1] | (doc[1:] != doc[:-1]))) if len(gone) else doc
            stop = np.flatnonzero(gone & np.append(~gone[1:] | (doc[1:] != doc[:-1]), True)) + 1 if len(gone) else doc
            lists_at = np.searchsorted(doc[edge], np.arange(len(n) + 1))
            removed = pa.ListArray.from_arrays(pa.array(lists_at, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(edge - words.docs[doc[edge]], pa.int32()), pa.array(stop - words.docs[doc[edge]], pa.int32())],
                names=["start", "stop"]))
            stay = np.flatnonzero(~gone)
            keep = np.repeat(~gone, np.diff(np.append(words.starts - 1, len(words.raw))))
            lead = stay[np.append(True, doc[stay][1:] != doc[stay][:-1])] if len(stay) else stay
            keep[words.starts[lead] - 1] = False            # no blank before a text's first word
            sizes = np.append(0, np.cumsum(keep, dtype=np.int64))
            bounds = sizes[np.append(words.starts - 1, len(words.raw))[words.docs]]
            kept = pa.Array.from_buffers(pa.large_string(), len(n), [
                None, pa.py_buffer(bounds), pa.py_buffer(words.raw[keep])]).cast(pa.string())
            count = np.bincount(doc[gone], minlength=len(n))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(count, pa.int64()),
                                              removed.cast(span), kept], names=schema.names)

    joined = keyed.join(lists.hint("shuffle_hash"), ["k1", "k2"], "left")
    return joined.select("id", "text", "spans").mapInArrow(run, schema)


def op12_superkmer_dedup(docs: DataFrame) -> DataFrame:
    """What the removal of windows of 20 words that start earlier elsewhere leaves of every document."""
    return dedup_windows(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_sql(size: int = WORDS) -> str:
    """DuckDB form."""
    return f"""
WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM split),
windows AS (SELECT doc_id, i, ws[i] AS word, CASE WHEN i + {size - 1} <= len(ws) THEN ws[i:i + {size - 1}] END AS w FROM places),
marked AS (SELECT doc_id, i, word, w IS NOT NULL AND row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS FIRST, i) > 1 AS again
  FROM windows),
judged AS (SELECT doc_id, i, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)
  AS gone FROM marked),
kept AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept
  FROM judged GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.ws) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""
