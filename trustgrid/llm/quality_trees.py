"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every whole text becomes a vector of statistics (shares of character classes, word and line lengths, repetition).
Features are binned by quantiles of the training rows; each tree level adds gradient histograms per node and feature
and takes the best split. Trained trees are flattened into arrays (feature, threshold, children, value) and a batch
of documents walks all trees with numpy.

The model is fitted on a bounded sample: the ``sample_rows`` labelled rows with the smallest hash of their id. The
statistics and scores cover all rows and whole texts; rows map one to one, nothing is shuffled, and the model is one
small broadcast of fixed size.

Null texts count as empty; empty texts get the score of their (all zero) statistics. Without labels, or with one
label only, every score is the share of good labels (0.5 without any). Repeated rows get equal scores; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, id_bucket, text_buffers

SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, LEAST = 120, 5, 64, 0.1, 20.0
CHUNK = 1 << 20

CLASSES = ("upper", "lower", "digit", "space", "newline", "wide", "comma", "stop", "mark", "symbol", "pipe")
FEATURES = tuple(f"share_{c}" for c in CLASSES) + (
    "log_bytes", "log_words", "word_bytes", "distinct_words", "log_lines", "distinct_lines", "repeated_line_bytes",
    "line_bytes", "short_lines", "capital_words", "shout_words", "symbol_words", "digit_words", "top_word",
    "repeated_pairs", "longest_word", "sentence_words")


def class_table() -> np.ndarray:
    """Character class of every byte; bytes from 128 on are ``wide``."""
    out = np.full(256, CLASSES.index("symbol"), np.uint8)
    out[128:] = CLASSES.index("wide")
    for name, chars in (("upper", range(65, 91)), ("lower", range(97, 123)), ("digit", range(48, 58)),
                        ("space", b" \t\r\x0b\x0c"), ("newline", b"\n"), ("comma", b",;:"), ("stop", b"."),
                        ("mark", b"!?"), ("pipe", b"|\\/<>{}[]")):
        out[list(chars)] = CLASSES.index(name)
    return out


def word_statistics(raw: bytes) -> tuple[float, ...]:
    """Statistics of words and lines of one text."""
    words, lines = raw.split(), [x.strip() for x in raw.split(b"\n")]
    lines = [x for x in lines if x]
    if not words:
        return (np.log1p(len(raw)), *[0.0] * (len(FEATURES) - len(CLASSES) - 1))
    n = len(words)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    seen, again = set(), 0
    for x in lines:
        if x in seen:
            again += len(x)
        seen.add(x)
    capital = shout = symbol = digit = stops = 0
    for w, k in counts.items():
        if w[:1].isupper():
            capital += k
            if len(w) > 1 and w.isupper():
                shout += k
        if not w.isalpha():
            end = w[-1:]
            if end == b".":
                stops += k
            elif end not in b",;:!?\")'" or not w[:-1].isalpha():
                symbol += k
            if any(48 <= c < 58 for c in w):
                digit += k
    pairs = len(set(zip(words, words[1:])))
    return (np.log1p(len(raw)), np.log1p(n), len(raw) / n, len(counts) / n, np.log1p(len(lines)),
            len(seen) / max(1, len(lines)), again / len(raw), len(raw) / max(1, len(lines)),
            sum(len(x) < 30 for x in lines) / max(1, len(lines)), capital / n, shout / n, symbol / n, digit / n,
            max(counts.values()) / n, 1.0 - pairs / max(1, n - 1) if n > 1 else 0.0, np.log1p(max(map(len, counts))),
            n / (stops + 1))


def features(column: pa.Array) -> np.ndarray:
    """Statistics of a column of texts: rows x FEATURES (float32)."""
    data, offsets = text_buffers(column)
    out = np.zeros((len(column), len(FEATURES)), np.float32)
    table = class_table()
    for a, b in chunks(offsets, CHUNK):
        part, off = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        kinds = table[part]
        size = np.maximum(np.diff(off), 1)
        for k in range(len(CLASSES)):
            sums = np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int64)])
            out[a:b, k] = (sums[off[1:]] - sums[off[:-1]]) / size
        raw = part.tobytes()
        for i in range(b - a):
            out[a + i, len(CLASSES):] = word_statistics(raw[off[i]:off[i + 1]])
    return out


# --- boosting ---------------------------------------------------------------------

@dataclass
class Forest:
    """Trees as flat arrays: node i of a tree has children 2i + 1 and 2i + 2; leaves repeat their value below."""
    feature: np.ndarray        # (trees, inner nodes)
    threshold: np.ndarray      # (trees, inner nodes)
    value: np.ndarray          # (trees, leaves)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.value.shape[1])) if len(self.value) else 0
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - (len(value) - 1)]
        return 1.0 / (1.0 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE,
        least: float = LEAST) -> Forest:
    """Gradient boosting for the log-loss with second-order gains over binned features."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    raw = np.full(len(y), base)
    out = Forest(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)), base)
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            local = node - first
            best = np.full(width, 1e-9)
            pick = [(0, bins)] * width
            g_all = np.bincount(local, grad, width)
            h_all = np.bincount(local, hess, width)
            n_all = np.bincount(local, minlength=width)
            for f in range(x.shape[1]):
                key = local * bins + binned[:, f]
                g = np.bincount(key, grad, width * bins).reshape(width, bins).cumsum(1)
                h = np.bincount(key, hess, width * bins).reshape(width, bins).cumsum(1)
                n = np.bincount(key, minlength=width * bins).reshape(width, bins).cumsum(1)
                gain = (g ** 2 / (h + 1) + (g_all[:, None] - g) ** 2 / (h_all[:, None] - h + 1)
                        - (g_all ** 2 / (h_all + 1))[:, None])
                gain[(n < least) | (n_all[:, None] - n < least)] = -1
                gain[:, len(cuts[f]):] = -1
                at = gain.argmax(1)
                for w in np.flatnonzero(gain[np.arange(width), at] > best):
                    best[w], pick[w] = gain[w, at[w]], (f, int(at[w]))
            for w, (f, cut) in enumerate(pick):
                out.feature[t, first + w] = f
                if cut < bins:
                    out.threshold[t, first + w] = cuts[f][cut]
            f_row = out.feature[t, node]
            node = 2 * node + 1 + (x[np.arange(len(y)), f_row] > out.threshold[t, node])
        leaf = node - inner
        out.value[t] = -rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + 1)
        raw += out.value[t, leaf]
    return out


# --- on Spark -----------------------------------------------------------------------

def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``stats`` (array of FEATURES)."""
    schema = T.StructType([docs.schema[id_col], T.StructField("stats", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features(b.column(1))
            stats = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()),
                                             pa.array(x.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column(0), stats], names=[id_col, "stats"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Fit on the labelled rows with the smallest id hashes, at most ``sample_rows``; only their texts are read."""
    known = labels.select(F.col(id_col).alias(id_col), F.col(label_col).cast("int").alias("label")) \
        .filter(F.col(id_col).isNotNull() & F.col("label").isin(0, 1))
    chosen = {r[0]: r[1] for r in known.orderBy(F.xxhash64(id_col), id_col, "label").limit(sample_rows).collect()}
    if not chosen:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    sample = docs.sparkSession.createDataFrame(list(chosen.items()), T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("label", T.IntegerType())]))
    picked = docs.select(id_col, text_col).join(F.broadcast(sample.select(id_col)), id_col, "left_semi")
    rows = statistics(picked, id_col, text_col).collect()
    rows = sorted((r for r in rows if r[0] in chosen), key=lambda r: r[0])
    x = np.array([r[1] for r in rows], np.float64).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([chosen[r[0]] for r in rows], np.float64))


def score(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``score`` (0 to 1)."""
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])
    # arrays only: executors unpickle a broadcast without this package
    sent = docs.sparkSession.sparkContext.broadcast((forest.feature, forest.threshold, forest.value, forest.base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Forest(*sent.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(held.score(features(b.column(1))))],
                                             names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def op1_quality_trees(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality of every document; learned where crc32(doc_id) mod 5 is not 0."""
    held = id_bucket(F.col("doc_id"), 5) == 0
    forest = train(docs, labels.filter(~held))
    return score(docs, forest).select("doc_id", held.alias("held_out"), "score",
                                      (F.col("score") >= 0.3).cast("int").alias("predicted"))
