"""Document fingerprints from Lempel-Ziv phrases.

Each text is parsed into its LZ78 phrases (the shortest strings not seen before in that text), the phrase set is
hashed, and ``slots`` minimum hashes make the signature. Two signatures agree in a slot with the chance of the
phrase sets' Jaccard similarity, so texts that compress alike look alike.

Null and empty texts have the empty fingerprint; two empty ones are alike (1.0), an empty and another are not (0.0).
Equal texts have equal fingerprints.

The neighbour comparison needs each text beside the next one by id. Documents are dealt by ranges of the id (bounds
from a quantile sketch of the ids alone) and sorted inside; the first document of a range is also sent to the range
before it, so texts are shuffled once and no task holds more than its rows, one at a time. Rows with equal ids are
ordered by text, null ids come first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import INVERSE, mix, powers, prefix_sums, span_hashes, width

SLOTS = 64


def slot_factors(slots: int) -> np.ndarray:
    return mix(np.arange(1, slots + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def phrases(text: str, seen: set[str], word: str = "") -> tuple[list[str], str]:
    """LZ78 phrases that ``text`` adds to ``seen``, and the open phrase at its end; ``word`` is the one open before."""
    new: list[str] = []
    keep, add = new.append, seen.add
    for c in text:
        word += c
        if word not in seen:
            add(word)
            keep(word)
            word = ""
    return new, word


def signature(words: list[str], factors: np.ndarray, step: int = 1 << 14) -> np.ndarray:
    """Minimum hash of the phrases per slot (uint32); all ones where there is no phrase."""
    best = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(words), step):
        part = words[i:i + step]
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))
        codes = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        sums = prefix_sums(mix(codes + np.uint64(1)))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        h = span_hashes(sums, powers(len(codes), INVERSE), starts, ends)
        best = np.minimum(best, ((h[:, None] * factors[None, :]) >> np.uint64(32)).min(axis=0).astype(np.uint32))
    return best


def fingerprints(text: str, kept: int, tail: str, factors: np.ndarray) -> tuple[str, str]:
    """Fingerprints of ``text`` and of ``text[:kept] + tail``; the shared beginning is parsed once."""
    seen: set[str] = set()
    first, word = phrases(text[:kept], seen)
    head = signature(first, factors)
    out = []
    for end in (text[kept:], tail):
        new, rest = phrases(end, seen, word)
        if kept + len(end) == 0:
            out.append("")
        else:
            own = signature(new + [rest] if rest else new, factors)
            out.append(np.minimum(head, own).astype(">u4").tobytes().hex())
        seen.difference_update(new)
    return out[0], out[1]


def likeness(a: str, b: str, slots: int) -> float:
    if not a or not b:
        return 1.0 if a == b else 0.0
    x, y = (np.frombuffer(bytes.fromhex(s), ">u4") for s in (a, b))
    return float((x == y).sum()) / slots


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          slots: int = SLOTS) -> DataFrame:
    """One row per document: id and fingerprint of the whole text. No shuffle."""
    schema = T.StructType([docs.schema[id_col], T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = slot_factors(slots)
        for b in batches:
            out = [fingerprints(t or "", len(t or ""), "", factors)[0] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=[id_col, "fingerprint"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt by id range: ``part`` (range), ``turn`` (order inside), ``ghost`` (only there to be the next one)."""
    spark = docs.sparkSession
    n = width(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    cuts = sorted(set(rows.select("id").approxQuantile("id", [i / n for i in range(1, n)], 0.2 / n))) if n > 1 else []
    cuts = [int(c) for c in cuts]
    bounds = F.array(*[F.lit(c) for c in cuts]).cast("array<long>")
    # number of bounds at or below the id: the session's own number of ranges, so the array stays short
    part = F.when(F.col("id").isNull(), 0).otherwise(F.size(F.filter(bounds, lambda c: c <= F.col("id")))).cast("int")
    ranged = rows.withColumn("part", part)
    # the first id of every range that has rows: at most one per range
    firsts = [(r["part"], r["first"]["id"]) for r in
              ranged.groupBy("part").agg(F.min(F.struct("id")).alias("first")).orderBy("part").collect()]
    if not firsts:
        return ranged.withColumn("turn", F.lit(0))
    # rows with that id also go to the range before; the very first ones to the last range, after all others
    ghosts = [(p, i, firsts[k - 1][0], 2 if k == 0 else 1) for k, (p, i) in enumerate(firsts)]
    ghosts = spark.createDataFrame(ghosts, "p int, i long, target int, after int")
    marked = ranged.join(F.broadcast(ghosts), (F.col("part") == F.col("p")) & F.col("id").eqNullSafe(F.col("i")), "left")
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("turn"))
    other = F.struct(F.col("target").alias("part"), F.col("after").alias("turn"))
    places = F.when(F.col("target").isNull(), F.array(own)).otherwise(F.array(own, other))
    return (marked.withColumn("place", F.explode(places))
            .select("id", "text", F.col("place.part").alias("part"), F.col("place.turn").alias("turn")))


def op5_lz_fingerprint(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Fingerprint of each text, of its edited text, and their likeness to it and to the next document's."""
    spark = docs.sparkSession
    placed = with_next(docs, "doc_id", "text")
    n = width(spark)
    dealt = placed.repartitionById(n, F.col("part")).sortWithinPartitions("part", "turn", "id", "text")
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = slot_factors(slots)
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
            done.clear()
            return out

        held: tuple | None = None      # the row that waits for its next one
        waiting: tuple | None = None   # the result of the row before, which waits for this row's fingerprint

        for batch in batches:
            for doc, text, part, turn in zip(*(c.to_pylist() for c in batch.columns)):
                if held is not None and held[2] == part:
                    waiting = _finish(held, text, waiting, done, factors, slots)
                    if turn:
                        _close(waiting, fingerprints(text, len(text), "", factors)[0], done, slots)
                        waiting = None
                held = None if turn else (doc, text, part)
                if len(done) >= 512:
                    yield flush()
        if done:
            yield flush()

    return dealt.mapInArrow(run, schema)


def _finish(held: tuple, following: str, waiting: tuple | None, done: list, factors: np.ndarray, slots: int) -> tuple:
    """Fingerprint the held row with the text that follows; close the row before it with that fingerprint."""
    doc, text, _ = held
    q = len(text) // 4
    kept, tail = len(text) - q, following[:q]
    own, edited = fingerprints(text, kept, tail, factors)
    if waiting is not None:
        _close(waiting, own, done, slots)
    digest = hashlib.sha256((text[:kept] + tail).encode()).hexdigest()
    return doc, len(text), digest, own, edited, likeness(own, edited, slots)


def _close(waiting: tuple, following: str, done: list, slots: int) -> None:
    done.append((*waiting, likeness(waiting[3], following, slots)))
