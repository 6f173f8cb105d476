"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case with runs of white space as one blank. An item of n characters may be hit with up to
k = floor(n * ``rate``) edits (insertions, deletions, changes), one at least. It is cut into k + 1 pieces; wherever
the item stands with at most k edits, one piece stands there unchanged. All pieces are searched in one pass over
each whole text (Aho-Corasick), hits of an item on neighbouring diagonals become one window, and Myers' bit-parallel
algorithm gives the least edit distance of the item in that window.

Items shorter than ``min_chars`` would stand in many texts with an edit or inside other words: they have to stand
unchanged (k = 0) and as whole words, with no letter, mark or digit next to a letter, mark or digit of theirs; in
scripts without blanks between words any place counts. Null or blank items and null or empty texts have no hits; repeated items and documents give repeated pairs. Items are sent to the tasks in blocks
of at most ``block_chars`` characters, one pass over the documents per block, so that no broadcast grows with the
benchmark. No shuffle.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATE = 0.05
MIN_CHARS = 40
BLOCK_CHARS = 4_000_000
# Thai to Myanmar, Khmer, Tai, kana, Han: no blanks between words
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff"
                      "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U000323af]")


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def edit_budget(item: str, rate: float = RATE, min_chars: int = MIN_CHARS) -> int:
    return max(1, int(len(item) * rate)) if len(item) >= min_chars else 0


def in_word(a: str, b: str) -> bool:
    """Whether the neighbours a and b belong to one word."""
    return all(unicodedata.category(c)[0] in "LMN" and not UNSPACED.match(c) for c in (a, b))


def stands_alone(text: str, start: int, end: int) -> bool:
    return not (start and in_word(text[start - 1], text[start]) or end < len(text) and in_word(text[end - 1], text[end]))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 consecutive pieces of nearly equal length with their places."""
    n = len(item)
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def character_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def least_distance(masks: dict[str, int], m: int, window: str) -> tuple[int, int]:
    """Myers: least edit distance of the pattern to any substring of ``window``, and where that one ends."""
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, at = m, 0
    get = masks.get
    for i, c in enumerate(window):
        eq = get(c, 0)
        x = eq | down
        diag = ((((eq & up) + up) ^ up) | eq)
        plus = down | ~(diag | up) & full
        minus = up & diag
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | ~(x | plus) & full
        down = plus & x
        if score < best:
            best, at = score, i + 1
    return best, at


class ItemIndex:
    """Pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float, min_chars: int = MIN_CHARS):
        self.items, self.masks = [], []
        where: dict[str, list[tuple[int, int]]] = {}
        for key, text in items:
            k, n = edit_budget(text, rate, min_chars), len(self.items)
            self.items.append((key, len(text), k))
            self.masks.append(character_masks(text))
            for at, piece in pieces(text, k):
                where.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple[int, int, int]]:
        """(item number, distance, end) of every item that stands in ``text`` within its budget; its best place."""
        diagonals: dict[int, list[int]] = {}
        if not self.items or not text:
            return []
        for end, (n, places) in self.automaton.iter(text):
            for item, at in places:
                diagonals.setdefault(item, []).append(end + 1 - n - at)
        found = []
        for item, starts in diagonals.items():
            _, m, k = self.items[item]
            if k == 0:
                start = next((s for s in starts if stands_alone(text, s, s + m)), None)
                if start is not None:
                    found.append((item, 0, start + m))
                continue
            best = (k + 1, 0)
            for low, high in windows(sorted(set(starts)), m, k, len(text)):
                distance, at = least_distance(self.masks[item], m, text[low:high])
                best = min(best, (distance, low + at))
                if best[0] == 0:
                    break
            if best[0] <= k:
                found.append((item, *best))
        return sorted(found)


def windows(starts: list[int], m: int, k: int, n: int) -> Iterator[tuple[int, int]]:
    """Stretches of text around the diagonals; diagonals within the budget share one."""
    first = last = starts[0]
    for s in starts[1:]:
        if s - last > k:
            yield max(0, first - k), min(n, last + m + k)
            first = s
        last = s
    yield max(0, first - k), min(n, last + m + k)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", rate: float = RATE, min_chars: int = MIN_CHARS,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Pairs (document, item) with ``distance``, ``budget`` and ``ends_at`` in the normalised text."""
    spark = docs.sparkSession
    bench = items.select(F.col(item_col).alias("key"), F.col(item_text).alias("text")).filter(F.col("text").isNotNull())
    size = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * size // block_chars))      # half full on average
    schema = T.StructType([docs.schema[id_col], T.StructField(item_col, id_field(items, item_col)),
                           T.StructField("distance", T.IntegerType()), T.StructField("budget", T.IntegerType()),
                           T.StructField("ends_at", T.LongType())])
    out = None
    for block in range(blocks):
        rows = bench.filter(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == block).collect()
        kept = sorted(((r["key"], normal(r["text"])) for r in rows), key=str)
        sent = spark.sparkContext.broadcast([x for x in kept if x[1]])
        pairs = docs.select(id_col, text_col).mapInArrow(searcher(sent, rate, min_chars, schema), schema)
        out = pairs if out is None else out.unionByName(pairs)
    return out


def id_field(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def searcher(sent, rate: float, min_chars: int, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(sent.value, rate, min_chars)
        for b in batches:
            ids, cols = [], ([], [], [], [])
            for i, t in enumerate(b.column(1).to_pylist()):
                for item, distance, end in index.search(normal(t)) if t else ():
                    ids.append(i)
                    for c, v in zip(cols, (index.items[item][0], distance, index.items[item][2], end)):
                        c.append(v)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(ids, pa.int64())),
                     *[pa.array(c, f.type) for c, f in zip(cols, list(arrow)[1:])]], schema=arrow)

    return run


def op10_decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Every (document, benchmark item) pair where the item stands within its edit budget."""
    return find_leaks(docs, items)
