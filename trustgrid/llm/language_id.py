"""Language identification by segmentation-marginalised unigrams.

Every language has its own probabilities over one fixed public piece vocabulary. The probability of a word is the sum
over all its segmentations into pieces (forward algorithm), a text's is the product over its words. Probabilities are
learned by expectation-maximisation (forward-backward over all segmentations) from the words of a bounded sample of
labelled texts: at most ``docs_per_lang`` per language, in order of a hash of the id, whole texts.

Words are maximal runs of letters and marks (Unicode categories) with a letter, lower-cased, after the vocabulary's word mark. A character that no piece
covers counts as one unknown piece. Words longer than ``WORD`` characters are scored in parts of that length, so long
runs without blanks cost linear time and none is left out. Scores are the posterior of the best language under equal
priors. Null texts and texts without a letter give ``und`` and score 0; without any label all texts are ``und``.

Rows map one to one and nothing is shuffled; the model (languages x pieces) goes to the tasks as one broadcast of
fixed size. Scores of words are kept per task in a table of at most ``CACHE`` words.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_bucket

MARK = "▁"
WORD = 48
CACHE = 400_000
DOCS_PER_LANG = 300
ROUNDS = 4
UNKNOWN = 1e-9
FLOOR = 1e-7
# Sums are kept times GAIN a character: a part of WORD characters lies between UNKNOWN ** WORD = 1e-432 and 1, scaled
# between 1e-215 and 1e217. A power of two scales without rounding.
GAIN = 2.0 ** 15
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def class_ranges(kinds: str) -> str:
    """The characters whose Unicode category begins with one of ``kinds``, as ranges of a character class."""
    held = [unicodedata.category(chr(i))[0] in kinds for i in range(sys.maxunicode + 1)] + [False]
    edges = [i for i, (a, b) in enumerate(zip([False, *held], held)) if a != b]
    return "".join(f"{chr(a)}-{chr(b - 1)}" for a, b in zip(edges[::2], edges[1::2]))


WORDS = re.compile(f"[{class_ranges('LM')}]+")
ASCII_WORDS = re.compile("[a-z]+")


def load_pieces(path: str = VOCABULARY) -> list[str]:
    """Pieces of a sentencepiece vocabulary, without control and byte pieces."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def words_of(text: str) -> list[str]:
    text = text.lower()
    if text.isascii():
        return ASCII_WORDS.findall(text)
    return [w for w in WORDS.findall(text) if w[0].isalpha() or any(map(str.isalpha, w))]       # not marks alone


def parts_of(word: str) -> list[str]:
    word = MARK + word
    return [word[i:i + WORD] for i in range(0, len(word), WORD)]


class Lattice:
    """All segmentations of many words at once: per end place and piece length, the piece id or -1.

    The pieces form a tree of characters, kept as one sorted array of (node, character) steps. All starts of all words
    walk it together, one character at a time; a start drops out where no piece goes on.
    """

    def __init__(self, pieces: list[str]):
        chars = sorted(set("".join(pieces)))
        number = {c: i for i, c in enumerate(chars)}
        self.n_chars = len(chars) + 1                           # the last number is any other character
        self.chars = np.array([*map(ord, chars), 0xFFFFFFFF], np.uint32)
        steps: dict[int, int] = {}
        ends: dict[int, int] = {}
        for i, piece in enumerate(pieces):
            node = 0
            for c in piece:
                node = steps.setdefault(node * self.n_chars + number[c], len(steps) + 1)
            ends[node] = i
        order = sorted(steps)
        self.steps = np.array([*order, np.iinfo(np.int64).max], np.int64)
        self.child = np.array([*(steps[k] for k in order), 0], np.int64)
        self.piece = np.full(len(steps) + 1, -1, np.int64)
        self.piece[list(ends)] = list(ends.values())

    def edges(self, words: list[str]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(end, length, word numbers, piece ids), ends ascending; ids of unknown single characters are -1."""
        text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        code = np.searchsorted(self.chars, text)
        code = np.where(self.chars[code] == text, code, self.n_chars - 1)
        lengths = np.array([len(w) for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        start = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left = lengths[word] - start
        at, node, size, found = np.arange(len(text)), np.zeros(len(text), np.int64), 0, []
        while len(at):
            size += 1
            step = node * self.n_chars + code[at + size - 1]
            place = np.searchsorted(self.steps, step)
            hit = self.steps[place] == step
            node = self.child[place]
            piece = np.where(hit, self.piece[node], -1)
            use = (piece >= 0) | (size == 1)
            end = start[at[use]] + size
            order = np.argsort(end, kind="stable")
            end, rows, ids = end[order], word[at[use]][order], piece[use][order]
            cuts = np.flatnonzero(np.diff(end)) + 1
            for e, w, i in zip(np.split(end, cuts), np.split(rows, cuts), np.split(ids, cuts)):
                if len(e):
                    found.append((int(e[0]), size, w, i))
            on = hit & (left[at] > size)
            at, node = at[on], node[on]
        return sorted(found, key=lambda x: x[:2])


def forward(edges, probs: np.ndarray, n_words: int, width: int) -> np.ndarray:
    """alpha[word, place, language] times GAIN ** place; ``probs`` has the unknown piece in its last row."""
    alpha = np.zeros((n_words, width + 1, probs.shape[1]))
    alpha[:, 0] = 1.0
    for end, size, w, piece in edges:
        alpha[w, end] += alpha[w, end - size] * (probs[piece] * GAIN ** size)
    return alpha


def word_scores(words: list[str], lattice: Lattice, probs: np.ndarray) -> np.ndarray:
    """log P(word | language), summed over segmentations; rows as ``words``."""
    parts = [p for w in words for p in parts_of(w)]
    owner = np.repeat(np.arange(len(words)), [len(parts_of(w)) for w in words])
    out = np.zeros((len(words), probs.shape[1]))
    lengths = np.array([len(p) for p in parts])
    alpha = forward(lattice.edges(parts), probs, len(parts), int(lengths.max(initial=0)))
    np.add.at(out, owner, np.log(alpha[np.arange(len(parts)), lengths]) - (lengths * np.log(GAIN))[:, None])
    return out


@dataclass
class LanguageModel:
    langs: list[str]
    pieces: list[str]
    probs: np.ndarray           # (pieces + 1, languages); the last row is the unknown piece


def learn(samples: list[tuple[str, str]], pieces: list[str], rounds: int = ROUNDS) -> LanguageModel:
    """Expectation-maximisation of the piece probabilities on (language, text) samples."""
    langs = sorted({lang for lang, _ in samples})
    counts: dict[str, Counter] = {lang: Counter() for lang in langs}
    for lang, text in samples:
        counts[lang].update(p for w in words_of(text) for p in parts_of(w))
    words = sorted(set().union(*counts.values())) if langs else []
    lattice = Lattice(pieces)
    n = len(pieces)
    weight = np.array([[counts[lang][w] for lang in langs] for w in words], float).reshape(len(words), len(langs))
    lengths = np.array([len(w) for w in words], np.int64)
    width = int(lengths.max(initial=0))
    step = 20_000
    blocks = [(slice(a, a + step), lattice.edges(words[a:a + step])) for a in range(0, len(words), step)]
    probs = np.full((n + 1, len(langs)), 1.0 / max(n, 1))
    probs[n] = UNKNOWN
    for _ in range(rounds):
        expected = np.zeros((n + 1, len(langs)))
        for rows, edges in blocks:
            size, m = lengths[rows], weight[rows]
            alpha = forward(edges, probs, len(size), width)
            beta = np.zeros_like(alpha)
            beta[np.arange(len(size)), size] = 1.0
            for end, k, w, piece in reversed(edges):
                beta[w, end - k] += beta[w, end] * (probs[piece] * GAIN ** k)
            whole = beta[:, 0]
            ratio = np.divide(m, whole, out=np.zeros_like(m), where=whole > 0)
            for end, k, w, piece in edges:
                np.add.at(expected, piece, alpha[w, end - k] * (probs[piece] * GAIN ** k) * beta[w, end] * ratio[w])
        total = expected[:n].sum(axis=0, keepdims=True)
        probs = np.empty_like(expected)
        probs[:n] = (expected[:n] + FLOOR * np.maximum(total, 1)) / (np.maximum(total, 1) * (1 + FLOOR * n))
        probs[n] = UNKNOWN
    return LanguageModel(langs, pieces, probs)


def labelled_sample(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, id_col: str = "doc_id",
                    text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """(language, text) of at most ``docs_per_lang`` documents per language.

    The sample is chosen on ids and languages only; then just the chosen texts are read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .filter("lang is not null and text is not null and id is not null")
    # the smallest hashes per language: bounded partial lists per task, merged
    place = F.xxhash64("id")
    langs = [r["lang"] for r in rows.groupBy("lang").count().orderBy("lang").collect()]
    samples = []
    for lang in langs:
        ids = [r["id"] for r in rows.filter(F.col("lang") == lang).select("id").orderBy(place, "id")
               .limit(docs_per_lang).collect()]
        samples.append((lang, ids))
    chosen = sorted({i for _, ids in samples for i in ids})
    texts = rows.filter(F.col("id").isin(chosen)).select("lang", "text").collect() if chosen else []
    return sorted((r["lang"], r["text"]) for r in texts)


def train(docs: DataFrame, pieces: list[str], docs_per_lang: int = DOCS_PER_LANG, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learn from at most ``docs_per_lang`` documents per language; ``docs`` are those that may be learned from."""
    return learn(labelled_sample(docs, docs_per_lang, id_col, text_col, lang_col), pieces)


def least_fits(samples: list[tuple[str, str]], pieces: list[str], slack: float = 2.0) -> dict[str, float]:
    """The fit under which a text is not taken for one in a language: ``slack`` times as far below the median as the
    lowest of the language's sample.

    Each half of the sample is scored by a model of the other half, so that no text is measured by its own words; texts
    that it takes for another language do not count. A language with a single text has no bound.
    """
    halves: list[list[tuple[str, str]]] = [[], []]
    seen: Counter = Counter()
    for lang, text in sorted(set(samples)):
        halves[seen[lang] % 2].append((lang, text))
        seen[lang] += 1
    fits: dict[str, list[float]] = {lang: [] for lang in seen}
    for own, other in (halves, halves[::-1]):
        found, _, fit = Identifier(learn(other, pieces))([text for _, text in own])
        for (lang, _), best, value in zip(own, found, fit):
            if best == lang:
                fits[lang].append(value)
    return {lang: float(np.median(v) - slack * (np.median(v) - min(v))) if v else -np.inf for lang, v in fits.items()}


class Identifier:
    """Language, score and fit of texts by one model; words already seen are looked up.

    The fit is the text's mean log-probability a character (word marks counted) under its best language; None for und.
    """

    def __init__(self, model: LanguageModel):
        self.model, self.lattice = model, Lattice(model.pieces)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.langs)))

    def add(self, words: list[str]) -> None:
        parts = [self.scores]
        for a in range(0, len(words), 20_000):
            parts.append(word_scores(words[a:a + 20_000], self.lattice, self.model.probs))
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.scores = np.concatenate(parts)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float | None]]:
        bags = [Counter(words_of(t)) if t and self.model.langs else Counter() for t in texts]
        words = set().union(*bags)
        new = words - self.known.keys()
        if len(self.known) + len(new) > CACHE:
            self.forget()
            new = words
        if new:
            self.add(sorted(new))
        out, scores, fits = [], [], []
        for bag in bags:
            if not bag:
                out.append("und")
                scores.append(0.0)
                fits.append(None)
                continue
            rows = self.scores[np.fromiter(map(self.known.__getitem__, bag), np.int64, len(bag))]
            times = np.fromiter(bag.values(), float, len(bag))
            total = times @ rows
            best = int(total.argmax())
            out.append(self.model.langs[best])
            scores.append(float(1.0 / np.exp(total - total[best]).sum()))
            fits.append(float(total[best] / (times @ (np.fromiter(map(len, bag), float, len(bag)) + 1))))
        return out, scores, fits


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
             with_fit: bool = False, names: tuple[str, str, str] = ("lang_pred", "score", "fit")) -> DataFrame:
    """``docs`` with lang_pred, score and, if asked for, fit (or other ``names``); all columns pass through once."""
    new = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()),
           T.StructField(names[2], T.DoubleType())][:3 if with_fit else 2]
    taken = {f.name for f in docs.schema.fields} & {f.name for f in new}
    if taken:
        raise ValueError(f"the input has a column {' and '.join(sorted(taken))} already")
    schema = T.StructType([*docs.schema.fields, *new])
    # lists and arrays only: executors unpickle a broadcast without this package
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, model.pieces, model.probs))
    at = docs.columns.index(text_col)
    columns = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ident = Identifier(LanguageModel(*sent.value))
        for whole in batches:
            for a in range(0, whole.num_rows, 512):
                b = whole.slice(a, 512)
                found = ident(b.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, *map(pa.array, found, (pa.string(), pa.float64(), pa.float64()))][:len(columns)], names=columns)

    return docs.mapInArrow(run, schema)


def op2_language_id(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Language of every document; learned where crc32(doc_id) mod 4 is not 2."""
    docs = docs.select("doc_id", "text", "lang")
    held = id_bucket(F.col("doc_id"), 4) == 2
    model = train(docs.filter(~held), load_pieces(vocabulary))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")
