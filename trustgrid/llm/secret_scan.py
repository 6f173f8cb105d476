"""Secret scan with multipart credential linking.

Strong findings (``assign``, ``access``, ``hex``) follow fixed patterns. Weak parts - account identifiers, mixed
tokens and endpoints - are too common to report alone. Every weak part is joined by interval with the other parts
of its scope (the paragraph around it, ``reach`` code points either way) and is reported only when a complementary
part stands there: a secret beside an identifier or endpoint, an identifier or endpoint beside a secret.

Null or empty texts have no spans. Rows map one to one; repeated rows give repeated results; extra columns are
ignored. Scopes never cross documents, so no shuffle is needed and a lost task is simply run again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("assign", "access", "hex", "identifier", "token", "endpoint")
REACH = 160

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
                    .replace("(password|passwd|secret|token|api_?key)", "((?i:password|passwd|secret|token|api_?key))"),
                    re.ASCII)
# Runs are maximal, so asking for the least length finds the same matches as filtering afterwards.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

IDENTIFIER = re.compile(r"""(?i:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""",
                        re.ASCII)
IDENTIFIER_WORDS = ("user", "login", "account", "client")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
ENDPOINT = re.compile(r"""[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]+|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?::\d{1,5})?(?![\d.])""")
PARAGRAPH = re.compile(r"\n[ \t]*\n")

Span = tuple[int, int]


def strong_spans(text: str) -> dict[str, list[Span]]:
    """The fixed kinds: leftmost non-overlapping matches of each pattern; short values fail."""
    low = text.lower()
    assign: list[Span] = []
    if any(k in low for k in KEYWORDS):
        assign = [m.span() for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    access = [m.span() for m in ACCESS.finditer(text)] if "AKIA" in text else []
    return {"assign": assign, "access": access, "hex": [m.span() for m in HEX.finditer(text)]}


def _mixed(token: str) -> bool:
    """A token of letters in both cases and digits; words and plain numbers are not."""
    return any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)


def weak_parts(text: str, strong: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Weak identifiers, tokens and endpoints that overlap no strong span."""
    low = text.lower()
    ids = [m.span() for m in IDENTIFIER.finditer(text)] if any(w in low for w in IDENTIFIER_WORDS) else []
    ends = [m.span() for m in ENDPOINT.finditer(text)] if "://" in text or "." in text else []
    tokens = [m.span() for m in TOKEN.finditer(text) if _mixed(m.group())]
    taken = sorted(s for spans in strong.values() for s in spans)
    out = {}
    for kind, spans in (("identifier", ids), ("token", tokens), ("endpoint", ends)):
        out[kind] = [s for s, hit in zip(spans, _meets(spans, taken, 0, None)) if not hit]
    return out


def _meets(spans: list[Span], others: list[Span], reach: int, blocks: np.ndarray | None) -> np.ndarray:
    """Interval join: for each span, whether one of ``others`` reaches into its scope. Sorted ends, two searches each."""
    if not spans or not others:
        return np.zeros(len(spans), bool)
    s, o = np.array(spans, np.int64), np.array(others, np.int64)
    low, high = s[:, 0] - reach, s[:, 1] + reach
    if blocks is not None:
        k = np.searchsorted(blocks, s[:, 0], side="right")
        low = np.maximum(low, np.concatenate([[0], blocks])[k])
        high = np.minimum(high, np.concatenate([blocks, [np.iinfo(np.int64).max]])[k])
    begun = np.searchsorted(np.sort(o[:, 0]), high, side="left")
    over = np.searchsorted(np.sort(o[:, 1]), low, side="right")
    return begun > over


def linked_spans(text: str, reach: int = REACH) -> list[tuple[int, str, int]]:
    """All findings of one text as (start, kind, end): strong ones, and weak ones with a complement in scope."""
    strong = strong_spans(text)
    found = [(a, k, b) for k, spans in strong.items() for a, b in spans]
    weak = weak_parts(text, strong)
    if any(weak.values()):
        blocks = np.array([m.end() for m in PARAGRAPH.finditer(text)], np.int64)
        secrets = strong["assign"] + strong["hex"] + weak["token"]
        partners = strong["access"] + weak["identifier"] + weak["endpoint"]
        for kind, others in (("token", partners), ("identifier", secrets), ("endpoint", secrets)):
            found += [(a, kind, b) for (a, b), hit in zip(weak[kind], _meets(weak[kind], others, reach, blocks)) if hit]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """One row per document with ``findings``: array of (kind, start, end) in code points, by start, then kind."""
    finding = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                            T.StructField("end", T.LongType())])
    schema = T.StructType([docs.schema[id_col], T.StructField("findings", T.ArrayType(finding))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            rows = [[{"kind": k, "start": a, "end": e} for a, k, e in linked_spans(t or "", reach)]
                    for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], names=[id_col, "findings"])

    return docs.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, schema)


def op6_secret_scan(docs: DataFrame) -> DataFrame:
    """The digest columns of the scan; every column derives from ``findings``."""
    base = [F.lit(k) for k in KINDS[:3]]
    text = lambda arr: F.array_join(F.transform(
        arr, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("findings", lambda x: x["kind"] == k)).cast("long")
    strong = F.filter("findings", lambda x: x["kind"].isin(*base))
    return scan_secrets(docs).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(text(strong).cast("binary"), 256).alias("base_sha256"), text(F.col("findings")).alias("spans"),
        F.size(F.filter("findings", lambda x: ~x["kind"].isin(*base))).cast("long").alias("n_linked"))
