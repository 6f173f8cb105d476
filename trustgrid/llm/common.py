"""Shared helpers: tables in the shared folder, Arrow text access, vectorised substring hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a local session without it gets a scratch folder."""
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="trustgrid-llm-", dir="/tmp")
        spark.conf.set(CHECKPOINT_CONF, folder)
    return folder.rstrip("/")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh place in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/trustgrid-llm/{uuid.uuid4().hex}/{name}"
    # the shuffle files of this write are of no use once the table stands
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def width(spark: SparkSession) -> int:
    """Partitions for shuffles that are set by hand: the session's own number."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(names: list[str], name: str) -> str:
    """``name``, or with as many underscores before it as make it differ from all ``names`` (case aside)."""
    taken = {n.lower() for n in names}
    while name.lower() in taken:
        name = "_" + name
    return name


def id_bucket(col, n: int):
    """crc32(id as text) mod n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


# crc32 in DuckDB, which has none: a table of one row with the 256 steps, and the checksum of a text of ASCII characters.
# The expression needs the table's column ``steps`` in scope.
CRC_TABLE = """SELECT list_transform(range(256), lambda c: list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS steps"""


def crc32_sql(text: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))), "
            "lambda a, b: xor(a >> 8, steps[CAST((xor(a, b) & 255) + 1 AS BIGINT)])), 4294967295)")


# --- Arrow text -------------------------------------------------------------------

def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and its offsets, first offset 0; null texts are empty."""
    column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        kind = np.int64
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold up to ``limit`` bytes together (one row at least)."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


# --- hashes -------------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over uint64 arrays."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def code_table(n: int = 256, seed: int = 1) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


BASE = 0xD1342543DE82EF95          # odd: it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 2 ** 64)


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Prefix sums of codes[j] * BASE**j modulo 2**64; ``codes`` are uint64."""
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * powers(len(codes), BASE)[:len(codes)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span [start, end): equal content gives equal hashes wherever it stands."""
    return mix((sums[ends] - sums[starts]) * inverse[starts])


class SpanHasher:
    """Hashes of byte spans of one buffer; powers are kept from one buffer to the next."""

    def __init__(self) -> None:
        self.codes = code_table()
        self.up = self.down = np.zeros(0, np.uint64)

    def load(self, raw: np.ndarray) -> None:
        n = len(raw) + 1
        if len(self.up) < n:
            self.up, self.down = powers(n + n // 4, BASE), powers(n + n // 4, INVERSE)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(self.codes[raw] * self.up[:n - 1], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])
