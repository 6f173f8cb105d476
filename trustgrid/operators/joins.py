"""Many-to-one joins that stay balanced when one key is hot.

The right side is unique per key (a join-safe lookup), so a hot key never
multiplies output; it only makes one partition of the left side large.
With AQE skew-join handling on (the default session of this library), Spark
splits that partition at run time and replicates the matching right rows.
When it is off, the join is salted explicitly: a key gets salts in proportion
to its rows, one per ``hot_threshold`` of them, and its right row is
replicated once per salt, so every share of a hot key is about as large;
cold keys join unchanged. Rows with a null key match nothing: they are dealt
out by a hash of their own columns, so that they do not meet in one task.

A right side that is known to be small only by counting it is staged, counted
and broadcast below a bound (``checked_join``): the left side then never moves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgrid.sources.staging import staged

SKEW_CONF = "spark.sql.adaptive.skewJoin.enabled"
AQE_CONF = "spark.sql.adaptive.enabled"


def aqe_splits_skew(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    return (conf.get(AQE_CONF, "true").lower() == "true") and (conf.get(SKEW_CONF, "true").lower() == "true")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` in which null equals null; the right side's keys are dropped."""
    named = right.select(*[F.col(k).alias(f"__right_{i}") for i, k in enumerate(keys)],
                         *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__right_{i}"))
    return left.join(named, cond, how).drop(*[f"__right_{i}" for i in range(len(keys))])


# Without AQE, keys holding at least this many left rows are salted; the rest join as they are.
DEFAULT_HOT_ROWS = 1_000_000
# Places that rows with a null key are dealt to.
NULL_SPREAD = 4096


def _row_hash(df: DataFrame) -> Column:
    """From the row's own columns: stable across task retries."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def many_to_one_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
                     how: str = "left", force_salt: bool = False, hot_threshold: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """``left`` JOIN ``right`` on key lists (right unique per key); keys of the right side are dropped from the output.

    When the join is salted, keys with ``hot_threshold`` left rows or more are found by one key count. There are at
    most rows / ``hot_threshold`` of them, which bounds their broadcast, and as many copies of right rows in all.
    """
    if len(left_keys) != len(right_keys):
        raise ValueError("key lists differ in length")
    hot_threshold = max(1, hot_threshold)
    null_key = reduce(lambda a, b: a | b, [left[k].isNull() for k in left_keys])
    own = _row_hash(left)
    dealt = -1 - F.pmod(own, F.lit(NULL_SPREAD))
    first = F.pmod(F.xxhash64(*[right[k] for k in right_keys]), F.lit(1))        # 0; no constant, so it stays a join key
    if force_salt or not aqe_splits_skew(left):
        names = [f"_hot_{i}" for i in range(len(left_keys))]
        hot = (left.groupBy(*left_keys).count().where(F.col("count") >= hot_threshold)
               .select(*[F.col(k).alias(n) for k, n in zip(left_keys, names)],
                       F.ceil(F.col("count") / hot_threshold).alias("_salts")))

        def tagged(df: DataFrame, keys: Sequence[str]) -> DataFrame:
            return df.join(F.broadcast(hot), reduce(lambda a, b: a & b, [df[k] == F.col(n) for k, n in zip(keys, names)]), "left")

        salt = F.when(null_key, dealt).when(F.col("_salts").isNotNull(), F.pmod(own, F.col("_salts"))).otherwise(F.lit(0))
        salted = tagged(left, left_keys).withColumn("_salt", salt).drop("_salts", *names)
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1))
        copied = tagged(right, right_keys).withColumn("_r_salt", copies).drop("_salts", *names)
    else:
        salted = left.withColumn("_salt", F.when(null_key, dealt).otherwise(F.lit(0)))
        copied = right.withColumn("_r_salt", first)
    cond = F.col("_salt") == F.col("_r_salt")
    for lk_, rk in zip(left_keys, right_keys):
        cond = cond & (salted[lk_] == copied[rk])
    return salted.join(copied, cond, how).drop("_salt", "_r_salt", *[copied[k] for k in right_keys])


# About 50 MB as a hash table of rows with a few columns.
SMALL_ROWS = 200_000


def checked_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], how: str = "left",
                 most: int = SMALL_ROWS) -> DataFrame:
    """``many_to_one_join`` in which ``right`` is staged and counted: up to ``most`` rows it is broadcast and ``left`` is not
    shuffled; a longer one is joined by shuffle."""
    right = staged(right, "small_side")
    if right.limit(most + 1).count() > most:
        return many_to_one_join(left, right, left_keys, right_keys, how)
    cond = reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in zip(left_keys, right_keys)])
    return left.join(F.broadcast(right), cond, how).drop(*[right[k] for k in right_keys])
