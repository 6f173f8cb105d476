"""Join-safe lookups: one row per key, ambiguous keys marked, never fan out.

A directory at row grain (e.g. post offices) must not be joined directly:
one code on many rows multiplies the other side. ``join_safe_lookup``
reduces it to one row per code first, with the value sets, counts and a
representative only when the code is unambiguous.

No group is gathered whole. Rows are counted per (code, value) first, so a
code that a third of all rows share spreads over its values; that table, with
every spelling and its rows, is a result of its own (``key_values``). From it
counts and representatives are algebraic. Lists hold every value: of each the
``NAMES`` smallest are taken by a row limit that Spark applies in every task
before and after the shuffle, and the rest of a longer one is dealt by range
over all tasks and joined there in blocks, so that only its text meets in one
row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgrid.operators.joins import many_to_one_join, null_safe_join

NAMES = 32
# A block has at most two to this power of values.
BLOCK_BITS = 12


def key_values(rows: DataFrame, keys: Sequence[str], columns: Mapping[str, str], **sums: Column) -> DataFrame:
    """(keys, kind, value, rows, sums): how often each value of each column occurs per key, nulls included.

    ``columns`` maps a kind to a column; ``sums`` are further numbers to add up. Two counts, by all columns at once and
    then by one: a value that many rows share is one row per task before the second.
    """
    combined = rows.groupBy(*keys, *dict.fromkeys(columns.values())).agg(
        F.count("*").alias("rows"), *[F.sum(c).alias(n) for n, c in sums.items()])
    cells = F.inline(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("value"))
                               for kind, c in columns.items()]))
    return combined.select(*keys, "rows", *sums, cells).groupBy(*keys, "kind", "value").agg(
        F.sum("rows").alias("rows"), *[F.sum(n).alias(n) for n in sums])


def smallest_values(values: DataFrame, keys: Sequence[str], kinds: Mapping[str, str], n: int = NAMES) -> DataFrame:
    """Per key the ``n`` smallest values of each kind, ``|``-joined; ``kinds`` maps a kind to its output column."""
    place = F.row_number().over(Window.partitionBy(*keys, "kind").orderBy("value"))
    first = (values.where(F.col("value").isNotNull() & F.col("kind").isin(*kinds)).withColumn("__place", place)
             .where(F.col("__place") <= n))
    return first.groupBy(*keys).agg(*[
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.col("value")))), "|").alias(out)
        for k, out in kinds.items()])


def every_value(values: DataFrame, keys: Sequence[str], kinds: Mapping[str, str], n: int = NAMES) -> DataFrame:
    """Per key all values of each kind in order, ``|``-joined; ``kinds`` maps a kind to its output column.

    ``n`` is no bound: after its ``n`` smallest values a longer list goes on with blocks of the others.
    """
    by = [*keys, "kind"]
    values = values.where(F.col("value").isNotNull() & F.col("kind").isin(*kinds)).select(*by, "value")
    place = F.row_number().over(Window.partitionBy(*by).orderBy("value")).cast("long")
    first = values.withColumn("__place", place).where(F.col("__place") <= n)
    last = first.where(F.col("__place") == n).select(*by, F.col("value").alias("__last"))
    dealt = (null_safe_join(values, last, by, "inner").where(F.col("value") > F.col("__last"))
             .repartitionByRange(*by, "value").sortWithinPartitions(*by, "value"))
    # ids rise from range to range, and a block lies in one of them
    block = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)
    rest = dealt.withColumn("__block", block).groupBy(*by, "__block").agg(
        F.array_join(F.array_sort(F.collect_list("value")), "|").alias("__text"))
    parts = first.select(*by, "__place", F.col("value").alias("__text")).unionByName(
        rest.select(*by, (F.col("__block") + n + 1).alias("__place"), "__text"))
    return parts.groupBy(*keys).agg(*[
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("__place", "__text")))),
                                 lambda part: part["__text"]), "|").alias(out)
        for k, out in kinds.items()])


def join_safe_lookup(rows: DataFrame, key: str, district_key: str, state_key: str,
                     district_name: str, state_name: str, has_coords: str, names: int | None = None) -> DataFrame:
    """One row per ``key`` (null keys are not keys and are left out). Lists are whole; a caller may ask for the ``names`` smallest."""
    kinds = {"districts": district_key, "states": state_key, "district_names": district_name, "state_names": state_name}
    values = key_values(rows.where(F.col(key).isNotNull()), [key], kinds, geocoded=F.col(has_coords).cast("int"))

    def of(kind: str) -> Column:
        return F.col("kind") == kind

    def distinct(kind: str) -> Column:
        return F.count_if(of(kind) & F.col("value").isNotNull())

    totals = values.groupBy(key).agg(
        F.sum(F.when(of("districts"), F.col("rows"))).alias("post_office_count"),
        distinct("districts").alias("district_count"), distinct("states").alias("state_count"),
        distinct("district_names").alias("district_name_count"), distinct("state_names").alias("state_name_count"),
        F.coalesce(F.sum(F.when(of("districts"), F.col("geocoded"))), F.lit(0)).alias("geocoded_office_count"),
        F.min(F.when(of("districts"), F.col("value"))).alias("__district"),
        F.min(F.when(of("states"), F.col("value"))).alias("__state"))
    listed = {"districts": "district_keys", "states": "state_keys", "district_names": "district_names", "state_names": "state_names"}
    lists = every_value(values, [key], listed) if names is None else smallest_values(values, [key], listed, names)
    joined = null_safe_join(totals, lists, [key])
    ambiguous = (F.col("district_count") > 1) | (F.col("state_count") > 1)
    return joined.select(
        key, "post_office_count", "district_count", "state_count",
        *[F.coalesce(c, F.lit("")).alias(c) for c in listed.values()],
        "district_name_count", "state_name_count", "geocoded_office_count",
        ambiguous.alias("is_geography_ambiguous"),
        F.when(~ambiguous, F.col("__district")).alias("representative_district_key"),
        F.when(~ambiguous, F.col("__state")).alias("representative_state_key"))


# Match status labels, first true wins.
MATCH_AMBIGUOUS = "ambiguous_code_geography"
MATCH_NO_REPRESENTATIVE = "no_representative_district"
MATCH_UNMATCHED = "unmatched_survey_district"
MATCH_OK = "matched"


def match_status(is_ambiguous: Column, rep_district: Column, matched_name: Column) -> Column:
    return (F.when(is_ambiguous, F.lit(MATCH_AMBIGUOUS))
            .when(rep_district.isNull(), F.lit(MATCH_NO_REPRESENTATIVE))
            .when(matched_name.isNull(), F.lit(MATCH_UNMATCHED))
            .otherwise(F.lit(MATCH_OK)))


def enrich_codes(lookup: DataFrame, districts: DataFrame, prefix: str = "survey_") -> DataFrame:
    """Lookup LEFT JOIN a district table (unique on state_key, district_key).

    The right side is prefixed, joined on the representative keys, and its key
    columns are dropped. The right side is already one row per key, so the
    join keeps the lookup's row count. AQE broadcasts it when it is small at
    run time and keeps a shuffle join when it is not; a hot representative
    district is split by AQE or salted (see ``operators.joins``).
    """
    right = districts.select(
        F.col("state_key").alias("_r_state_key"), F.col("district_key").alias("_r_district_key"),
        *[F.col(c).alias(prefix + c) for c in districts.columns if c not in ("state_key", "district_key")],
    )
    # One district can be the representative of a third of all codes.
    joined = many_to_one_join(lookup, right, ["representative_state_key", "representative_district_key"],
                              ["_r_state_key", "_r_district_key"], "left")
    return joined.withColumn("match_status", match_status(
        F.col("is_geography_ambiguous"), F.col("representative_district_key"),
        F.col(prefix + "district_name")))


def unmatched_codes(lookup: DataFrame, districts: DataFrame) -> DataFrame:
    """Unambiguous codes whose representative district has no row on the right."""
    right = districts.select(F.col("state_key").alias("_s"), F.col("district_key").alias("_d"))
    return lookup.where(~F.col("is_geography_ambiguous") & F.col("representative_district_key").isNotNull()).join(
        right,
        (F.col("representative_state_key") == F.col("_s")) & (F.col("representative_district_key") == F.col("_d")),
        "left_anti",
    )
