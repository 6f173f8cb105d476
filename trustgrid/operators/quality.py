"""Contract evaluation: declared rules -> (dataset, check, observed, status).

Each dataset's rules compile to ONE aggregation (one scan), the per-rule
results are turned into rows by a generator, and the status is *computed*
from the rule (``pass`` when the comparison holds, else the rule's
severity ``warn`` / ``fail``) instead of being written down.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPARATORS = ("eq", "le", "ge")


@dataclass(frozen=True)
class Rule:
    """A contract rule: ``observed <comparator> threshold`` must hold."""

    dataset: str
    name: str
    severity: str  # "fail" or "warn"
    observed: Column  # an aggregate expression over the dataset
    comparator: str = "eq"
    threshold: float = 0.0

    def __post_init__(self):
        if self.severity not in ("fail", "warn"):
            raise ValueError(f"severity must be fail or warn, got {self.severity}")
        if self.comparator not in COMPARATORS:
            raise ValueError(f"comparator must be one of {COMPARATORS}")


@dataclass(frozen=True, eq=False)
class CompiledRules:
    """The aggregation, the row generator and the status rule for a rule list."""

    aggs: tuple
    rows: Column
    status: Column


def compile_rules(rules: Sequence[Rule]) -> CompiledRules:
    if not rules:
        raise ValueError("no rules")
    aggs = tuple(r.observed.cast("double").alias(f"_r{i}") for i, r in enumerate(rules))
    cells = F.array(*[
        F.struct(F.lit(r.dataset).alias("dataset"), F.lit(r.name).alias("check_name"),
                 F.lit(r.severity).alias("severity"), F.col(f"_r{i}").alias("observed_value"),
                 F.lit(r.comparator).alias("comparator"), F.lit(float(r.threshold)).alias("threshold"))
        for i, r in enumerate(rules)
    ])
    holds = (F.when(F.col("comparator") == "eq", F.col("observed_value") == F.col("threshold"))
             .when(F.col("comparator") == "le", F.col("observed_value") <= F.col("threshold"))
             .otherwise(F.col("observed_value") >= F.col("threshold")))
    status = F.when(F.coalesce(holds, F.lit(False)), F.lit("pass")).otherwise(F.col("severity"))
    return CompiledRules(aggs, F.inline(cells), status)


def evaluate_compiled(df: DataFrame, compiled: CompiledRules) -> DataFrame:
    return df.agg(*compiled.aggs).select(compiled.rows).withColumn("status", compiled.status)


def evaluate_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rules of one dataset in one aggregation, one output row per rule."""
    return evaluate_compiled(df, compile_rules(rules))


def compile_contracts(rules: Sequence[Rule]) -> dict[str, CompiledRules]:
    by_dataset: dict[str, list[Rule]] = {}
    for r in rules:
        by_dataset.setdefault(r.dataset, []).append(r)
    return {name: compile_rules(rs) for name, rs in by_dataset.items()}


def evaluate_contracts(tables: dict[str, DataFrame], rules: Sequence[Rule] | dict[str, CompiledRules]) -> DataFrame:
    """Union of per-dataset evaluations (each one scan of its table).

    ``rules`` may be pre-compiled (``compile_contracts``) so a fixed rule set
    builds its expressions once."""
    compiled = rules if isinstance(rules, dict) else compile_contracts(rules)
    out = None
    for name, df in tables.items():
        if name not in compiled:
            continue
        part = evaluate_compiled(df, compiled[name])
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no rule matches any table")
    return out


# --- keys of several tables in one pass ---------------------------------------------------

@dataclass(frozen=True)
class KeyUse:
    """A table's use of a key: as its own (``owner``, to be unique) or as a reference to the owner's."""

    kind: str
    columns: tuple[str, ...]
    owner: bool


def key_counts(tables: Mapping[str, tuple[DataFrame, Sequence[KeyUse], Mapping[str, Column]]]) -> DataFrame:
    """(kind, key, owned, used, f_0 ... f_n): one row per key of each kind, from one scan of every table.

    ``tables`` maps a name to its rows, the keys in them and conditions to count (the f columns, in the order of all
    conditions of all tables; a condition is counted with the first key of its table). Each row is spread into one small
    row per key it uses; all meet in one aggregation by (kind, key), in which a frequent key is one row per task.
    Columns of a key are compared as one binary value; a null part makes a null key.
    """
    flags = [(t, name) for t, (_, _, conditions) in tables.items() for name in conditions]
    parts = []
    for table, (df, uses, conditions) in tables.items():
        rows = []
        for i, use in enumerate(uses):
            text = [F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")) for c in use.columns]
            key = F.col(use.columns[0]).cast("string") if len(use.columns) == 1 else F.concat(*text)
            rows.append(F.struct(
                F.lit(use.kind).alias("kind"), key.alias("key"), F.lit(int(use.owner)).alias("owned"),
                F.lit(int(not use.owner)).alias("used"),
                *[(F.when(F.coalesce(conditions[n], F.lit(True)), 1).otherwise(0) if t == table and i == 0 else F.lit(0)).alias(f"f_{k}")
                  for k, (t, n) in enumerate(flags)]))
        parts.append(df.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts).groupBy("kind", "key").agg(
        *[F.sum(c).alias(c) for c in ("owned", "used", *(f"f_{k}" for k in range(len(flags))))])


def owned_again(kind: str) -> Column:
    """Rows beyond the first of their key, null keys included (0 when the key is unique and present)."""
    more = F.when(F.col("key").isNull(), F.col("owned")).otherwise(F.greatest(F.col("owned") - 1, F.lit(0)))
    return F.coalesce(F.sum(F.when(F.col("kind") == kind, more)), F.lit(0))


def used_without_owner(kind: str) -> Column:
    """Rows whose reference finds no owner, null references included."""
    lost = F.when(F.col("key").isNull() | (F.col("owned") == 0), F.col("used")).otherwise(F.lit(0))
    return F.coalesce(F.sum(F.when(F.col("kind") == kind, lost)), F.lit(0))


def rows_owned(kind: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("owned"))), F.lit(0))


def distinct_by_grain(rows: DataFrame, code: Column, keys: Sequence[str], grains: Sequence[str], distinct: str,
                      count: str) -> DataFrame:
    """Exact distinct codes and rows per grain: ``grains[i]`` counts by the first i of ``keys`` (the last one by all).

    Codes (whole numbers from 0) become bitmaps of 32,768 per (keys, bucket), built in each task; every coarser grain
    joins the finer one's bitmaps, so the rows are read and shuffled once and a grain's cost is its number of buckets.
    Null codes are no codes but their rows count.
    """
    base = rows.select(*keys, code.alias("__code"))
    finest = (base.withColumns({"__bucket": F.bitmap_bucket_number("__code"), "__bit": F.bitmap_bit_position("__code")})
              .groupBy(*keys, "__bucket").agg(F.bitmap_construct_agg("__bit").alias("__map"), F.count("*").alias("__rows")))
    out, now = [], finest
    for i in range(len(keys), -1, -1):
        own = list(keys[:i])
        if i < len(keys):
            now = now.groupBy(*own, "__bucket").agg(F.bitmap_or_agg("__map").alias("__map"), F.sum("__rows").alias("__rows"))
        seen = F.when(F.col("__bucket").isNotNull(), F.bitmap_count("__map"))
        one = now.groupBy(*own).agg(F.coalesce(F.sum(seen), F.lit(0)).alias(distinct), F.coalesce(F.sum("__rows"), F.lit(0)).alias(count))
        out.append(one.select(F.lit(grains[i]).alias("grain"), *[
            (F.col(k) if k in own else F.lit(None).cast(rows.schema[k].dataType)).alias(k) for k in keys], distinct, count))
    return reduce(DataFrame.unionByName, out)


# --- rule builders --------------------------------------------------------------

def duplicate_keys(*keys: str) -> Column:
    """Rows minus distinct keys (0 when the key is unique)."""
    return F.count("*") - F.countDistinct(*keys)


def count_where(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(True)))


def share_where(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False))) / F.count("*")
