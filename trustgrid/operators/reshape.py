"""Melt (wide -> long) and pivot (long -> wide) without data-dependent plans.

* ``melt`` is one generator over a single scan (``inline`` of an array of
  structs), not a union of one projection per column. (``unpivot`` plans the
  same single scan as an Expand, but Spark 4.1 fails to compile the generated
  code when subexpressions over Expand outputs are eliminated, and falls
  back to the interpreter; the generator stays in codegen.)
* ``melt_measures`` parses month / value type out of the headings on the
  driver (metadata only) and carries them as literals in each struct.
* ``pivot_fixed`` takes explicit values and builds ``max(when(...))`` columns
  in one aggregation: one shuffle, map-side partial aggregation, and a null
  column (not an analysis error) when a value never occurs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgrid.functions.schema import STAMP_COLUMNS, parse_measure_heading, quoted_col


def melt(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str] | None = None,
         var_name: str = "indicator", value_name: str = "raw_value") -> DataFrame:
    """Wide -> long. Values are cast to string first (unpivot needs one type);
    ingest stamp columns are never melted."""
    ids = list(id_cols)
    if value_cols is None:
        value_cols = [c for c in df.columns if c not in ids and c not in STAMP_COLUMNS]
    if not value_cols:
        raise ValueError("no value columns left to melt after id and stamp columns")
    return df.select(*[quoted_col(c) for c in ids], _melt_cells(tuple(value_cols), var_name, value_name))


@lru_cache(maxsize=256)
def _melt_cells(value_cols: tuple, var_name: str, value_name: str):
    """The generator for a column list (built once; it names columns only)."""
    return F.inline(F.array(*[F.struct(F.lit(c).alias(var_name), quoted_col(c).cast("string").alias(value_name))
                              for c in value_cols]))


def melt_measures(df: DataFrame, id_cols: Sequence[str],
                  parse: Callable[[str], tuple[str, str] | None] = parse_measure_heading,
                  keep: Callable[[str, str], bool] | None = None,
                  raw_name: str = "raw_value") -> DataFrame:
    """Melt only columns whose heading parses as (month, value type).

    ``keep(month, value_type)`` selects measures *before* melting, so a
    filter on month / value type costs one column instead of all of them.
    Output: ids, source_column, month, value_type, raw value.
    """
    parsed = {c: parse(c) for c in df.columns if c not in id_cols}
    measures = {c: mv for c, mv in parsed.items() if mv is not None and (keep is None or keep(*mv))}
    if not measures:
        raise ValueError("no parseable month / value-type measure columns")
    return df.select(*[quoted_col(c) for c in id_cols], _measure_cells(tuple(measures.items()), raw_name))


@lru_cache(maxsize=256)
def _measure_cells(measures: tuple, raw_name: str):
    return F.inline(F.array(*[
        F.struct(F.lit(c).alias("source_column"), F.lit(m).alias("month"), F.lit(v).alias("value_type"),
                 quoted_col(c).cast("string").alias(raw_name))
        for c, (m, v) in measures
    ]))


def pivot_fixed(df: DataFrame, keys: Sequence[str | Column], pivot_col: str | Column,
                values: Sequence[tuple[object, str]], value_col: str | Column,
                extra_aggs: Sequence[Column] = (), agg: Callable[[Column], Column] = F.max) -> DataFrame:
    """Long -> wide for a fixed list of ``(pivot value, output column)``.

    Duplicate cells resolve by ``agg`` (default ``max``: deterministic,
    unlike ``first``). ``extra_aggs`` ride along in the same aggregation.
    """
    pc = F.col(pivot_col) if isinstance(pivot_col, str) else pivot_col
    vc = F.col(value_col) if isinstance(value_col, str) else value_col
    cols = [agg(F.when(pc == F.lit(v), vc)).alias(name) for v, name in values]
    return df.groupBy(*keys).agg(*cols, *extra_aggs)


MAX_COLUMNS = 2000


def discover_values(df: DataFrame, column: str, most: int = MAX_COLUMNS) -> list:
    """The distinct non-null values of a pivot column, sorted: one pass over that column, pre-aggregated per task.

    At most ``most`` values reach the driver; more cannot become columns and are an error, never cut.
    """
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values: too many for columns")
    return sorted(found)


def union_all_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
