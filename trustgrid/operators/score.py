"""Scoring: bands, weakest-link caps and trust verdicts.

Rules (fixed values):
  * band cut-offs: green >= 0.85, amber >= 0.60, else red
  * a verdict band is the band of the weighted mean, capped by the band of
    the weakest dimension, then capped at amber when any dimension is
    missing or low-confidence (absent data can never give green)
  * binding dimension = lowest score, ties broken by dimension ordinal
  * a dimension that is only a weak signal can never make green on its own
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Band cut-offs.
GREEN_MIN = 0.85
AMBER_MIN = 0.60
BANDS = ("red", "amber", "green")  # ascending rank 0, 1, 2
REASON_SUFFIX = "binding trust constraint"


def round_half_up(col: Column, scale: int) -> Column:
    """Round a double half-up on its decimal value (10 significant places first).

    Going through DECIMAL(38,10) removes binary noise such as
    ``0.725 == 0.72499999999999997``, so every engine rounds the same way.
    A value too large for that type gives null instead of failing the job.
    """
    return F.round(col.try_cast("decimal(38,10)"), scale).cast("double")


def _cut(score: Column) -> Column:
    """The value a cut-off is compared with: the score at 10 decimals.

    A mean of aggregated sums can differ in its last binary digit with the
    order of summation (0.85 vs 0.8499999999999999); comparing at 10
    decimals makes the band independent of that order, on every engine.
    """
    return score.try_cast("decimal(38,10)")


def band(score: Column, green_min: float = GREEN_MIN, amber_min: float = AMBER_MIN) -> Column:
    """Cut-off band of a score column (pass a column reference, not a big expression)."""
    s = _cut(score)
    return (F.when(s >= F.lit(green_min).cast("decimal(38,10)"), F.lit("green"))
            .when(s >= F.lit(amber_min).cast("decimal(38,10)"), F.lit("amber"))
            .when(s.isNotNull(), F.lit("red")))


def score_rank(score: Column, green_min: float = GREEN_MIN, amber_min: float = AMBER_MIN) -> Column:
    """Band as a rank (red 0 < amber 1 < green 2), null for a null score."""
    s = _cut(score)
    return (F.when(s >= F.lit(green_min).cast("decimal(38,10)"), 2)
            .when(s >= F.lit(amber_min).cast("decimal(38,10)"), 1).when(s.isNotNull(), 0))


def band_rank(b: Column) -> Column:
    return F.when(b == "green", 2).when(b == "amber", 1).when(b == "red", 0)


def rank_band(r: Column) -> Column:
    return F.when(r == 2, F.lit("green")).when(r == 1, F.lit("amber")).when(r == 0, F.lit("red"))


def cap_band(current: Column, cap: Column) -> Column:
    """Band no stronger than ``cap``. Null in either input gives null (``least``
    would skip the null and silently lift the band)."""
    cr, kr = band_rank(current), band_rank(cap)
    return F.when(cr.isNotNull() & kr.isNotNull(), rank_band(F.least(cr, kr)))


def capped_rank(mean_rank: Column, weakest_rank: Column, amber_cap: Column) -> Column:
    """Weakest-link band rank: least of the mean's and the weakest dimension's
    ranks, and at most amber when ``amber_cap`` holds. Null stays null."""
    cap = F.when(amber_cap, F.lit(1)).otherwise(F.lit(2))
    return F.when(mean_rank.isNotNull() & weakest_rank.isNotNull(), F.least(mean_rank, weakest_rank, cap))


def reason_text(b: Column, dimension: Column) -> Column:
    return F.concat(F.initcap(b), F.lit(" - "), dimension, F.lit(f": {REASON_SUFFIX}"))


def _finish_stages(mean: str, weakest_score: str, weakest_name: str, amber_cap: str, score_scale: int) -> list:
    return [
        ("with", {"_r_mean": score_rank(F.col(mean)), "_r_weak": score_rank(F.col(weakest_score))}),
        ("with", {"_r_band": capped_rank(F.col("_r_mean"), F.col("_r_weak"), F.col(amber_cap))}),
        ("with", {"numeric_score": round_half_up(F.col(mean), score_scale),
                  "band_by_mean": rank_band(F.col("_r_mean")),
                  "weakest_score": round_half_up(F.col(weakest_score), score_scale),
                  "binding_dimension": F.col(weakest_name),
                  "band": rank_band(F.col("_r_band"))}),
        ("with", {"reason": reason_text(F.col("band"), F.col("binding_dimension"))}),
        ("drop", ("_r_mean", "_r_weak", "_r_band")),
    ]


def finish_verdict(df: DataFrame, mean: str, weakest_score: str, weakest_name: str, amber_cap: str,
                   score_scale: int = 4) -> DataFrame:
    """Add numeric_score, band_by_mean, weakest_score, binding_dimension, band
    and reason from staged columns (each computed once, then referenced)."""
    out = df
    for kind, stage in _finish_stages(mean, weakest_score, weakest_name, amber_cap, score_scale):
        out = out.withColumns(stage) if kind == "with" else out.drop(*stage)
    return out


@dataclass(frozen=True)
class Dimension:
    """A trust dimension read from columns of a wide frame."""

    name: str
    score: Column
    weight: float = 1.0
    low_confidence: Column | None = None
    weak_signal: bool = False


VERDICT_COLUMNS = ("numeric_score", "band_by_mean", "weakest_score", "binding_dimension", "any_low_confidence",
                   "band", "reason")


_VERDICT_STAGES: dict = {}


def with_verdict(df: DataFrame, dims: Sequence[Dimension], score_scale: int = 4,
                 cache_key: str | None = None) -> DataFrame:
    """Per-row trust verdict over dimension columns: no shuffle, no aggregation.

    Adds numeric_score, band_by_mean, weakest_score, binding_dimension,
    any_low_confidence, band, reason. A null dimension score counts as
    missing: score 0 and low confidence. A row with a score outside 0-1 gets
    no verdict (null columns), as in the long form. With ``cache_key`` (a name for a
    fixed dimension set) the expression stages are built once per process.
    """
    if not dims:
        raise ValueError("at least one dimension is required for a trust verdict")
    key = (cache_key, score_scale) if cache_key else None
    stages = _VERDICT_STAGES.get(key) if key else None
    if stages is None:
        stages = _verdict_stages(dims, score_scale)
        if key:
            _VERDICT_STAGES[key] = stages
    out = df
    for kind, stage in stages:
        out = out.withColumns(stage) if kind == "with" else out.drop(*stage)
    return out


def _verdict_stages(dims: Sequence[Dimension], score_scale: int) -> list:
    stages = [("with", {f"_d{i}": F.coalesce(d.score.cast("double"), F.lit(0.0)) for i, d in enumerate(dims)})]
    lows = [(F.coalesce(d.low_confidence, F.lit(False)) if d.low_confidence is not None else F.lit(False))
            | d.score.isNull() for d in dims]
    wsum = sum(d.weight for d in dims)
    mean = F.col("_d0") * F.lit(dims[0].weight)
    for i, d in enumerate(dims[1:], start=1):
        mean = mean + F.col(f"_d{i}") * F.lit(d.weight)
    mean = mean / F.lit(wsum)
    structs = [F.struct(F.col(f"_d{i}").alias("score"), F.lit(i).alias("ord"), F.lit(d.name).alias("name"))
               for i, d in enumerate(dims)]
    any_low = lows[0]
    for lo in lows[1:]:
        any_low = any_low | lo
    only_weak = all(d.weak_signal for d in dims)
    in_range = score_is_valid(F.col("_d0"))
    for i in range(1, len(dims)):
        in_range = in_range & score_is_valid(F.col(f"_d{i}"))
    weakest = F.least(*structs) if len(structs) > 1 else structs[0]
    stages.append(("with", {"_mean": F.when(in_range, mean), "_weakest": F.when(in_range, weakest),
                            "any_low_confidence": any_low}))
    stages.append(("with", {"_cap": F.col("any_low_confidence") | F.lit(only_weak)}))
    stages.append(("with", {"_ws": F.col("_weakest.score"), "_wn": F.col("_weakest.name")}))
    stages.extend(_finish_stages("_mean", "_ws", "_wn", "_cap", score_scale))
    stages.append(("drop", ("_mean", "_weakest", "_cap", "_ws", "_wn", *[f"_d{i}" for i in range(len(dims))])))
    return stages


def score_is_valid(score: Column) -> Column:
    return F.coalesce(score.between(0.0, 1.0), F.lit(False))


def trust_verdict_long(dims: DataFrame, entity_cols: Sequence[str], score_scale: int = 4) -> DataFrame:
    """Trust verdict over a long dimension table (one shuffle on the entity).

    Input columns: entity columns, ``dimension``, ``ordinal``, ``score``,
    ``weight`` (null -> 1.0), ``low_confidence`` (null -> false) and
    optional ``weak_signal``. Entities with any invalid score (null or
    outside 0-1) get no verdict; see :func:`score_rejects`.
    All aggregates are algebraic or ``min(struct)``, so a hot entity is
    pre-aggregated map-side and never materialised as a group.
    """
    weak = F.coalesce(F.col("weak_signal"), F.lit(False)) if "weak_signal" in dims.columns else F.lit(False)
    w = F.coalesce(F.col("weight").cast("double"), F.lit(1.0))
    valid = score_is_valid(F.col("score"))
    agg = dims.groupBy(*entity_cols).agg(
        F.sum(F.col("score") * w).alias("_sw"),
        F.sum(w).alias("_w"),
        F.min(F.struct(F.col("score").alias("score"), F.col("ordinal").alias("ord"),
                       F.col("dimension").alias("name"))).alias("_weakest"),
        F.bool_or(F.coalesce(F.col("low_confidence"), F.lit(False))).alias("any_low_confidence"),
        F.bool_and(weak).alias("_only_weak"),
        F.count("*").alias("dimension_count"),
        F.count_if(~valid).alias("_invalid"),
    ).where(F.col("_invalid") == 0)
    staged = agg.withColumns({
        "_mean": F.try_divide(F.col("_sw"), F.col("_w")),
        "_ws": F.col("_weakest.score"),
        "_wn": F.col("_weakest.name"),
        "_cap": F.col("any_low_confidence") | F.col("_only_weak"),
    })
    out = finish_verdict(staged, "_mean", "_ws", "_wn", "_cap", score_scale)
    return out.select(*entity_cols, "numeric_score", "band_by_mean", "weakest_score", "binding_dimension",
                      "any_low_confidence", "dimension_count", "band", "reason")


def score_rejects(dims: DataFrame, entity_cols: Sequence[str]) -> DataFrame:
    """Dimension rows that cannot be scored (null score or outside 0-1)."""
    return dims.where(~score_is_valid(F.col("score"))).select(
        *entity_cols, "dimension", "score",
        F.when(F.col("score").isNull(), F.lit("missing_score"))
        .otherwise(F.lit("score_out_of_range")).alias("reject_reason"),
    )


# --- facility and district scores -------------------------------------------

# Per-facility score weights.
FACILITY_WEIGHTS = {"coordinates": 0.45, "code": 0.20, "capability": 0.20, "state": 0.15}


def facility_point_score(has_coords: Column, has_code: Column, has_capability: Column,
                         state_score: Column) -> Column:
    """Unrounded, uncapped per-facility score."""
    w = FACILITY_WEIGHTS
    return (F.when(has_coords, w["coordinates"]).otherwise(0.0)
            + F.when(has_code, w["code"]).otherwise(0.0)
            + F.when(has_capability, w["capability"]).otherwise(0.0)
            + F.coalesce(state_score, F.lit(0.0)) * w["state"])


# Per-facility binding reasons, first failing flag wins.
FACILITY_REASONS = (
    "Location: missing or invalid facility coordinates constrain trust",
    "Location: missing PIN code constrains geography reconciliation",
    "Completeness: missing capability text constrains facility profiling",
    "Facility profile is usable, but district polygon assignment is still pending",
)


def facility_point_reason(has_coords: Column, has_code: Column, has_capability: Column) -> Column:
    r = FACILITY_REASONS
    return (F.when(~has_coords, F.lit(r[0])).when(~has_code, F.lit(r[1]))
            .when(~has_capability, F.lit(r[2])).otherwise(F.lit(r[3])))


def need_score(anaemia: Column, stunting: Column, insurance: Column, institutional: Column) -> Column:
    """Demand-side need: burden up, coverage down; a missing metric adds 0."""
    return (F.coalesce(anaemia, F.lit(0.0)) + F.coalesce(stunting, F.lit(0.0))
            + (100.0 - F.coalesce(insurance, F.lit(100.0)))
            + (100.0 - F.coalesce(institutional, F.lit(100.0))))
