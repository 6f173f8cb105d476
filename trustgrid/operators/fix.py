"""Fix ranking and before / after re-scoring.

rank score = score lift if fixed x impact (burden x population), with a
boost for *missing* evidence on high-weight dimensions (missing data is the
first thing to acquire). ``rank_fixes`` ranks per entity: the window
partitions by the entity key. ``rank_overall`` ranks the fixes of all entities
in one list, so that the repairs that matter most come first wherever they
are: places come from range partitions (``operators.ranking``), so no global
sort in one task and no single-task window at any scale.

``before_after`` applies each entity's top fix (score -> 1, confidence
restored) and re-scores both versions inside ONE aggregation on the entity
key, reusing the window's partitioning.

Both follow the verdict: an entity with any score that cannot be scored (null
or outside 0-1) has no verdict, so it gets no fixes and no re-scoring either
(its rows are in ``score_rejects``), and an entity with weak signals only
stays at amber.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgrid.operators.ranking import places
from trustgrid.operators.score import capped_rank, rank_band, reason_text, round_half_up, score_is_valid, score_rank

# Fixed values.
MISSING_BOOST = 1.5
HIGH_WEIGHT_MIN = 1.0


def rank_fixes(dims: DataFrame, entity_cols: Sequence[str], impact: Column, scale: int = 6,
               extra_cols: Sequence[str] = ()) -> DataFrame:
    """Candidate fixes = dimensions scoring below 1, ranked per entity.

    ``dims`` columns: entity, dimension, ordinal, score, weight,
    low_confidence, is_missing. ``impact`` is an expression over ``dims``;
    ``extra_cols`` are carried through unchanged.
    """
    w_entity = Window.partitionBy(*entity_cols)
    weight = F.coalesce(F.col("weight"), F.lit(1.0))
    lift = F.try_divide((1.0 - F.col("score")) * weight, F.sum(weight).over(w_entity))
    boost = F.when(F.col("is_missing") & (weight >= HIGH_WEIGHT_MIN), F.lit(MISSING_BOOST)).otherwise(F.lit(1.0))
    invalid = F.count_if(~score_is_valid(F.col("score"))).over(w_entity)
    ranked = (dims.withColumns({"_invalid": invalid, "score_lift": lift})
              .where(F.col("_invalid") == 0)
              .withColumn("impact", impact.cast("double"))
              .withColumn("priority", F.col("score_lift") * F.col("impact") * boost)
              .where(F.col("score") < 1.0))
    order = Window.partitionBy(*entity_cols).orderBy(F.desc("priority"), F.asc("ordinal"))
    return ranked.select(
        *entity_cols, *extra_cols, "dimension", "ordinal",
        round_half_up(F.col("score"), scale).alias("score"), weight.alias("weight"), "is_missing",
        round_half_up(F.col("score_lift"), scale).alias("score_lift"),
        round_half_up(F.col("impact"), scale).alias("impact"),
        round_half_up(F.col("priority"), scale).alias("priority"),
        F.row_number().over(order).alias("fix_rank"),
    )


def rank_overall(fixes: DataFrame, entity_cols: Sequence[str], rank: str = "rank_overall") -> DataFrame:
    """The fixes of ``rank_fixes`` with their place, from 1, in the list of all entities.

    Ordered by priority (a fix without one comes last), then by entity (null keys first) and ordinal, so ties have a
    defined order; no row is dropped.
    """
    order = [F.desc_nulls_last("priority"), *[F.asc_nulls_first(c) for c in entity_cols], F.asc("ordinal")]
    placed = places(fixes, order, pos=rank, size=None)
    return placed.withColumn(rank, F.col(rank) + 1)


def before_after(dims: DataFrame, entity_cols: Sequence[str], impact: Column, scale: int = 4) -> DataFrame:
    """Verdict before and after applying each entity's rank-1 fix."""
    w_entity = Window.partitionBy(*entity_cols)
    weight = F.coalesce(F.col("weight"), F.lit(1.0))
    lift = F.try_divide((1.0 - F.col("score")) * weight, F.sum(weight).over(w_entity))
    boost = F.when(F.col("is_missing") & (weight >= HIGH_WEIGHT_MIN), F.lit(MISSING_BOOST)).otherwise(F.lit(1.0))
    prio = F.when(F.col("score") < 1.0, lift * impact.cast("double") * boost)
    order = Window.partitionBy(*entity_cols).orderBy(F.desc_nulls_last("_prio"), F.asc("ordinal"))
    weak = F.coalesce(F.col("weak_signal"), F.lit(False)) if "weak_signal" in dims.columns else F.lit(False)
    staged = (dims.withColumn("_prio", prio)
              .withColumn("_is_fix", (F.row_number().over(order) == 1) & F.col("_prio").isNotNull()))
    low = F.coalesce(F.col("low_confidence"), F.lit(False))
    fixed_score = F.when(F.col("_is_fix"), F.lit(1.0)).otherwise(F.col("score"))
    fixed_low = F.when(F.col("_is_fix"), F.lit(False)).otherwise(low)
    agg = staged.groupBy(*entity_cols).agg(
        F.sum(F.col("score") * weight).alias("_sw0"), F.sum(fixed_score * weight).alias("_sw1"),
        F.sum(weight).alias("_w"),
        F.min(F.struct(F.col("score").alias("score"), F.col("ordinal").alias("ord"),
                       F.col("dimension").alias("name"))).alias("_k0"),
        F.min(F.struct(fixed_score.alias("score"), F.col("ordinal").alias("ord"),
                       F.col("dimension").alias("name"))).alias("_k1"),
        F.bool_or(low).alias("_low0"), F.bool_or(fixed_low).alias("_low1"), F.bool_and(weak).alias("_only_weak"),
        F.count_if(~score_is_valid(F.col("score"))).alias("_invalid"),
        F.max(F.when(F.col("_is_fix"), F.col("dimension"))).alias("fixed_dimension"),
    ).where(F.col("_invalid") == 0)
    staged = agg.withColumns({"_m0": F.try_divide("_sw0", "_w"), "_m1": F.try_divide("_sw1", "_w"),
                              "_l0": F.col("_low0") | F.col("_only_weak"), "_l1": F.col("_low1") | F.col("_only_weak")})
    staged = staged.withColumns({
        "_b0": rank_band(capped_rank(score_rank(F.col("_m0")), score_rank(F.col("_k0.score")), F.col("_l0"))),
        "_b1": rank_band(capped_rank(score_rank(F.col("_m1")), score_rank(F.col("_k1.score")), F.col("_l1"))),
    })
    return staged.select(
        *entity_cols, "fixed_dimension",
        round_half_up(F.col("_m0"), scale).alias("score_before"), F.col("_b0").alias("band_before"),
        F.col("_k0.name").alias("binding_before"),
        round_half_up(F.col("_m1"), scale).alias("score_after"), F.col("_b1").alias("band_after"),
        reason_text(F.col("_b1"), F.col("_k1.name")).alias("reason_after"),
        round_half_up(F.col("_m1") - F.col("_m0"), scale).alias("score_delta"),
    )
