"""Report queries: ranked, filtered pages over gold frames.

A ``limit`` here is the feature (a top-k page); every ordering ends with a
key so the page is deterministic. Spark plans ``orderBy().limit()`` as
TakeOrderedAndProject: a per-partition top-k, then one small merge.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgrid.functions.text import contains_ci, place_text_is_sane
from trustgrid.operators.joins import checked_join
from trustgrid.operators.lookup import MATCH_AMBIGUOUS
from trustgrid.operators.score import band, facility_point_reason, facility_point_score, round_half_up
from trustgrid.plans.gold import FACILITY_ROLLUP_CAUTION

DEFAULT_PIN = "#00000001"


def lowest_verdicts(verdicts: DataFrame, n: int = 8) -> DataFrame:
    return (verdicts.where(place_text_is_sane(F.col("source_state_name")))
            .orderBy(F.col("numeric_score").asc(), F.col("source_state_key").asc_nulls_last())
            .limit(n)
            .select("source_state_name", "source_state_key", "total_facilities", "valid_coordinate_facilities",
                    "numeric_score", "band", "binding_reason", "data_caution"))


def facility_scorecard(geo: DataFrame, verdicts: DataFrame, pinned: str | None = None,
                       n: int | None = 5000) -> DataFrame:
    """Per-facility score with its state's verdict. ``n`` rows make the page, pinned names first, then by name;
    without ``n`` all facilities, unordered: the frame that searches, simulations and joins work on.

    The verdict side is one row per state key, so the left join keeps the
    facility count.
    """
    c = _scorecard_columns(pinned)
    v = verdicts.select(*c["verdict"])
    f = geo.where(c["filter"])
    # verdicts are few, one per state key: counted, then broadcast, so that no facility moves
    j = checked_join(f, v, ["source_state_key"], ["_v_key"])
    j = j.withColumns(c["stage"])
    if n is not None:
        j = j.orderBy("_pin", "name", "unique_id").limit(n)
    return j.select(*c["output"])


@lru_cache(maxsize=16)
def _scorecard_columns(pinned: str | None) -> dict:
    raw = facility_point_score(F.col("has_valid_coordinates"), F.col("has_pincode"),
                               F.col("has_capability_text"), F.col("_v_score"))
    pin = (F.when(F.lower("name").contains(pinned.lower()), 0).otherwise(1) if pinned else F.lit(1))
    return {
        "verdict": (F.col("source_state_key").alias("_v_key"), F.col("numeric_score").alias("_v_score"),
                    F.col("data_caution").alias("_v_caution")),
        "filter": F.col("name").isNotNull() & place_text_is_sane(F.col("source_state_name")),
        "stage": {"_pin": pin, "_raw": raw},
        "output": ("unique_id", "name", "source_state_name", "source_state_key", "pincode", "latitude", "longitude",
                   "has_valid_coordinates", "has_pincode", "has_capability_text", "care_substance_missing_count",
                   round_half_up(F.least(F.lit(1.0), F.col("_raw")), 2).alias("numeric_score"),
                   band(F.col("_raw")).alias("band"),
                   facility_point_reason(F.col("has_valid_coordinates"), F.col("has_pincode"),
                                         F.col("has_capability_text")).alias("binding_reason"),
                   F.coalesce("_v_caution", F.lit(FACILITY_ROLLUP_CAUTION)).alias("data_caution")),
    }


def facility_search(scorecard: DataFrame, query: str) -> DataFrame:
    """Case-insensitive substring search over name, state and code."""
    return scorecard.where(contains_ci([F.col("name"), F.col("source_state_name"), F.col("pincode")], query))


def ambiguous_queue(enriched: DataFrame, n: int = 50) -> DataFrame:
    return (enriched.where(F.col("match_status") == MATCH_AMBIGUOUS)
            .orderBy(F.desc("district_count"), F.desc("state_count"), F.desc("post_office_count"), "pincode")
            .limit(n)
            .select("pincode", "post_office_count", "district_count", "state_count", "district_names",
                    "state_names", "match_status"))


def match_status_distribution(enriched: DataFrame) -> DataFrame:
    return (enriched.groupBy("match_status").agg(F.count("*").alias("pincode_count"))
            .orderBy(F.desc("pincode_count"), "match_status"))


NEED_PAGE_COLUMNS = ("state_name", "district_name", "state_key", "district_key", "demand_side_need_score",
                     "health_insurance_percent", "institutional_delivery_percent", "women_anaemia_percent",
                     "child_stunting_percent", "post_office_count", "missing_metric_count", "data_caution")


def top_need_districts(need: DataFrame, n: int = 25) -> DataFrame:
    return (need.orderBy(F.desc("demand_side_need_score"), "state_key", "district_key")
            .limit(n).select(*NEED_PAGE_COLUMNS))


def most_flagged_districts(need: DataFrame, n: int = 25) -> DataFrame:
    return (need.orderBy(F.desc("suppressed_indicator_count"), F.desc("low_sample_estimate_count"),
                         "state_key", "district_key")
            .limit(n)
            .select("state_name", "district_name", "state_key", "district_key", "suppressed_indicator_count",
                    "low_sample_estimate_count", "pincode_count", "post_office_count"))


def state_summary_page(summary: DataFrame, n: int = 8) -> DataFrame:
    return (summary.orderBy("state_name", "state_key").limit(n)
            .select("state_name", "anc_four_plus_rate_percent",
                    "institutional_delivery_to_live_birth_ratio_percent",
                    "fully_immunized_to_live_birth_ratio_percent", "data_caution"))


# Fix recommendations and their score lifts in points.
FIX_CATALOG = (
    ("Reconcile facility geography with source coordinates", 10),
    ("Assign district with boundary polygons", 7),
    ("Complete missing facility profile fields", 5),
)


def simulated_fixes(scorecard: DataFrame) -> DataFrame:
    """Before / after points and bands for every facility x recommended fix."""
    fixes = F.array(*[F.struct(F.lit(t).alias("fix_title"), F.lit(lift).alias("lift_points"))
                      for t, lift in FIX_CATALOG])
    rows = scorecard.select("unique_id", "numeric_score", F.inline(fixes))
    before = F.round(F.col("numeric_score") * 100).cast("int")
    staged = rows.withColumn("score_points_before", before).withColumn(
        "score_points_after",
        F.least(F.lit(100), F.greatest(F.lit(0), F.col("score_points_before") + F.col("lift_points"))))
    return staged.select("unique_id", "fix_title", "lift_points", "score_points_before",
                         band(F.col("score_points_before") / 100.0).alias("band_before"),
                         "score_points_after", band(F.col("score_points_after") / 100.0).alias("band_after"))
