"""Gold: verdicts, context and enrichment built from silver frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgrid.operators import lookup as lk
from trustgrid.operators.corroborate import THRESHOLDS, gap_band
from trustgrid.operators.joins import many_to_one_join, null_safe_join
from trustgrid.operators.score import capped_rank, need_score, rank_band, round_half_up, score_rank
from trustgrid.plans.silver import ADMIN_INDICATORS, NEED_METRICS, SURVEY_METRICS

# Caution labels and binding reasons.
FACILITY_ROLLUP_CAUTION = "state_rollup_before_district_polygon_assignment"
REASON_LOCATION = "Location: invalid or out-of-country coordinates constrain trust"
REASON_COMPLETENESS = "Completeness: sparse care-substance fields constrain trust"
CAUTION_FLAGGED = "review_suppressed_or_low_sample_indicators"
CAUTION_MISSING = "review_missing_indicators"
CAUTION_STANDARD = "standard"
ADMIN_CAUTION = "state_grain_admin_fallback_not_district_reconciliation"


def facility_verdicts(geo: DataFrame, scale: int = 6) -> DataFrame:
    """Facility trust rolled up per normalised state key (one shuffle).

    Spellings of the same state are one group. Facilities are counted per
    (state, spelling) first, so no set of raw names is gathered: the
    smallest ``lookup.NAMES`` spellings are listed, ``|``-joined, beside their
    exact number, and the first stands for all.
    ``band_by_mean`` is the cut-off of the mean score; ``band`` is capped by
    the weaker of the two dimensions and at amber while any facility lacks a
    care-substance field, a code, capability text or valid coordinates (missing
    data can never give green).
    """
    return verdicts_of_spellings(state_spellings(geo), scale)


def verdicts_of_spellings(spelled: DataFrame, scale: int = 6) -> DataFrame:
    """Verdicts from the counts per (state, spelling); the second half of ``facility_verdicts``."""
    listed = lk.smallest_values(spelled.select("source_state_key", F.lit("names").alias("kind"), F.col("source_state_name").alias("value")),
                                ["source_state_key"], {"names": "_spellings"})
    staged = null_safe_join(spelled.groupBy("source_state_key").agg(*_verdict_aggs()), listed, ["source_state_key"]) \
        .withColumn("source_state_spellings", F.coalesce("_spellings", F.lit("")))
    for stage in _verdict_stages():
        staged = staged.withColumns(stage)
    return staged.select(*_verdict_output(scale))


_COUNTED = ("total_facilities", "valid_coordinate_facilities", "pincode_present_facilities", "capability_text_facilities")


def state_spellings(geo: DataFrame) -> DataFrame:
    """Facilities and their flags per state key and raw spelling, every spelling kept."""
    return geo.groupBy("source_state_key", "source_state_name").agg(
        F.count("*").alias("total_facilities"),
        F.count_if("has_valid_coordinates").alias("valid_coordinate_facilities"),
        F.count_if("has_pincode").alias("pincode_present_facilities"),
        F.count_if("has_capability_text").alias("capability_text_facilities"),
        F.sum("care_substance_missing_count").alias("care_substance_missing_count"))


@lru_cache(maxsize=None)
def _verdict_aggs() -> tuple:
    return (
        F.min("source_state_name").alias("source_state_name"),
        F.count("source_state_name").alias("source_state_spelling_count"),
        *[F.sum(c).alias(c) for c in _COUNTED],
        F.sum("care_substance_missing_count").alias("_missing_sum"),
    )


@lru_cache(maxsize=None)
def _verdict_stages() -> tuple:
    """Intermediates, each computed once and referenced by name in the next
    stage (expression lists are built once per process)."""
    total = F.col("total_facilities")
    return (
        {"_avg_missing": F.col("_missing_sum") / total},
        {"_location": F.col("valid_coordinate_facilities") / total,
         "_completeness": (F.col("pincode_present_facilities") / total + F.col("capability_text_facilities") / total
                           + (4.0 - F.col("_avg_missing")) / 4.0) / 3.0},
        {"_mean": (F.col("_location") + F.col("_completeness")) / 2.0},
        {"_r_mean": score_rank(F.col("_mean")), "_r_weak": score_rank(F.least("_location", "_completeness"))},
        {"_r_band": capped_rank(F.col("_r_mean"), F.col("_r_weak"), (F.col("_avg_missing") > 0)
                                | (F.least("valid_coordinate_facilities", "pincode_present_facilities",
                                           "capability_text_facilities") < total))},
    )


@lru_cache(maxsize=None)
def _verdict_output(scale: int) -> tuple:
    return (
        "source_state_key", "source_state_name", "source_state_spellings", "source_state_spelling_count", "total_facilities",
        "valid_coordinate_facilities", "pincode_present_facilities", "capability_text_facilities",
        round_half_up(F.col("_avg_missing"), scale).alias("avg_care_substance_missing_count"),
        round_half_up(F.col("_location"), scale).alias("location_trust_score"),
        round_half_up(F.col("_completeness"), scale).alias("data_completeness_score"),
        round_half_up(F.col("_mean"), scale).alias("numeric_score"),
        rank_band(F.col("_r_mean")).alias("band_by_mean"),
        rank_band(F.col("_r_band")).alias("band"),
        F.when(F.col("_location") <= F.col("_completeness"), F.lit(REASON_LOCATION))
        .otherwise(F.lit(REASON_COMPLETENESS)).alias("binding_reason"),
        F.lit("state").alias("geo_grain"),
        F.lit(FACILITY_ROLLUP_CAUTION).alias("data_caution"),
    )


def district_context(districts: DataFrame, postal: DataFrame) -> DataFrame:
    """Survey districts LEFT JOIN postal summary (both unique on the keys)."""
    joined = districts.join(postal, ["state_key", "district_key"], "left")
    return joined.withColumns(_context_defaults())


@lru_cache(maxsize=None)
def _context_defaults() -> dict:
    return {c: F.coalesce(c, F.lit(0)) for c in ("pincode_count", "post_office_count", "geocoded_post_office_count")}


def need_ranking(context: DataFrame, scale: int = 6) -> DataFrame:
    """Demand-side need per district, with missing metrics counted and flagged."""
    return context.select(*_need_columns(scale))


@lru_cache(maxsize=None)
def _need_columns(scale: int) -> tuple:
    # a cell too large for a decimal is no percentage: it counts as missing
    m = {k: F.when(F.abs(F.col(k)) < 1e28, F.col(k)) for k in SURVEY_METRICS}
    missing = sum((F.when(m[k].isNull(), 1).otherwise(0) for k in NEED_METRICS), F.lit(0))
    flagged = (F.col("suppressed_indicator_count") > 0) | (F.col("low_sample_estimate_count") > 0)
    return (
        "state_key", "district_key", "state_name", "district_name",
        "pincode_count", "post_office_count",
        round_half_up(F.col("geocoded_post_office_ratio"), scale).alias("geocoded_post_office_ratio"),
        "suppressed_indicator_count", "low_sample_estimate_count",
        *[round_half_up(m[k], scale).alias(k) for k in NEED_METRICS],
        round_half_up(need_score(m["women_anaemia_percent"], m["child_stunting_percent"],
                                 m["health_insurance_percent"], m["institutional_delivery_percent"]), scale)
        .alias("demand_side_need_score"),
        missing.alias("missing_metric_count"),
        F.when(flagged, F.lit(CAUTION_FLAGGED)).when(missing > 0, F.lit(CAUTION_MISSING))
        .otherwise(F.lit(CAUTION_STANDARD)).alias("data_caution"),
    )


def code_enrichment(lookup: DataFrame, districts: DataFrame) -> DataFrame:
    """Join-safe code lookup enriched with all of the survey's district columns: metrics, flag counts, every indicator."""
    return lk.enrich_codes(lookup, districts, prefix="survey_")


def state_summary(totals: DataFrame, scale: int = 6) -> DataFrame:
    """Curated admin indicators per state with guarded ratios and their formulas."""
    ind = {v: F.max(F.when(F.col("indicator_name") == v, F.col("value"))).alias(v)
           for v in ADMIN_INDICATORS.values()}
    wide = totals.groupBy("state_key").agg(F.min("state_name").alias("state_name"), *ind.values())
    births = F.coalesce("live_birth_male", F.lit(0)) + F.coalesce("live_birth_female", F.lit(0))
    immunised = F.coalesce("fully_immunized_male", F.lit(0)) + F.coalesce("fully_immunized_female", F.lit(0))
    return wide.select(
        "state_key", "state_name", *ADMIN_INDICATORS.values(),
        births.alias("live_births"), immunised.alias("fully_immunized_children"),
        round_half_up(F.when(F.col("anc_registered") > 0, F.col("anc_four_plus") / F.col("anc_registered") * 100.0),
                      scale).alias("anc_four_plus_rate_percent"),
        round_half_up(F.when(births > 0, F.col("institutional_deliveries") / births * 100.0), scale)
        .alias("institutional_delivery_to_live_birth_ratio_percent"),
        round_half_up(F.when(births > 0, immunised / births * 100.0), scale)
        .alias("fully_immunized_to_live_birth_ratio_percent"),
        F.lit("anc_four_plus / anc_registered * 100").alias("anc_four_plus_rate_formula"),
        F.lit("institutional_deliveries / (live_birth_male + live_birth_female) * 100")
        .alias("institutional_delivery_ratio_formula"),
        F.lit("(fully_immunized_male + fully_immunized_female) / (live_birth_male + live_birth_female) * 100")
        .alias("fully_immunized_ratio_formula"),
        F.lit("state").alias("geo_grain"),
        F.lit(ADMIN_CAUTION).alias("data_caution"),
    )


# --- district verdicts over unioned dimension tables --------------------------------

def district_dimensions(districts: DataFrame, postal: DataFrame) -> DataFrame:
    """Long (district, dimension) rows, one generator pass over the districts.

    completeness   share of indicator cells with a value; blanks cap at amber
    suppression    share of cells neither suppressed nor low-sample; any flag caps at amber
    postal_geocoding  geocoded share of the district's post offices (weight 0.5);
                   no offices = missing evidence
    The three dimension tables of the specification are emitted together by
    ``inline`` after one lookup join (both sides unique on the district key),
    so the district aggregate is computed once.
    """
    keys = ["state_key", "district_key"]
    j = districts.join(postal.select(*keys, "geocoded_post_office_ratio"), keys, "left")
    return j.select(*keys, _district_dimension_cells())


@lru_cache(maxsize=None)
def _district_dimension_cells():
    cells = F.col("indicator_cell_count")
    flagged = F.col("suppressed_indicator_count") + F.col("low_sample_estimate_count")
    ratio = F.col("geocoded_post_office_ratio")

    def dim(name, ordinal, score, weight, low, missing):
        return F.struct(F.lit(name).alias("dimension"), F.lit(ordinal).alias("ordinal"),
                        F.coalesce(score, F.lit(0.0)).alias("score"), F.lit(weight).alias("weight"),
                        F.coalesce(low, F.lit(False)).alias("low_confidence"), missing.alias("is_missing"),
                        F.lit(False).alias("weak_signal"))

    return F.inline(F.array(
        dim("completeness", 0, 1.0 - F.col("missing_value_count") / cells, 1.0, F.col("missing_value_count") > 0,
            F.lit(False)),
        dim("suppression", 1, 1.0 - flagged / cells, 1.0, flagged > 0, F.lit(False)),
        dim("postal_geocoding", 2, ratio, 0.5, ratio.isNull(), ratio.isNull()),
    ))


# --- district evidence of several grains ---------------------------------------------------

# How far the sources of an indicator can be compared, and what evidence of a coarser grain is worth.
RECONCILABILITY = {"institutional_delivery": 1.0}
PROXY_GRAIN_SCORE = 0.6
PROXY_WEIGHT = 0.5


def need_cells(cells: DataFrame) -> DataFrame:
    """Per district: cells of the need metrics, how many lack a value, how many are suppressed or of a low sample, and
    the institutional delivery figure."""
    names = [n for m in NEED_METRICS for n in SURVEY_METRICS[m]]
    flagged = F.col("is_suppressed") | F.col("is_low_sample_estimate")
    return cells.where(F.col("indicator").isin(*names)).groupBy("state_key", "district_key").agg(
        F.count("*").alias("cells"), F.count_if(F.col("value").isNull()).alias("missing"), F.count_if(flagged).alias("flagged"),
        F.max(F.when(F.col("indicator").isin(*SURVEY_METRICS["institutional_delivery_percent"]), F.col("value"))).alias("survey_percent"))


def down_the_hierarchy(districts: DataFrame, evidence: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Districts with the evidence of their own grain, else their state's as a flagged proxy, else none.

    ``evidence`` has one row per district with additive columns ``sums``. State rows are sums of district rows, so both
    grains come from one read; the proxies are joined by state, where a state with a third of all districts is split.
    Adds the columns of ``sums`` and ``evidence_grain`` (district, state, none).
    """
    state = evidence.groupBy("state_key").agg(*[F.sum(c).alias(f"_state_{c}") for c in sums]) \
        .withColumnRenamed("state_key", "_state")
    own = null_safe_join(districts, evidence.select("state_key", "district_key", *[F.col(c).alias(f"_own_{c}") for c in sums]),
                         ["state_key", "district_key"])
    both = many_to_one_join(own, state, ["state_key"], ["_state"])
    has, proxy = F.col(f"_own_{sums[0]}").isNotNull(), F.col(f"_state_{sums[0]}").isNotNull()
    return both.select(*districts.columns, *[F.coalesce(f"_own_{c}", f"_state_{c}").alias(c) for c in sums],
                       F.when(has, F.lit("district")).when(proxy, F.lit("state")).otherwise(F.lit("none")).alias("evidence_grain"))


def district_evidence(cells: DataFrame, reports: DataFrame) -> DataFrame:
    """Six dimensions per district, long, in one generator pass over the joined evidence.

    completeness, suppression   of the need metrics' cells
    geocoding                   located share of the reports
    corroboration               survey against reports, by the gap bands of institutional delivery
    reconcilability             how far these sources can be compared
    grain                       whether the reports are the district's own
    Reports of the state stand in for a district without any: weight ``PROXY_WEIGHT``, low confidence, a weak signal. No
    reports at all are missing evidence with score 0.
    """
    named = need_cells(cells)
    joined = down_the_hierarchy(named, reports.withColumn("_percent_sum", F.col("delivery_percent") * F.col("reports")),
                                ["reports", "located", "_percent_sum"])
    return joined.select("state_key", "district_key", "evidence_grain", _evidence_cells())


@lru_cache(maxsize=None)
def _evidence_cells():
    _, green, red = next(t for t in THRESHOLDS if t[0] == "institutional_delivery")
    proxy = F.col("evidence_grain") != "district"
    gap = F.abs(F.col("survey_percent") - F.try_divide(F.col("_percent_sum"), F.col("reports")))
    share = F.try_divide(F.col("located"), F.col("reports"))
    grain = F.when(F.col("evidence_grain") == "district", 1.0).when(F.col("evidence_grain") == "state", PROXY_GRAIN_SCORE)
    weight = F.when(proxy, PROXY_WEIGHT).otherwise(1.0)
    comparable = F.lit(RECONCILABILITY["institutional_delivery"]) * grain

    def dim(ordinal, name, score, weight, low, weak):
        return F.struct(F.lit(name).alias("dimension"), F.lit(ordinal).alias("ordinal"), F.coalesce(score, F.lit(0.0)).alias("score"),
                        weight.alias("weight"), F.coalesce(low, F.lit(True)).alias("low_confidence"), score.isNull().alias("is_missing"),
                        weak.alias("weak_signal"))

    no, one, half = F.lit(False), F.lit(1.0), F.lit(0.5)
    return F.inline(F.array(
        dim(0, "completeness", 1.0 - F.col("missing") / F.col("cells"), one, F.col("missing") > 0, no),
        dim(1, "suppression", 1.0 - F.col("flagged") / F.col("cells"), one, F.col("flagged") > 0, no),
        dim(2, "geocoding", share, half, proxy, proxy),
        dim(3, "corroboration", F.when(gap.isNotNull(), F.greatest(F.lit(0.0), 1.0 - gap / (2.0 * red))), weight, proxy | (gap_band(gap, F.lit(green), F.lit(red)) != "green"), proxy),
        dim(4, "reconcilability", comparable, half, proxy, no),
        dim(5, "grain", grain, half, proxy, no),
    ))


def district_impact(need: DataFrame) -> DataFrame:
    """Impact = burden x population per district.

    Burden is the district's need score; when none of its need metrics is
    available, the mean need of the state's districts that have metrics
    stands in, flagged as a weak proxy (the district is never dropped).
    Population is the post-office count (+1 so an unserved district counts).
    """
    have = F.col("missing_metric_count") < len(NEED_METRICS)
    state = need.where(have).groupBy("state_key").agg(F.avg("demand_side_need_score").alias("_state_burden"))
    j = null_safe_join(need.select("state_key", "district_key", "demand_side_need_score", "missing_metric_count",
                                   "post_office_count"), state, ["state_key"])
    burden = F.when(have, F.col("demand_side_need_score")).otherwise(F.col("_state_burden"))
    return j.select(
        "state_key", "district_key",
        (~have).alias("burden_is_state_proxy"),
        (F.coalesce(burden, F.lit(0.0)) * (F.col("post_office_count") + 1)).alias("impact"),
    )
