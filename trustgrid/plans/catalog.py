"""Query catalog: name -> Spark builder (spark, sf_dir) -> DataFrame, plus
the DuckDB oracle SQL for the same result.

Builders compose silver / gold / report functions over the fixture views and
the input tables. None of them runs an action.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgrid.plans import gold, reports, silver
from trustgrid.plans import sqlkit as q
from trustgrid.operators import lookup as lk
from trustgrid.sources import fixtures as fx


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    covers: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None, covers: tuple[str, ...] = ()):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, oracle, covers)
        return fn
    return deco


def _with(body: str, **ctes: str) -> str:
    """Oracle text: fixture views, then named CTEs in order, then the body."""
    parts = [f"{n} AS ({sql})" for n, sql in fx.VIEWS.items()]
    parts += [f"{n} AS ({sql})" for n, sql in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


# --- shared Spark steps -------------------------------------------------------

def facility_geo_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.facility_geo(fx.view(spark, sf_dir, "v_facilities"))


def facility_verdicts_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.facility_verdicts(facility_geo_df(spark, sf_dir))


def offices_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.offices_silver(fx.view(spark, sf_dir, "v_offices"))


def lookup_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = offices_df(spark, sf_dir)
    return lk.join_safe_lookup(o, "pincode", "district_key", "state_key", "district_name", "state_name",
                               "has_coordinates")


def survey_cells_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.survey_cells(silver.survey_landed(spark, sf_dir))


def survey_districts_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = silver.survey_landed(spark, sf_dir)
    return silver.survey_districts(silver.survey_cells(landed), silver.survey_indicators(landed))


def need_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = gold.district_context(survey_districts_df(spark, sf_dir), silver.postal_summary(offices_df(spark, sf_dir)))
    return gold.need_ranking(ctx)


def code_enrichment_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.code_enrichment(lookup_df(spark, sf_dir), survey_districts_df(spark, sf_dir))


def admin_wide_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.admin_landed(spark, sf_dir)


def state_summary_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.state_summary(silver.admin_totals(admin_wide_df(spark, sf_dir)))


# --- oracle CTE chains ----------------------------------------------------------

O_FAC = {"facility_geo": q.FACILITY_GEO}
O_VERDICTS = {**O_FAC, "facility_verdicts": q.FACILITY_VERDICTS}
O_OFFICES = {"offices": q.OFFICES}
O_LOOKUP = {**O_OFFICES, "lookup": q.LOOKUP}
O_SURVEY = {"survey_cells": q.SURVEY_CELLS, "survey_districts": q.SURVEY_DISTRICTS}
O_NEED = {**O_OFFICES, **O_SURVEY, "postal": q.POSTAL, "need": q.NEED}
O_ENRICH = {**O_LOOKUP, **O_SURVEY, "enrich": q.ENRICH}
O_ADMIN = {"admin_long": q.ADMIN_LONG}
O_STATE = {**O_ADMIN, "admin_totals": q.ADMIN_TOTALS, "state_summary": q.STATE_SUMMARY}


# --- facility family --------------------------------------------------------------

@register("facility_geo", _with("SELECT * FROM facility_geo", **O_FAC),
          ("PRJ-9", "PRJ-11", "SC-1", "SC-3", "SC-5", "SC-14", "SC-15", "SC-16"))
def _facility_geo(spark, sf_dir):
    return facility_geo_df(spark, sf_dir)


@register("facility_verdicts", _with("SELECT * FROM facility_verdicts", **O_VERDICTS),
          ("SCR-4", "AGG-4", "SC-18", "SC-23", "SC-24", "SCR-2", "T8", "T11"))
def _facility_verdicts(spark, sf_dir):
    return facility_verdicts_df(spark, sf_dir)


@register("lowest_verdicts", _with(q.LOWEST_VERDICTS, **O_VERDICTS), ("QRY-6", "FLT-4", "SC-27", "TOP-4"))
def _lowest_verdicts(spark, sf_dir):
    return reports.lowest_verdicts(facility_verdicts_df(spark, sf_dir))


@register("facility_scorecard", _with(q.SCORECARD, **O_VERDICTS),
          ("QRY-7", "JN-4", "SC-25", "SC-26", "SC-27", "TOP-6"))
def _facility_scorecard(spark, sf_dir):
    geo = facility_geo_df(spark, sf_dir)
    return reports.facility_scorecard(geo, gold.facility_verdicts(geo), pinned=reports.DEFAULT_PIN)


# --- postal lookup family ------------------------------------------------------------

@register("offices_silver", _with("SELECT * FROM offices", **O_OFFICES),
          ("PRJ-2", "SC-2", "SC-4", "SC-5", "SC-15", "T1", "T2", "T7"))
def _offices(spark, sf_dir):
    return offices_df(spark, sf_dir)


@register("join_safe_lookup", _with("SELECT * FROM lookup", **O_LOOKUP), ("AGG-1", "SC-17", "SET-2", "AGG-6"))
def _lookup(spark, sf_dir):
    return lookup_df(spark, sf_dir)


@register("ambiguous_queue", _with(q.AMBIGUOUS_QUEUE, **O_ENRICH), ("QRY-2", "FLT-3", "TOP-2"))
def _ambiguous(spark, sf_dir):
    return reports.ambiguous_queue(code_enrichment_df(spark, sf_dir))


@register("match_status_distribution", _with(q.MATCH_DISTRIBUTION, **O_ENRICH), ("QRY-3", "AGG-5"))
def _match_dist(spark, sf_dir):
    return reports.match_status_distribution(code_enrichment_df(spark, sf_dir))


@register("code_enrichment", _with("SELECT * FROM enrich", **O_ENRICH),
          ("SCR-7", "JN-3", "SC-22", "PRJ-8", "PRJ-10"))
def _enrich(spark, sf_dir):
    return code_enrichment_df(spark, sf_dir)


@register("unmatched_codes", _with(q.UNMATCHED, **O_ENRICH), ("JN-3 anti",))
def _unmatched(spark, sf_dir):
    return lk.unmatched_codes(lookup_df(spark, sf_dir), survey_districts_df(spark, sf_dir))


# --- survey family ------------------------------------------------------------------

@register("survey_cells_parsed", _with("SELECT * FROM survey_cells", **O_SURVEY),
          ("RSH-1", "SET-1", "SC-6", "SC-7", "SC-8", "PRJ-1", "PRJ-2", "PRJ-3", "T3", "T14"))
def _survey_cells(spark, sf_dir):
    return survey_cells_df(spark, sf_dir)


@register("survey_districts", _with("SELECT * FROM survey_districts", **O_SURVEY),
          ("RSH-3", "AGG-2", "AGG-8", "JN-1", "T9", "T13"))
def _survey_districts(spark, sf_dir):
    return survey_districts_df(spark, sf_dir)


@register("postal_summary", _with("SELECT * FROM postal", **O_NEED), ("AGG-3",))
def _postal(spark, sf_dir):
    return silver.postal_summary(offices_df(spark, sf_dir))


@register("need_ranking", _with("SELECT * FROM need", **O_NEED), ("SCR-6", "JN-2", "SC-19", "SC-20", "SC-21", "T12"))
def _need(spark, sf_dir):
    return need_df(spark, sf_dir)


@register("top_need_districts", _with(q.TOP_NEED, **O_NEED), ("QRY-1", "TOP-1"))
def _top_need(spark, sf_dir):
    return reports.top_need_districts(need_df(spark, sf_dir))


@register("most_flagged_districts", _with(q.MOST_FLAGGED, **O_NEED), ("QRY-4", "TOP-3"))
def _most_flagged(spark, sf_dir):
    return reports.most_flagged_districts(need_df(spark, sf_dir))


# --- admin family ----------------------------------------------------------------------

@register("admin_long", _with("SELECT * FROM admin_long", **O_ADMIN),
          ("RSH-2", "SC-9", "SC-10", "SC-11", "SC-12", "PRJ-4", "PRJ-5", "T5", "T15"))
def _admin_long(spark, sf_dir):
    return silver.admin_long(admin_wide_df(spark, sf_dir))


@register("admin_totals", _with("SELECT * FROM admin_totals", **O_STATE), ("SC-13", "FLT-1"))
def _admin_totals(spark, sf_dir):
    return silver.admin_totals(admin_wide_df(spark, sf_dir))


@register("state_summary", _with("SELECT * FROM state_summary", **O_STATE), ("SCR-5", "RSH-4", "SP-10", "T16"))
def _state_summary(spark, sf_dir):
    return state_summary_df(spark, sf_dir)


@register("state_summary_page", _with(q.STATE_PAGE, **O_STATE), ("QRY-5", "TOP-5"))
def _state_page(spark, sf_dir):
    return reports.state_summary_page(state_summary_df(spark, sf_dir))


# --- large tables: customers, nations, documents, contracts ------------------------------

from trustgrid.operators import fix, geo, predict  # noqa: E402
from trustgrid.operators import provenance as pv  # noqa: E402
from trustgrid.operators.corroborate import corroboration_bands  # noqa: E402
from trustgrid.operators.score import round_half_up, score_rejects, trust_verdict_long  # noqa: E402
from trustgrid.plans import entities as ent  # noqa: E402
from trustgrid.plans import sqlkit_large as ql  # noqa: E402
from trustgrid.sources.io import row_count_summary  # noqa: E402
from trustgrid.sources.tables import TABLES, read_table  # noqa: E402

O_CUST = {"cust_dims": ql.CUST_DIMS, "cust_long": ql.cust_long(), "cust_long_raw": ql.cust_long(False, False)}


@register("customer_trust_verdict", _with(ql.CUST_VERDICTS, **O_CUST),
          ("SCR-1", "SCR-2", "SC-23", "SC-24", "SP-13", "T4", "T11"))
def _cust_verdict(spark, sf_dir):
    return ent.customer_verdicts(spark, sf_dir)


@register("customer_dimensions", _with("SELECT * FROM cust_long", **O_CUST), ("SP-9 input", "RSH-1"))
def _cust_dims(spark, sf_dir):
    return ent.customer_dimensions_long(spark, sf_dir)


@register("trust_verdict_long", _with(ql.CUST_LONG_VERDICT, **O_CUST), ("SCR-1", "SCR-2", "SP-4"))
def _cust_long_verdict(spark, sf_dir):
    return trust_verdict_long(ent.customer_dimensions_long(spark, sf_dir), ["c_custkey"])


@register("score_input_rejects", _with(ql.CUST_REJECTS, **O_CUST), ("SCR-3",))
def _rejects(spark, sf_dir):
    return score_rejects(ent.customer_dimensions_long(spark, sf_dir, clamp=False, fill_missing=False), ["c_custkey"])


@register("fix_ranking", _with(ql.FIX_RANKING, **O_CUST), ("SP-7", "SP-13"))
def _fix_ranking(spark, sf_dir):
    return fix.rank_fixes(ent.customer_dimensions_long(spark, sf_dir), ["c_custkey"], F.col("population"))


@register("before_after", _with(ql.BEFORE_AFTER, **O_CUST), ("SP-8",))
def _before_after(spark, sf_dir):
    return fix.before_after(ent.customer_dimensions_long(spark, sf_dir), ["c_custkey"], F.col("population"))


O_CORR = {"nation_est": ql.NATION_EST, "corr_raw": ql.CORR_RAW}


@register("corroboration_bands", _with(ql.CORROBORATION, **O_CORR), ("SP-3",))
def _corroboration(spark, sf_dir):
    pairs = ent.corroboration_pairs(ent.nation_estimates(spark, sf_dir))
    out = corroboration_bands(pairs, spark)
    return out.select("n_nationkey", "n_name", "indicator",
                      round_half_up(F.col("source_a"), 6).alias("source_a_percent"),
                      round_half_up(F.col("source_b"), 6).alias("source_b_percent"),
                      round_half_up(F.col("gap_points"), 6).alias("gap_points"),
                      "green_gap_points", "red_gap_points", "band")


@register("completeness_by_source", _with(ql.DOC_COMPLETENESS), ("AGG-4", "JN-2", "SCR-1"))
def _completeness(spark, sf_dir):
    return ent.completeness_by_source(spark, sf_dir)


@register("contract_results", _with(ql.CONTRACTS), ("QLT-1", "SP-12", "AGG-6", "T10"))
def _contracts(spark, sf_dir):
    return ent.contract_results(spark, sf_dir)


@register("row_counts", _with(ql.ROW_COUNTS), ("QLT-2", "SNK-2", "AGG-7", "SRC-4"))
def _row_counts(spark, sf_dir):
    return row_count_summary({t: read_table(spark, sf_dir, t) for t in TABLES})


@register("coverage_prediction", ql.COVERAGE, ("SP-11",))
def _coverage(spark, sf_dir):
    return predict.trend_anomalies(ent.nation_monthly_orders(spark, sf_dir), ["nation_key"], "month_index",
                                   "order_count")


def located_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities with the districts of the polygons they lie in."""
    facilities = facility_geo_df(spark, sf_dir).select("unique_id", "pincode", "has_valid_coordinates", "longitude", "latitude")
    valid = F.col("has_valid_coordinates")
    points = facilities.withColumns({"x": F.when(valid, F.col("longitude")), "y": F.when(valid, F.col("latitude"))})
    # the index comes from a fixed boundary set: its size is bounded
    return geo.assign_districts(points, geo.grid_index(geo.polygons_frame(spark)), "x", "y", broadcast_index=True)


O_PIP = {**O_VERDICTS, "pip_hits": ql.PIP_HITS, "pip": ql.PIP}


@register("point_in_polygon", _with("SELECT * FROM pip", **O_PIP), ("SP-1",))
def _pip(spark, sf_dir):
    return geo.first_district(located_df(spark, sf_dir), "unique_id")


def placed_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities with the polygon's district, the stated one (and as verified field, if it is verified), the code's."""
    from trustgrid.functions.text import place_key
    from trustgrid.operators.joins import many_to_one_join
    first = F.try_element_at("districts", F.lit(1))["district_name"]
    f = located_df(spark, sf_dir).select("unique_id", "pincode", "has_valid_coordinates",
                                         place_key(first).alias("polygon_district"))
    stated = fx.view(spark, sf_dir, "v_facility_stated").select(
        F.col("unique_id").alias("_id"), place_key("stated_district").alias("stated_district"), "is_verified")
    lkp = lookup_df(spark, sf_dir).select(F.col("pincode").alias("_code"),
                                          F.col("representative_district_key").alias("code_district"))
    # A code can hold a third of all facilities: the lookup join is skew-safe.
    j = many_to_one_join(f.join(stated, F.col("unique_id") == F.col("_id"), "left").drop("_id"), lkp, ["pincode"], ["_code"], "left")
    return j.withColumn("verified_district", F.when(F.col("is_verified"), F.col("stated_district")))


@register("geo_resolution", _with(ql.GEO_RESOLUTION, **O_PIP, **O_LOOKUP), ("SP-2",))
def _geo_resolution(spark, sf_dir):
    out = geo.resolve_geography(placed_df(spark, sf_dir), "polygon_district", "verified_district", "code_district",
                                "has_valid_coordinates")
    return out.select("unique_id", "polygon_district", "verified_district", "code_district", "resolved_district",
                      "resolution_method", "has_geography_conflict", "resolution_band")


@register("geo_conflicts", _with(ql.GEO_CONFLICTS, **O_PIP, **O_LOOKUP), ("SP-1", "SP-2"))
def _geo_conflicts(spark, sf_dir):
    out = geo.stated_conflicts(placed_df(spark, sf_dir), "polygon_district", "stated_district", "has_valid_coordinates")
    return out.select("unique_id", "has_valid_coordinates", "polygon_district", "stated_district", "agreement",
                      "stated_conflict", "location_band", "location_fix")


@register("capability_extraction", _with(ql.CAPABILITIES), ("SP-5", "SP-6"))
def _capabilities(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lowered = docs.select("doc_id", F.lower(pv.as_text(F.col("text"))).alias("_lt"))
    facts = lowered.select("doc_id", *pv.fact_columns(F.col("_lt")))
    n = (F.when(F.col("beds").isNotNull(), 1).otherwise(0) + F.when(F.col("doctors").isNotNull(), 1).otherwise(0)
         + F.when(F.col("emergency_24_7"), 1).otherwise(0) + F.when(F.col("nicu"), 1).otherwise(0)
         + F.when(F.col("accreditation"), 1).otherwise(0))
    return facts.withColumn("extracted_fact_count", n).withColumns({
        "provenance_confidence": pv.provenance_confidence(F.lit(False), F.col("extracted_fact_count") > 0),
        "provenance": pv.provenance_tag(F.lit(False), F.col("extracted_fact_count") > 0),
    })


@register("nation_verdicts", _with(ql.long_verdict("nation_dims", "n_nationkey"), **O_CORR, nation_dims=ql.NATION_DIMS),
          ("SP-4", "SCR-1"))
def _nation_verdicts(spark, sf_dir):
    return trust_verdict_long(ent.nation_dimensions(ent.nation_estimates(spark, sf_dir)), ["n_nationkey"])


DISTRICT_DIMS_SQL = """
SELECT state_key, district_key, 'completeness' AS dimension, 0 AS ordinal,
  coalesce(1.0 - CAST(missing_value_count AS DOUBLE) / indicator_cell_count, CAST(0.0 AS DOUBLE)) AS score,
  CAST(1.0 AS DOUBLE) AS weight, coalesce(missing_value_count > 0, false) AS low_confidence, false AS is_missing,
  false AS weak_signal FROM survey_districts
UNION ALL
SELECT state_key, district_key, 'suppression', 1,
  coalesce(1.0 - CAST(suppressed_indicator_count + low_sample_estimate_count AS DOUBLE) / indicator_cell_count, CAST(0.0 AS DOUBLE)),
  CAST(1.0 AS DOUBLE), coalesce(suppressed_indicator_count + low_sample_estimate_count > 0, false), false, false
FROM survey_districts
UNION ALL
SELECT d.state_key, d.district_key, 'postal_geocoding', 2, coalesce(p.geocoded_post_office_ratio, CAST(0.0 AS DOUBLE)),
  CAST(0.5 AS DOUBLE), coalesce(p.geocoded_post_office_ratio IS NULL, false), p.geocoded_post_office_ratio IS NULL, false
FROM survey_districts d LEFT JOIN postal p ON d.state_key = p.state_key AND d.district_key = p.district_key
"""


@register("district_verdicts", _with(ql.long_verdict("district_dims", "state_key, district_key"), **O_NEED,
                                     district_dims=DISTRICT_DIMS_SQL), ("SP-9", "SP-13", "SCR-1"))
def _district_verdicts(spark, sf_dir):
    dims = gold.district_dimensions(survey_districts_df(spark, sf_dir), silver.postal_summary(offices_df(spark, sf_dir)))
    return trust_verdict_long(dims, ["state_key", "district_key"])


def district_reports_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustgrid.functions.text import place_key
    r = fx.view(spark, sf_dir, "v_district_reports")
    return r.select(place_key("state").alias("state_key"), place_key("district").alias("district_key"), "reports", "located",
                    "delivery_percent")


def district_evidence_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.district_evidence(survey_cells_df(spark, sf_dir), district_reports_df(spark, sf_dir))


@register("facility_provenance", _with(ql.FACILITY_PROVENANCE), ("SP-5", "SP-6"))
def _facility_provenance(spark, sf_dir):
    return ent.facility_provenance(fx.view(spark, sf_dir, "v_facilities"))


O_SCORECARD = {**O_VERDICTS, "scorecard": q.SCORECARD_ALL}


def scorecard_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    geo = facility_geo_df(spark, sf_dir)
    return reports.facility_scorecard(geo, gold.facility_verdicts(geo), pinned=reports.DEFAULT_PIN, n=None)


@register("facility_simulated_fixes", _with(ql.SIMULATED_FIXES, **O_SCORECARD), ("SC-28",))
def _simulated(spark, sf_dir):
    return reports.simulated_fixes(scorecard_df(spark, sf_dir))


SEARCH_TERM = "nation_1"


@register("facility_search", _with(ql.search_sql(SEARCH_TERM), **O_SCORECARD), ("FLT-5",))
def _search(spark, sf_dir):
    return reports.facility_search(scorecard_df(spark, sf_dir), SEARCH_TERM)


@register("keep_list_offices", _with(ql.KEEP_LIST), ("SRC-9",))
def _keep_list(spark, sf_dir):
    from trustgrid.sources.io import keep_list_filter
    return keep_list_filter(fx.view(spark, sf_dir, "v_offices"), ["statename", "district"], ["AFRICA", " asia", "Europe "])


@register("preflight", _with(ql.PREFLIGHT), ("SRC-6", "SRC-4"))
def _preflight(spark, sf_dir):
    from trustgrid.sources.io import SourceSpec, preflight
    from trustgrid.sources.tables import table_path
    specs = [SourceSpec(t, table_path(sf_dir, t), required=True) for t in TABLES]
    return preflight(spark, specs).drop("source_location")


# --- pipeline self-checks over the silver outputs (QLT-1 with computed statuses) ----------

def pipeline_checks_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trustgrid.plans.checks import pipeline_checks

    facilities_raw = fx.view(spark, sf_dir, "v_facilities")
    offices_raw = fx.view(spark, sf_dir, "v_offices")
    wide = admin_wide_df(spark, sf_dir)
    return pipeline_checks(facilities_raw.columns, offices_raw.columns, {
        "facilities": silver.facility_geo(facilities_raw),
        "offices": silver.offices_silver(offices_raw),
        "lookup": lookup_df(spark, sf_dir),
        "survey": survey_cells_df(spark, sf_dir),
        "admin": silver.admin_long(wide),
        "admin_totals": silver.admin_totals(wide),
    })


_PIPELINE_CHECKS_SQL = """
SELECT *, CASE WHEN coalesce(CASE comparator WHEN 'eq' THEN observed_value = threshold
  WHEN 'le' THEN observed_value <= threshold ELSE observed_value >= threshold END, false) THEN 'pass'
  ELSE severity END AS status FROM (
SELECT 'facilities' AS dataset, 'facilities_required_columns_present' AS check_name, 'fail' AS severity,
  CAST(11 AS DOUBLE) AS observed_value, 'eq' AS comparator, CAST(11 AS DOUBLE) AS threshold
UNION ALL SELECT 'facilities', 'facilities_valid_coordinate_count', 'fail',
  CAST(count_if(has_valid_coordinates) AS DOUBLE), 'ge', CAST(1 AS DOUBLE) FROM facility_geo
UNION ALL SELECT 'offices', 'offices_required_columns_present', 'fail', CAST(5 AS DOUBLE), 'eq', CAST(5 AS DOUBLE)
UNION ALL SELECT 'offices', 'offices_invalid_code_count', 'warn', CAST(count_if(NOT is_valid_code) AS DOUBLE), 'eq',
  CAST(0 AS DOUBLE) FROM offices
UNION ALL SELECT 'lookup', 'code_lookup_is_unique', 'fail', CAST(count(*) - count(DISTINCT pincode) AS DOUBLE), 'eq',
  CAST(0 AS DOUBLE) FROM lookup
UNION ALL SELECT 'survey', 'survey_indicator_columns_detected', 'fail', CAST(count(DISTINCT indicator) AS DOUBLE), 'ge',
  CAST(1 AS DOUBLE) FROM survey_cells
UNION ALL SELECT 'admin', 'admin_state_grain_detected', 'fail', CAST(count(DISTINCT state_key) AS DOUBLE), 'ge',
  CAST(1 AS DOUBLE) FROM admin_long
UNION ALL SELECT 'admin', 'admin_invalid_numeric_count', 'warn', CAST(count_if(is_invalid_numeric) AS DOUBLE), 'eq',
  CAST(0 AS DOUBLE) FROM admin_long
UNION ALL SELECT 'admin_totals', 'admin_curated_indicator_count', 'warn', CAST(count(DISTINCT indicator_name) AS DOUBLE),
  'eq', CAST(7 AS DOUBLE) FROM admin_totals
) r
"""


@register("pipeline_checks", _with(_PIPELINE_CHECKS_SQL, **O_FAC, **O_LOOKUP, **O_SURVEY, **O_STATE),
          ("QLT-1", "FLT-2", "PRJ-4", "AGG-6", "AGG-7", "T10"))
def _pipeline_checks(spark, sf_dir):
    return pipeline_checks_df(spark, sf_dir)



_DISTRICT_IMPACT_SQL = """
SELECT n.state_key, n.district_key, NOT (n.missing_metric_count < 4) AS burden_is_state_proxy,
  coalesce(CASE WHEN n.missing_metric_count < 4 THEN n.demand_side_need_score ELSE s.sb END, CAST(0.0 AS DOUBLE))
    * (n.post_office_count + 1) AS impact
FROM need n LEFT JOIN (SELECT state_key, avg(demand_side_need_score) AS sb FROM need
                       WHERE missing_metric_count < 4 GROUP BY state_key) s ON n.state_key IS NOT DISTINCT FROM s.state_key
"""

_DISTRICT_FIX_SQL = """
SELECT state_key, district_key, burden_is_state_proxy, dimension, ordinal, {rs} AS score, weight, is_missing,
  {rl} AS score_lift, {ri} AS impact, {rp} AS priority,
  CAST(row_number() OVER (PARTITION BY state_key, district_key ORDER BY prio DESC, ordinal) AS INTEGER) AS fix_rank
FROM (SELECT d.*, i.burden_is_state_proxy, i.impact,
        (1.0 - d.score) * d.weight / sum(d.weight) OVER (PARTITION BY d.state_key, d.district_key) AS lift,
        ((1.0 - d.score) * d.weight / sum(d.weight) OVER (PARTITION BY d.state_key, d.district_key)) * i.impact
          * (CASE WHEN d.is_missing AND d.weight >= 1.0 THEN CAST(1.5 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END) AS prio
      FROM district_dims d LEFT JOIN district_impact i ON d.state_key IS NOT DISTINCT FROM i.state_key
        AND d.district_key IS NOT DISTINCT FROM i.district_key
      WHERE coalesce(d.score BETWEEN 0.0 AND 1.0, false)) r
WHERE score < 1.0
""".format(rs=q.rd("score"), rl=q.rd("lift"), ri=q.rd("impact"), rp=q.rd("prio"))


def district_fixes_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixes per district; a district without a state or a name keeps its fixes."""
    from trustgrid.operators.joins import null_safe_join
    districts = survey_districts_df(spark, sf_dir)
    postal = silver.postal_summary(offices_df(spark, sf_dir))
    need = gold.need_ranking(gold.district_context(districts, postal))
    dims = gold.district_dimensions(districts, postal)
    keys = ["state_key", "district_key"]
    return fix.rank_fixes(null_safe_join(dims, gold.district_impact(need), keys), keys, F.col("impact"),
                          extra_cols=["burden_is_state_proxy"])


@register("district_fix_ranking", _with(_DISTRICT_FIX_SQL, **O_NEED, district_dims=DISTRICT_DIMS_SQL,
                                        district_impact=_DISTRICT_IMPACT_SQL), ("SP-7", "SP-13"))
def _district_fix_ranking(spark, sf_dir):
    return district_fixes_df(spark, sf_dir)



_EXPECTED_FIT = """
SELECT regr_slope(institutional_delivery_percent, health_insurance_percent) AS b,
  regr_intercept(institutional_delivery_percent, health_insurance_percent) AS a,
  regr_count(institutional_delivery_percent, health_insurance_percent) AS n
FROM survey_districts
"""

_EXPECTED_PRED = """
SELECT d.state_key, d.district_key, d.health_insurance_percent, d.institutional_delivery_percent, CAST(f.n AS BIGINT) AS fit_rows,
  f.a + f.b * d.health_insurance_percent AS pred,
  d.institutional_delivery_percent - (f.a + f.b * d.health_insurance_percent) AS resid
FROM survey_districts d, expected_fit f
"""

_EXPECTED_BODY = """
SELECT state_key, district_key, health_insurance_percent, institutional_delivery_percent,
  {rp} AS expected_value, {rv} AS value_or_expected,
  institutional_delivery_percent IS NULL AND pred IS NOT NULL AS is_predicted_fill,
  {rr} AS residual, coalesce(abs(resid) > CAST(2.0 AS DOUBLE) * s.sd, false) AS is_divergent, fit_rows
FROM expected_pred, (SELECT stddev_samp(resid) AS sd FROM expected_pred) s
""".format(rp=q.rd("pred"), rv=q.rd("coalesce(institutional_delivery_percent, pred)"), rr=q.rd("resid"))


@register("expected_coverage", _with(_EXPECTED_BODY, **O_SURVEY, expected_fit=_EXPECTED_FIT,
                                     expected_pred=_EXPECTED_PRED), ("SP-11",))
def _expected_coverage(spark, sf_dir):
    return predict.expected_values(survey_districts_df(spark, sf_dir), ["state_key", "district_key"],
                                   "health_insurance_percent", "institutional_delivery_percent")


from trustgrid.plans import decisions  # noqa: E402,F401  (registers its queries)
