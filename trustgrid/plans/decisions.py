"""Queries that decide across entities: what to repair first, where a facility lies, what a survey says.

They build on the silver and gold frames of ``catalog``; each has a DuckDB form written from the rule.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustgrid.functions.cells import is_blank_field
from trustgrid.functions.schema import STAMP_COLUMNS, find_metric, metric_or_null
from trustgrid.operators import fix, geo, predict, quality
from trustgrid.operators import lookup as lk
from trustgrid.operators.corroborate import corroboration_rejects
from trustgrid.operators import provenance as pv
from trustgrid.operators.reshape import union_all_by_name
from trustgrid.operators.score import round_half_up, trust_verdict_long
from trustgrid.plans import catalog as c
from trustgrid.plans import entities as ent
from trustgrid.plans import gold, silver
from trustgrid.plans import sqlkit_large as ql
from trustgrid.plans.catalog import _with, register
from trustgrid.plans.sqlkit import pk, rd
from trustgrid.sources import fixtures as fx
from trustgrid.sources import io, publish
from trustgrid.sources.staging import shared_folder
from trustgrid.sources.tables import read_table

# --- SP-7: one list of fixes over all entities --------------------------------------------------


def _overall(body: str, keys: str) -> str:
    """The fixes of ``body`` with their place in the whole list."""
    by = ", ".join(f"{k} NULLS FIRST" for k in keys.split(", "))
    return f"SELECT *, row_number() OVER (ORDER BY priority DESC NULLS LAST, {by}, ordinal) AS rank_overall FROM ({body}) every"


@register("fix_priorities", _with(_overall(ql.FIX_RANKING, "c_custkey"), **c.O_CUST), ("SP-7", "SP-13"))
def _fix_priorities(spark, sf_dir):
    fixes = fix.rank_fixes(ent.customer_dimensions_long(spark, sf_dir), ["c_custkey"], F.col("population"))
    return fix.rank_overall(fixes, ["c_custkey"])


@register("district_fix_priorities", _with(_overall(c._DISTRICT_FIX_SQL, "state_key, district_key"), **c.O_NEED,
                                           district_dims=c.DISTRICT_DIMS_SQL, district_impact=c._DISTRICT_IMPACT_SQL),
          ("SP-7", "SP-13"))
def _district_fix_priorities(spark, sf_dir):
    return fix.rank_overall(c.district_fixes_df(spark, sf_dir), ["state_key", "district_key"])


# --- AGG-1 / AGG-4: every spelling in a table of its own ------------------------------------------

_SPELLINGS = """
SELECT source_state_key, source_state_name, count(*) AS total_facilities,
  CAST(count_if(has_valid_coordinates) AS BIGINT) AS valid_coordinate_facilities,
  CAST(count_if(has_pincode) AS BIGINT) AS pincode_present_facilities,
  CAST(count_if(has_capability_text) AS BIGINT) AS capability_text_facilities,
  CAST(sum(care_substance_missing_count) AS BIGINT) AS care_substance_missing_count
FROM facility_geo GROUP BY source_state_key, source_state_name
"""

OFFICE_KINDS = {"district": "district_key", "state": "state_key", "district_name": "district_name", "state_name": "state_name"}
_CODE_VALUES = " UNION ALL ".join(
    f"SELECT pincode, '{kind}' AS kind, {col} AS value, count(*) AS rows FROM offices WHERE pincode IS NOT NULL GROUP BY pincode, {col}"
    for kind, col in OFFICE_KINDS.items())


@register("state_spellings", _with(_SPELLINGS, **c.O_FAC), ("AGG-4", "T8"))
def _state_spellings(spark, sf_dir):
    return gold.state_spellings(c.facility_geo_df(spark, sf_dir))


@register("code_values", _with(_CODE_VALUES, **c.O_OFFICES), ("AGG-1", "SET-2"))
def _code_values(spark, sf_dir):
    return lk.key_values(c.offices_df(spark, sf_dir).where("pincode is not null"), ["pincode"], OFFICE_KINDS)


# --- SP-11: trends of all indicators in one pass ---------------------------------------------------

_SERIES = """
SELECT i.indicator, s.nation_key, s.month_index, CASE i.indicator WHEN 'order_count' THEN CAST(n AS DOUBLE)
    WHEN 'order_value' THEN CAST(amount AS DOUBLE) WHEN 'urgent_percent' THEN urgent * CAST(100.0 AS DOUBLE) / n
    ELSE done * CAST(100.0 AS DOUBLE) / n END AS value
FROM (SELECT c_nationkey AS nation_key, CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS INTEGER) AS month_index,
        count(*) AS n, sum(CAST(floor(o_totalprice) AS BIGINT)) AS amount,
        count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS urgent,
        count(*) FILTER (WHERE o_orderstatus = 'F') AS done
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) s,
  (VALUES ('order_count'), ('order_value'), ('urgent_percent'), ('fulfilled_percent')) AS i(indicator)
"""

_TRENDS = f"""
SELECT indicator, nation_key, month_index, value, {rd('slope', 2)} AS trend_slope, {rd('icpt', 2)} AS trend_intercept,
  {rd('pred', 2)} AS predicted, {rd('value - pred', 2)} AS residual,
  coalesce(abs(value - pred) > CAST(2.0 AS DOUBLE) * stddev_samp(value - pred) OVER (PARTITION BY indicator, nation_key), false) AS is_anomaly
FROM (SELECT *, icpt + slope * month_index AS pred
      FROM (SELECT *, regr_slope(value, month_index) OVER (PARTITION BY indicator, nation_key) AS slope,
              regr_intercept(value, month_index) OVER (PARTITION BY indicator, nation_key) AS icpt FROM ({_SERIES}) s) f) g
"""


@register("indicator_trends", _TRENDS, ("SP-11",))
def _indicator_trends(spark, sf_dir):
    return predict.trend_anomalies(ent.nation_monthly_indicators(spark, sf_dir), ["indicator", "nation_key"], "month_index",
                                   "value", scale=2)


# --- AGG-6: exact distinct codes at three grains from one table of bitmaps ---------------------------

_CODE_COUNTS = """
SELECT 'district' AS grain, state_key, district_key, count(DISTINCT pincode) AS code_count, count(*) AS office_count
FROM offices GROUP BY state_key, district_key
UNION ALL SELECT 'state', state_key, NULL, count(DISTINCT pincode), count(*) FROM offices GROUP BY state_key
UNION ALL SELECT 'table', NULL, NULL, count(DISTINCT pincode), count(*) FROM offices
"""


@register("code_counts", _with(_CODE_COUNTS, **c.O_OFFICES), ("AGG-6", "AGG-3"))
def _code_counts(spark, sf_dir):
    return quality.distinct_by_grain(c.offices_df(spark, sf_dir), F.col("pincode").try_cast("long"),
                                     ["state_key", "district_key"], ["table", "state", "district"], "code_count", "office_count")


# --- SP-5 / SP-6: facts from lists of claims ----------------------------------------------------------

# items as DuckDB reads them: JSON lists by item, a JSON text as its value, all else as it is
_CLAIM_ITEMS = """
SELECT unique_id, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS item_pos FROM (
  SELECT unique_id, CASE WHEN json_valid(claims) AND json_type(claims) = 'ARRAY' THEN json_extract_string(claims, '$[*]')
    WHEN json_valid(claims) AND json_type(claims) = 'VARCHAR' THEN [json_extract_string(claims, '$')] ELSE [claims] END AS items
  FROM v_facility_claims) x
"""

_CLAIM_FACTS = " UNION ALL ".join(
    f"SELECT unique_id, CAST(item_pos AS INTEGER) AS item_pos, '{fact}' AS fact, {amount} AS amount FROM claim_items WHERE {found}"
    for fact, amount, found in (
        ("beds", r"TRY_CAST(regexp_extract(lower(item), '([0-9]+)\s*(?:-\s*)?(?:beds?|bedded)', 1) AS BIGINT)",
         r"regexp_matches(lower(item), '[0-9]+\s*(?:-\s*)?(?:beds?|bedded)')"),
        ("doctors", r"TRY_CAST(regexp_extract(lower(item), '([0-9]+)\s*(?:doctors?|physicians?)', 1) AS BIGINT)",
         r"regexp_matches(lower(item), '[0-9]+\s*(?:doctors?|physicians?)')"),
        ("emergency_24_7", "CAST(NULL AS BIGINT)", r"regexp_matches(lower(item), '24\s*[/x]\s*7|round[- ]the[- ]clock')"),
        ("nicu", "CAST(NULL AS BIGINT)", "regexp_matches(lower(item), 'nicu|neonatal intensive')"),
        ("accreditation", "CAST(NULL AS BIGINT)", "regexp_matches(lower(item), 'accredit|licence|license')")))
O_CLAIMS = {"claim_items": _CLAIM_ITEMS, "claim_facts": _CLAIM_FACTS}
FACTS = ("beds", "doctors", "emergency_24_7", "nicu", "accreditation")


@register("claim_facts", _with("SELECT * FROM claim_facts", **O_CLAIMS), ("SP-6",))
def _claim_facts(spark, sf_dir):
    return claim_facts_df(spark, sf_dir)


def claim_facts_df(spark, sf_dir):
    keep = ["unique_id", "item_pos"]
    return pv.item_facts(pv.claim_items(fx.view(spark, sf_dir, "v_facility_claims"), "claims", ["unique_id"]), keep)


_ENTITY_FACTS = """
SELECT unique_id, fact, max(amount) AS amount, count(*) AS items FROM claim_facts GROUP BY unique_id, fact
"""


@register("facility_facts", _with(_ENTITY_FACTS, **O_CLAIMS), ("SP-6",))
def _facility_facts(spark, sf_dir):
    return pv.entity_facts(claim_facts_df(spark, sf_dir), ["unique_id"])


def _tag(fact: str, field: str | None) -> str:
    own = f"WHEN NOT ({field} IS NULL OR lower(trim({field})) IN ('', 'null')) THEN 'structured' " if field else ""
    return f"CASE {own}WHEN bool_or(fact = '{fact}') THEN 'extracted' ELSE 'absent' END AS {fact}_provenance"


_POINTS = " + ".join(f"CASE {f}_provenance WHEN 'structured' THEN CAST(1.0 AS DOUBLE) WHEN 'extracted' THEN CAST(0.6 AS DOUBLE) "
                     "ELSE CAST(0.0 AS DOUBLE) END" for f in FACTS)
_COUNT = {tag: " + ".join(f"CASE WHEN {f}_provenance = '{tag}' THEN 1 ELSE 0 END" for f in FACTS) for tag in ("extracted", "absent")}
_PROFILE = f"""
SELECT unique_id, {', '.join(f'{f}_provenance' for f in FACTS)}, inferred_facts, absent_facts, {rd('mean')} AS fact_confidence,
  CASE WHEN mean < 0.60 THEN 'red' WHEN mean < 0.85 OR inferred_facts > 0 OR absent_facts > 0 THEN 'amber' ELSE 'green' END AS fact_band
FROM (SELECT *, ({_POINTS}) / 5 AS mean, {_COUNT['extracted']} AS inferred_facts, {_COUNT['absent']} AS absent_facts FROM (
  SELECT f.unique_id, {', '.join(_tag(f, {'beds': 'capacity', 'doctors': 'doctors'}.get(f)) for f in FACTS)}
  FROM v_facilities f LEFT JOIN claim_facts c ON f.unique_id = c.unique_id GROUP BY f.unique_id, doctors, capacity) a) b
"""


@register("facility_fact_profile", _with(_PROFILE, **O_CLAIMS), ("SP-5", "SP-6"))
def _facility_fact_profile(spark, sf_dir):
    facts = pv.entity_facts(claim_facts_df(spark, sf_dir), ["unique_id"])
    return pv.fact_profile(fx.view(spark, sf_dir, "v_facilities"), facts, "unique_id", {
        "beds": ~is_blank_field(F.col("capacity")), "doctors": ~is_blank_field(F.col("doctors"))})


# --- SRC-3 / SRC-10: features with differing properties ---------------------------------------------------

_FEATURES = """
SELECT CAST(s_suppkey AS BIGINT) AS id, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS name,
  CASE WHEN s_suppkey % 3 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type,
  CASE WHEN s_suppkey % 2 = 0 THEN '4' END AS area_km2, CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END AS rings,
  CAST(s_suppkey % 50 AS DOUBLE) AS west, CAST(s_suppkey % 50 + CASE WHEN s_suppkey % 3 = 0 THEN 5 ELSE 2 END AS DOUBLE) AS east,
  CAST(s_nationkey * 3 AS DOUBLE) AS south, CAST(s_nationkey * 3 + 2 AS DOUBLE) AS north
FROM supplier
"""


@register("feature_boxes", _FEATURES, ("SRC-3", "SRC-10", "SP-1"))
def _feature_boxes(spark, sf_dir):
    """Suppliers' features, written as a file of features, read back: identity, parts and extent of each."""
    path = f"{shared_folder(spark)}/features/{uuid.uuid4().hex}"
    fx.supplier_features(spark, sf_dir).write.text(path)
    polygons = geo.polygons_from_features(io.read_features(spark, path, lines=True).withColumns({
        "id": io.feature_property("id").try_cast("long"), "name": io.feature_property("NAME_2"),
        "area_km2": F.try_variant_get("properties", "$.area.km2", "string")}), keep=["id", "name", "geometry_type", "area_km2"])
    points = F.flatten(F.from_json("rings_json", "array<array<array<double>>>"))
    x, y = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return polygons.select("id", "name", "geometry_type", "area_km2",
                           F.size(F.from_json("rings_json", "array<array<array<double>>>")).alias("rings"),
                           F.array_min(x).alias("west"), F.array_max(x).alias("east"), F.array_min(y).alias("south"),
                           F.array_max(y).alias("north"))


# --- SRC-1, 2, 5, 7, SNK-1, 3, 4, 5: landing and publishing as round trips --------------------------------

VITAL_RATES = "state string, birth_rate double, death_rate double, growth_rate double, infant_mortality string"


def landed_offices(spark, sf_dir):
    """The office directory as it is published, a windows-1252 CSV file with cells over several lines, landed again."""
    path = f"{shared_folder(spark)}/landing/{uuid.uuid4().hex}/offices_csv"
    # the file's bytes: a curly apostrophe (0x92) and a line break in one cell
    note = F.concat(F.lit("Office\x92s note\n"), F.col("office_id").cast("string"))
    (fx.view(spark, sf_dir, "v_offices").withColumn("Remarks", note).write.option("header", True).option("encoding", "ISO-8859-1")
     .option("escape", '"').csv(path))
    return io.stamp_ingest(io.read_csv(spark, path, encoding="windows-1252", multiline=True))


_LANDED = """
SELECT CAST(o.office_id AS VARCHAR) AS office_id, o.pincode, o.is_valid_code, o.district_key, o.state_key, o.latitude, o.longitude,
  o.has_coordinates, 'Office’s note' || chr(10) || o.office_id AS remarks, 'bronze' AS layer, true AS has_source_file, true AS is_stamped
FROM offices o
"""


@register("csv_landing", _with(_LANDED, **c.O_OFFICES), ("SRC-1", "SRC-2", "SRC-7", "PRJ-2"))
def _csv_landing(spark, sf_dir):
    landed = landed_offices(spark, sf_dir)
    parsed = silver.offices_silver(landed)
    notes = landed.select(F.col("office_id").alias("_id"), F.col("Remarks").alias("remarks"), F.col("_medallion_layer").alias("layer"),
                          F.col("_source_file").contains("/offices_csv/").alias("has_source_file"),
                          F.col("_ingested_at_utc").isNotNull().alias("is_stamped"))
    return parsed.join(notes, parsed["office_id"] == notes["_id"]).select(
        "office_id", "pincode", "is_valid_code", "district_key", "state_key", "latitude", "longitude", "has_coordinates",
        "remarks", "layer", "has_source_file", "is_stamped")


_SUMMARY = """
SELECT 'offices' AS table_name, count(*) AS row_count, 7 AS column_count, true AS has_run_id FROM v_offices
UNION ALL SELECT 'vital_rates', 0, 5, true
"""


@register("landing_summary", _with(_SUMMARY), ("SRC-1", "SRC-5", "SNK-2", "SNK-4"))
def _landing_summary(spark, sf_dir):
    """Rows of a landed file and of an optional one that is absent, under the id of the run."""
    absent = io.read_optional_csv(spark, f"{shared_folder(spark)}/landing/{uuid.uuid4().hex}/vital_rates.csv",
                                  T.StructType.fromDDL(VITAL_RATES))
    landed = landed_offices(spark, sf_dir).drop(*STAMP_COLUMNS)
    counts = io.row_count_summary({"offices": landed, "vital_rates": absent}).withColumn("run_id", io.run_id_column("landing"))
    widths = F.create_map(F.lit("offices"), F.lit(len(landed.columns)), F.lit("vital_rates"), F.lit(len(absent.columns)))
    return counts.select("table_name", "row_count", widths[F.col("table_name")].alias("column_count"),
                         F.col("run_id").rlike(r"^landing-\d{8}T\d{6}Z$").alias("has_run_id"))


def published_orders(spark, sf_dir):
    """Orders per status published by two runs; the second one holds corrected rows of two statuses. (target, rows)"""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.floor("o_totalprice").cast("long").alias("amount"), F.lit(1).alias("version"))
    target = f"{shared_folder(spark)}/published/{uuid.uuid4().hex}/orders"
    publish.publish(orders, target, ["o_orderstatus"], "run-1")
    corrected = orders.where(F.col("o_orderstatus").isin("F", "P")).withColumns({"amount": F.col("amount") + 1, "version": F.lit(2)})
    publish.publish(corrected, target, ["o_orderstatus"], "run-2")
    return target, publish.published(spark, target, orders)


_PUBLISHED = """
SELECT o_orderstatus, CASE WHEN o_orderstatus IN ('F', 'P') THEN 2 ELSE 1 END AS version, count(*) AS row_count,
  CAST(sum(CAST(floor(o_totalprice) AS BIGINT) + CASE WHEN o_orderstatus IN ('F', 'P') THEN 1 ELSE 0 END) AS BIGINT) AS amount
FROM orders GROUP BY 1, 2
"""


@register("publish_partitions", _PUBLISHED, ("SNK-1",))
def _publish_partitions(spark, sf_dir):
    """The published orders, read back: partitions of the second run are replaced, the others stay."""
    return published_orders(spark, sf_dir)[1].groupBy("o_orderstatus", "version").agg(
        F.count("*").alias("row_count"), F.sum("amount").alias("amount"))


_MANIFESTS = """
SELECT 'run-1' AS run_id, 'o_orderstatus=' || o_orderstatus AS partition, count(*) AS row_count FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'run-2', 'o_orderstatus=' || o_orderstatus, count(*) FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY o_orderstatus
"""


@register("publish_manifests", _MANIFESTS, ("SNK-1", "SNK-4"))
def _publish_manifests(spark, sf_dir):
    return publish.manifests(spark, published_orders(spark, sf_dir)[0]).select("run_id", "partition", "row_count")


_PREVIEW = """
SELECT * FROM (SELECT 'customers' AS table_name, c_custkey AS key, c_name AS name FROM customer ORDER BY c_custkey LIMIT 5) a
UNION ALL SELECT * FROM (SELECT 'parts', p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 5) b
"""


@register("catalog_preview", _PREVIEW, ("SNK-3", "SNK-5", "SRC-4"))
def _catalog_preview(spark, sf_dir):
    """First rows of tables saved to a database of their own in the shared folder."""
    run = uuid.uuid4().hex
    database = f"trustgrid_{run}"
    io.create_database(spark, database, f"{shared_folder(spark)}/databases/{run}")
    names = {"customers": ("customer", "c_custkey", "c_name"), "parts": ("part", "p_partkey", "p_name")}
    for name, (table, key, label) in names.items():
        rows = read_table(spark, sf_dir, table).select(F.col(key).cast("long").alias("key"), F.col(label).alias("name"))
        rows.write.mode("overwrite").saveAsTable(f"{database}.{name}")
    shown = io.table_preview({n: spark.table(f"{database}.{n}") for n in names}, 5, {n: ("key",) for n in names})
    return union_all_by_name([df.select(F.lit(n).alias("table_name"), "key", "name") for n, df in shown.items()])


# --- SP-3: what cannot be corroborated; PRJ-6 / PRJ-7: metrics found by their words ---------------------------

_CORR_REJECTS = f"""
SELECT n_nationkey, n_name, indicator, 'excluded_indicator' AS reject_reason
FROM ({ql._PAIRS}) p WHERE indicator IN ('anaemia', 'c_section')
"""


@register("corroboration_rejects", _with(_CORR_REJECTS, **c.O_CORR), ("SP-3",))
def _corroboration_rejects(spark, sf_dir):
    pairs = ent.corroboration_pairs(ent.nation_estimates(spark, sf_dir))
    return corroboration_rejects(pairs, spark).select("n_nationkey", "n_name", "indicator", "reject_reason")


# The words that name a metric in a survey's headings (all of them, none of the others).
METRIC_WORDS = {
    "women_anaemia_percent": (("women", "anaemic"), ()),
    "institutional_delivery_percent": (("institutional", "births"), ("caesarean",)),
    "vaccination_percent": (("vaccinated",), ()),
    "any_births_percent": (("births",), ()),
    "tobacco_percent": (("tobacco",), ()),
}
_FOUND = {  # metric: (column, candidates)
    "women_anaemia_percent": ("women_age_15_49_years_who_are_anaemic_percent", 1),
    "institutional_delivery_percent": ("institutional_births_in_the_5_years_before_the_survey_percent", 1),
    "vaccination_percent": ("children_age_12_23_months_fully_vaccinated_card_or_recall_percent", 1),
    "any_births_percent": ("births_delivered_by_caesarean_section_in_a_public_health_facility_percent", 2),
    "tobacco_percent": (None, 0),
}
_METRICS = " UNION ALL ".join(
    f"SELECT state_key, district_key, '{m}' AS metric, {f'{chr(39)}{col}{chr(39)}' if col else 'CAST(NULL AS VARCHAR)'} AS indicator, "
    f"{n} AS candidates, {col or 'CAST(NULL AS DOUBLE)'} AS value FROM survey_districts" for m, (col, n) in _FOUND.items())


@register("metric_values", _with(_METRICS, **c.O_SURVEY), ("PRJ-6", "PRJ-7", "T13"))
def _metric_values(spark, sf_dir):
    """Every metric per district from the indicator its words find; a metric that no indicator has is null."""
    districts = c.survey_districts_df(spark, sf_dir)
    indicators = silver.survey_indicators(silver.survey_landed(spark, sf_dir))
    cells = []
    for metric, words in METRIC_WORDS.items():
        match = find_metric(indicators, *words)
        cells.append(F.struct(F.lit(metric).alias("metric"), F.lit(match.column).cast("string").alias("indicator"),
                              F.lit(len(match.candidates)).alias("candidates"), metric_or_null(districts, match.column, "value")))
    return districts.select("state_key", "district_key", F.inline(F.array(*cells)))


# --- SP-9: district verdicts from evidence of two grains -------------------------------------------------------

_NEED_CELLS = """
SELECT state_key, district_key, count(*) AS cells, count(*) FILTER (WHERE value IS NULL) AS missing,
  count(*) FILTER (WHERE is_suppressed OR is_low_sample_estimate) AS flagged,
  max(CASE WHEN indicator = 'institutional_births_in_the_5_years_before_the_survey_percent' THEN value END) AS survey_percent
FROM survey_cells WHERE indicator IN ('women_age_15_49_years_who_are_anaemic_percent',
  'children_under_5_years_who_are_stunted_height_for_age_percent',
  'households_with_any_usual_member_covered_under_a_health_insurance_financing_scheme_percent',
  'institutional_births_in_the_5_years_before_the_survey_percent')
GROUP BY state_key, district_key
"""

_REPORTS = f"""
SELECT {pk('state')} AS state_key, {pk('district')} AS district_key, reports, located, delivery_percent * reports AS total
FROM v_district_reports
"""

_JOINED = """
SELECT n.*, coalesce(r.reports, s.reports) AS reports, coalesce(r.located, s.located) AS located, coalesce(r.total, s.total) AS total,
  CASE WHEN r.reports IS NOT NULL THEN 'district' WHEN s.reports IS NOT NULL THEN 'state' ELSE 'none' END AS evidence_grain
FROM need_cells n LEFT JOIN reports r ON n.state_key = r.state_key AND n.district_key = r.district_key
LEFT JOIN (SELECT state_key, sum(reports) AS reports, sum(located) AS located, sum(total) AS total FROM reports GROUP BY state_key) s
  ON n.state_key = s.state_key
"""

_SCORED = """
SELECT state_key, district_key, evidence_grain, evidence_grain <> 'district' AS proxy, cells, missing, flagged,
  CAST(located AS DOUBLE) / CAST(reports AS DOUBLE) AS share, abs(survey_percent - total / CAST(reports AS DOUBLE)) AS gap,
  CASE evidence_grain WHEN 'district' THEN CAST(1.0 AS DOUBLE) WHEN 'state' THEN CAST(0.6 AS DOUBLE) END AS grain FROM joined
"""

_EVIDENCE = " UNION ALL ".join(
    f"SELECT state_key, district_key, evidence_grain, '{name}' AS dimension, {i} AS ordinal, coalesce({score}, CAST(0.0 AS DOUBLE)) AS score, "
    f"CAST({weight} AS DOUBLE) AS weight, coalesce({low}, true) AS low_confidence, {score} IS NULL AS is_missing, {weak} AS weak_signal FROM scored"
    for i, (name, score, weight, low, weak) in enumerate((
        ("completeness", "(CAST(1.0 AS DOUBLE) - CAST(missing AS DOUBLE) / cells)", "1.0", "missing > 0", "false"),
        ("suppression", "(CAST(1.0 AS DOUBLE) - CAST(flagged AS DOUBLE) / cells)", "1.0", "flagged > 0", "false"),
        ("geocoding", "share", "0.5", "proxy", "proxy"),
        ("corroboration", "(CASE WHEN gap IS NOT NULL THEN greatest(CAST(0.0 AS DOUBLE), CAST(1.0 AS DOUBLE) - gap / CAST(40.0 AS DOUBLE)) END)",
         "(CASE WHEN proxy THEN 0.5 ELSE 1.0 END)", "(proxy OR NOT gap < 8)", "proxy"),
        ("reconcilability", "grain", "0.5", "proxy", "false"),
        ("grain", "grain", "0.5", "proxy", "false"))))
O_EVIDENCE = {**c.O_SURVEY, "need_cells": _NEED_CELLS, "reports": _REPORTS, "joined": _JOINED, "scored": _SCORED, "evidence": _EVIDENCE}


@register("district_evidence", _with(
    f"SELECT state_key, district_key, evidence_grain, dimension, ordinal, {rd('score')} AS score, weight, low_confidence, is_missing, "
    "weak_signal FROM evidence", **O_EVIDENCE), ("SP-9", "SP-3", "SP-13"))
def _district_evidence(spark, sf_dir):
    return c.district_evidence_df(spark, sf_dir).withColumn("score", round_half_up(F.col("score"), 6))


@register("district_evidence_verdicts", _with(ql.long_verdict("evidence", "state_key, district_key"), **O_EVIDENCE), ("SP-9", "SP-4", "SCR-1"))
def _district_evidence_verdicts(spark, sf_dir):
    return trust_verdict_long(c.district_evidence_df(spark, sf_dir).drop("evidence_grain"), ["state_key", "district_key"])
