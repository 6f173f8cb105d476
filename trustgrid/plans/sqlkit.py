"""DuckDB-dialect SQL snippets for the oracle side of each query.

The oracle is written independently from the DataFrame code: it re-states
each rule in plain SQL over the same fixture views, so the Spark plan is
checked against a second engine rather than against itself.
"""

from __future__ import annotations


def pk(x: str) -> str:
    """place_key in SQL."""
    return (f"nullif(trim(regexp_replace(regexp_replace(regexp_replace(replace(lower(strip_accents({x})), '&', ' and '), "
            f"'\\s', ' ', 'g'), '[^0-9a-z ]', '', 'g'), ' +', ' ', 'g')), '')")


def rd(x: str, n: int = 6) -> str:
    """Half-up rounding through DECIMAL(38,10), as ``round_half_up``."""
    return f"CAST(round(CAST(({x}) AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def band(x: str) -> str:
    d = f"CAST(({x}) AS DECIMAL(38,10))"
    return (f"(CASE WHEN {d} >= 0.85 THEN 'green' WHEN {d} >= 0.60 THEN 'amber' "
            f"WHEN {d} IS NOT NULL THEN 'red' END)")


def brank(b: str) -> str:
    return f"(CASE ({b}) WHEN 'green' THEN 2 WHEN 'amber' THEN 1 WHEN 'red' THEN 0 END)"


def cap(b: str, c: str) -> str:
    r = f"least({brank(b)}, {brank(c)})"
    return (f"(CASE WHEN {brank(b)} IS NULL OR {brank(c)} IS NULL THEN NULL "
            f"WHEN {r} = 2 THEN 'green' WHEN {r} = 1 THEN 'amber' ELSE 'red' END)")


def dec(x: str) -> str:
    """decimal_or_null."""
    return f"(CASE WHEN regexp_matches(trim({x}), '^[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') THEN TRY_CAST(trim({x}) AS DOUBLE) END)"


def blank(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR lower(trim({x})) IN ('', 'null') THEN 1 ELSE 0 END)"


def sorted_join(x: str) -> str:
    return f"coalesce(array_to_string(list_sort(list(DISTINCT {x}) FILTER (WHERE {x} IS NOT NULL)), '|'), '')"


def sane(x: str) -> str:
    return (f"coalesce({x} IS NOT NULL AND lower({x}) <> 'null' AND NOT starts_with({x}, '{{') "
            f"AND NOT contains({x}, 'coordinates') AND NOT regexp_matches({x}, '^[0-9]+$') "
            f"AND regexp_matches({x}, '[A-Za-z]'), false)")


FACILITY_GEO = f"""
SELECT unique_id, name, state_raw AS source_state_name, {pk('state_raw')} AS source_state_key,
  pincode, lat AS latitude, lon AS longitude,
  coalesce(lat BETWEEN 6.0 AND 38.0 AND lon BETWEEN 68.0 AND 98.0, false) AS has_valid_coordinates,
  pincode IS NOT NULL AS has_pincode,
  coalesce(capability IS NOT NULL AND length(capability) > 0, false) AS has_capability_text,
  {blank('doctors')} + {blank('capacity')} + {blank('year_raw')} + {blank('recency')} AS care_substance_missing_count,
  'point' AS geo_grain
FROM (SELECT *, {dec('latitude')} AS lat, {dec('longitude')} AS lon,
        nullif(regexp_extract(' ' || zip_raw || ' ', '[^0-9]([0-9]{{6}})[^0-9]', 1), '') AS pincode
      FROM v_facilities) f
"""

FACILITY_VERDICTS = f"""
SELECT source_state_key, source_state_name, source_state_spellings, source_state_spelling_count, total_facilities,
  valid_coordinate_facilities, pincode_present_facilities, capability_text_facilities,
  {rd('avg_missing')} AS avg_care_substance_missing_count,
  {rd('loc')} AS location_trust_score, {rd('comp')} AS data_completeness_score, {rd('(loc + comp) / 2.0')} AS numeric_score,
  {band('(loc + comp) / 2.0')} AS band_by_mean,
  CASE WHEN avg_missing > 0 OR valid_coordinate_facilities < total_facilities OR pincode_present_facilities < total_facilities
            OR capability_text_facilities < total_facilities THEN {cap(cap(band('(loc + comp) / 2.0'), band('least(loc, comp)')), "'amber'")}
       ELSE {cap(band('(loc + comp) / 2.0'), band('least(loc, comp)'))} END AS band,
  CASE WHEN loc <= comp THEN 'Location: invalid or out-of-country coordinates constrain trust'
       ELSE 'Completeness: sparse care-substance fields constrain trust' END AS binding_reason,
  'state' AS geo_grain, 'state_rollup_before_district_polygon_assignment' AS data_caution
FROM (
  SELECT *, valid_coordinate_facilities / total_facilities AS loc,
    (pincode_present_facilities / total_facilities + capability_text_facilities / total_facilities
      + (4.0 - avg_missing) / 4.0) / 3.0 AS comp
  FROM (
    SELECT source_state_key, min(source_state_name) AS source_state_name,
      {sorted_join('source_state_name')} AS source_state_spellings,
      count(DISTINCT source_state_name) AS source_state_spelling_count,
      count(*) AS total_facilities,
      CAST(count_if(has_valid_coordinates) AS BIGINT) AS valid_coordinate_facilities,
      CAST(count_if(has_pincode) AS BIGINT) AS pincode_present_facilities,
      CAST(count_if(has_capability_text) AS BIGINT) AS capability_text_facilities,
      sum(care_substance_missing_count) / count(*) AS avg_missing
    FROM facility_geo GROUP BY source_state_key) a) b
"""

OFFICES = f"""
SELECT office_id, pcode AS pincode, pcode IS NOT NULL AS is_valid_code, district AS district_name, statename AS state_name,
  {pk('district')} AS district_key, {pk('statename')} AS state_key, lat AS latitude, lon AS longitude,
  coalesce(lat IS NOT NULL AND lon IS NOT NULL, false) AS has_coordinates
FROM (SELECT *, {dec('latitude')} AS lat, {dec('longitude')} AS lon,
        CASE WHEN length(regexp_extract(pincode, '[0-9]+', 0)) BETWEEN 1 AND 6
             THEN lpad(regexp_extract(pincode, '[0-9]+', 0), 6, '0') END AS pcode
      FROM v_offices) o
"""

LOOKUP = f"""
SELECT pincode, post_office_count, district_count, state_count, district_keys, state_keys, district_names, state_names,
  district_name_count, state_name_count, geocoded_office_count, is_geography_ambiguous,
  CASE WHEN NOT is_geography_ambiguous THEN nullif(split_part(district_keys, '|', 1), '') END AS representative_district_key,
  CASE WHEN NOT is_geography_ambiguous THEN nullif(split_part(state_keys, '|', 1), '') END AS representative_state_key
FROM (
  SELECT pincode, count(*) AS post_office_count,
    count(DISTINCT district_key) AS district_count, count(DISTINCT state_key) AS state_count,
    {sorted_join('district_key')} AS district_keys, {sorted_join('state_key')} AS state_keys,
    {sorted_join('district_name')} AS district_names, {sorted_join('state_name')} AS state_names,
    count(DISTINCT district_name) AS district_name_count, count(DISTINCT state_name) AS state_name_count,
    CAST(count_if(has_coordinates) AS BIGINT) AS geocoded_office_count,
    count(DISTINCT district_key) > 1 OR count(DISTINCT state_key) > 1 AS is_geography_ambiguous
  FROM offices WHERE pincode IS NOT NULL GROUP BY pincode) l
"""

SURVEY_CELLS = f"""
SELECT state AS state_name, district AS district_name, {pk('state')} AS state_key, {pk('district')} AS district_key,
  indicator, raw_value,
  CASE WHEN sup OR num = '' THEN NULL ELSE TRY_CAST(num AS DOUBLE) END AS value,
  sup AS is_suppressed, low AS is_low_sample_estimate,
  coalesce(trim(raw_value) <> '' AND NOT sup AND NOT low
           AND NOT regexp_matches(replace(trim(raw_value), ',', ''), '^[-+]?[0-9]+(?:\\.[0-9]+)?$'), false) AS is_unparsed
FROM (SELECT *, coalesce(trim(raw_value) = '*', false) AS sup,
        coalesce(regexp_matches(trim(raw_value), '^\\([-+]?[0-9]+(?:\\.[0-9]+)?\\)$'), false) AS low,
        regexp_extract(replace(trim(raw_value), ',', ''), '[-+]?[0-9]+(?:\\.[0-9]+)?', 0) AS num
      FROM v_survey_cells) c
"""

# The indicators of the survey as columns.
INDICATORS = tuple(sorted((
    "women_age_15_49_years_who_are_anaemic_percent",
    "children_under_5_years_who_are_stunted_height_for_age_percent",
    "households_with_any_usual_member_covered_under_a_health_insurance_financing_scheme_percent",
    "institutional_births_in_the_5_years_before_the_survey_percent",
    "births_delivered_by_caesarean_section_in_a_public_health_facility_percent",
    "households_that_use_an_improved_sanitation_facility_percent",
    "mothers_who_had_at_least_4_antenatal_care_visits_percent",
    "children_age_12_23_months_fully_vaccinated_card_or_recall_percent",
)))
_EVERY_INDICATOR = ",\n  ".join(f"max(CASE WHEN indicator = '{i}' THEN value END) AS {i}" for i in INDICATORS)

SURVEY_DISTRICTS = f"""
SELECT state_key, district_key, min(state_name) AS state_name, min(district_name) AS district_name,
  max(CASE WHEN indicator = 'women_age_15_49_years_who_are_anaemic_percent' THEN value END) AS women_anaemia_percent,
  max(CASE WHEN indicator = 'children_under_5_years_who_are_stunted_height_for_age_percent' THEN value END) AS child_stunting_percent,
  max(CASE WHEN indicator = 'households_with_any_usual_member_covered_under_a_health_insurance_financing_scheme_percent' THEN value END) AS health_insurance_percent,
  max(CASE WHEN indicator = 'institutional_births_in_the_5_years_before_the_survey_percent' THEN value END) AS institutional_delivery_percent,
  max(CASE WHEN indicator = 'births_delivered_by_caesarean_section_in_a_public_health_facility_percent' THEN value END) AS caesarean_public_percent,
  count(*) AS indicator_cell_count,
  CAST(count_if(is_suppressed) AS BIGINT) AS suppressed_indicator_count,
  CAST(count_if(is_low_sample_estimate) AS BIGINT) AS low_sample_estimate_count,
  CAST(count_if(value IS NULL) AS BIGINT) AS missing_value_count,
  CAST(count_if(is_unparsed) AS BIGINT) AS unparsed_value_count,
  {_EVERY_INDICATOR}
FROM survey_cells GROUP BY state_key, district_key
"""

POSTAL = """
SELECT state_key, district_key, count(DISTINCT pincode) AS pincode_count, count(*) AS post_office_count,
  CAST(count_if(has_coordinates) AS BIGINT) AS geocoded_post_office_count,
  CAST(count_if(has_coordinates) AS BIGINT) / count(*) AS geocoded_post_office_ratio
FROM offices GROUP BY state_key, district_key
"""

NEED = f"""
SELECT state_key, district_key, state_name, district_name, pincode_count, post_office_count,
  {rd('geocoded_post_office_ratio')} AS geocoded_post_office_ratio,
  suppressed_indicator_count, low_sample_estimate_count,
  {rd('women_anaemia_percent')} AS women_anaemia_percent, {rd('child_stunting_percent')} AS child_stunting_percent,
  {rd('health_insurance_percent')} AS health_insurance_percent,
  {rd('institutional_delivery_percent')} AS institutional_delivery_percent,
  {rd("coalesce(women_anaemia_percent, 0.0) + coalesce(child_stunting_percent, 0.0) + (100.0 - coalesce(health_insurance_percent, 100.0)) + (100.0 - coalesce(institutional_delivery_percent, 100.0))")} AS demand_side_need_score,
  missing_metric_count,
  CASE WHEN suppressed_indicator_count > 0 OR low_sample_estimate_count > 0 THEN 'review_suppressed_or_low_sample_indicators'
       WHEN missing_metric_count > 0 THEN 'review_missing_indicators' ELSE 'standard' END AS data_caution
FROM (
  SELECT d.*, coalesce(p.pincode_count, 0) AS pincode_count, coalesce(p.post_office_count, 0) AS post_office_count,
    p.geocoded_post_office_ratio,
    (CASE WHEN women_anaemia_percent IS NULL THEN 1 ELSE 0 END) + (CASE WHEN child_stunting_percent IS NULL THEN 1 ELSE 0 END)
    + (CASE WHEN health_insurance_percent IS NULL THEN 1 ELSE 0 END) + (CASE WHEN institutional_delivery_percent IS NULL THEN 1 ELSE 0 END) AS missing_metric_count
  FROM survey_districts d LEFT JOIN postal p ON d.state_key = p.state_key AND d.district_key = p.district_key) x
"""

ADMIN_LONG = f"""
SELECT state AS state_name, {pk('state')} AS state_key, replace(trim(serial), '''', '') AS serial_number,
  trim(regexp_replace(replace(parameter, chr(160), ' '), '\\s+', ' ', 'g')) AS parameter,
  trim(type) AS reporting_type, mon AS month, vt AS value_type, raw_value,
  CASE WHEN NOT unavailable AND regexp_matches(num, '^-?[0-9]+$') THEN TRY_CAST(num AS BIGINT) END AS value,
  coalesce(NOT unavailable AND (CASE WHEN NOT unavailable AND regexp_matches(num, '^-?[0-9]+$') THEN TRY_CAST(num AS BIGINT) END) IS NULL, false) AS is_invalid_numeric,
  'state' AS geo_grain, '2019-20' AS source_period
FROM (SELECT *, coalesce(raw_value IS NULL OR upper(trim(replace(raw_value, chr(160), ' '))) IN ('', 'NA', 'N/A', 'NULL', '-'), false) AS unavailable,
        replace(trim(replace(raw_value, chr(160), ' ')), ',', '') AS num
      FROM v_admin_cells) a
"""

LOWEST_VERDICTS = f"""
SELECT source_state_name, source_state_key, total_facilities, valid_coordinate_facilities, numeric_score, band,
  binding_reason, data_caution
FROM facility_verdicts WHERE {sane('source_state_name')}
ORDER BY numeric_score ASC, source_state_key ASC NULLS LAST LIMIT 8
"""

_PT = ("(CASE WHEN f.has_valid_coordinates THEN CAST(0.45 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)"
       " + (CASE WHEN f.has_pincode THEN CAST(0.20 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)"
       " + (CASE WHEN f.has_capability_text THEN CAST(0.20 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)"
       " + coalesce(v.numeric_score, CAST(0.0 AS DOUBLE)) * CAST(0.15 AS DOUBLE)")

SCORECARD = f"""
SELECT unique_id, name, source_state_name, source_state_key, pincode, latitude, longitude, has_valid_coordinates,
  has_pincode, has_capability_text, care_substance_missing_count,
  {rd('least(CAST(1.0 AS DOUBLE), s)', 2)} AS numeric_score, {band('s')} AS band,
  CASE WHEN NOT has_valid_coordinates THEN 'Location: missing or invalid facility coordinates constrain trust'
       WHEN NOT has_pincode THEN 'Location: missing PIN code constrains geography reconciliation'
       WHEN NOT has_capability_text THEN 'Completeness: missing capability text constrains facility profiling'
       ELSE 'Facility profile is usable, but district polygon assignment is still pending' END AS binding_reason,
  data_caution
FROM (
  SELECT f.*, {_PT} AS s,
    coalesce(v.data_caution, 'state_rollup_before_district_polygon_assignment') AS data_caution,
    CASE WHEN contains(lower(f.name), '#00000001') THEN 0 ELSE 1 END AS pin
  FROM facility_geo f LEFT JOIN facility_verdicts v ON f.source_state_key = v.source_state_key
  WHERE f.name IS NOT NULL AND {sane('f.source_state_name')}
  ORDER BY pin, f.name, f.unique_id LIMIT 5000) x
"""

SCORECARD_PAGE = "ORDER BY pin, f.name, f.unique_id LIMIT 5000"
SCORECARD_ALL = SCORECARD.replace(SCORECARD_PAGE, "")

_DISTRICT_COLUMNS = ("state_name", "district_name", "women_anaemia_percent", "child_stunting_percent", "health_insurance_percent",
                     "institutional_delivery_percent", "caesarean_public_percent", "indicator_cell_count",
                     "suppressed_indicator_count", "low_sample_estimate_count", "missing_value_count", "unparsed_value_count",
                     *INDICATORS)

ENRICH = f"""
SELECT l.*, {', '.join(f'd.{c} AS survey_{c}' for c in _DISTRICT_COLUMNS)},
  CASE WHEN l.is_geography_ambiguous THEN 'ambiguous_code_geography'
       WHEN l.representative_district_key IS NULL THEN 'no_representative_district'
       WHEN d.district_name IS NULL THEN 'unmatched_survey_district' ELSE 'matched' END AS match_status
FROM lookup l LEFT JOIN survey_districts d
  ON l.representative_state_key = d.state_key AND l.representative_district_key = d.district_key
"""

AMBIGUOUS_QUEUE = """
SELECT pincode, post_office_count, district_count, state_count, district_names, state_names, match_status
FROM enrich WHERE match_status = 'ambiguous_code_geography'
ORDER BY district_count DESC, state_count DESC, post_office_count DESC, pincode LIMIT 50
"""

MATCH_DISTRIBUTION = "SELECT match_status, count(*) AS pincode_count FROM enrich GROUP BY match_status"

UNMATCHED = """
SELECT l.* FROM lookup l
WHERE NOT l.is_geography_ambiguous AND l.representative_district_key IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM survey_districts d
                  WHERE d.state_key = l.representative_state_key AND d.district_key = l.representative_district_key)
"""

_NEED_COLS = ("state_name, district_name, state_key, district_key, demand_side_need_score, health_insurance_percent, "
              "institutional_delivery_percent, women_anaemia_percent, child_stunting_percent, post_office_count, "
              "missing_metric_count, data_caution")

TOP_NEED = f"SELECT {_NEED_COLS} FROM need ORDER BY demand_side_need_score DESC, state_key, district_key LIMIT 25"

MOST_FLAGGED = """
SELECT state_name, district_name, state_key, district_key, suppressed_indicator_count, low_sample_estimate_count,
  pincode_count, post_office_count
FROM need ORDER BY suppressed_indicator_count DESC, low_sample_estimate_count DESC, state_key, district_key LIMIT 25
"""

ADMIN_TOTALS = """
SELECT state_name, state_key, serial_number, indicator_name, parameter, value, geo_grain, source_period FROM (
  SELECT *, CASE serial_number WHEN '1.1' THEN 'anc_registered' WHEN '1.2.7' THEN 'anc_four_plus'
    WHEN '2.2' THEN 'institutional_deliveries' WHEN '4.1.1.a' THEN 'live_birth_male'
    WHEN '4.1.1.b' THEN 'live_birth_female' WHEN '9.2.4.a' THEN 'fully_immunized_male'
    WHEN '9.2.4.b' THEN 'fully_immunized_female' END AS indicator_name
  FROM admin_long WHERE month = 'Total' AND value_type = 'Total') t
WHERE indicator_name IS NOT NULL AND reporting_type = 'TOTAL'
"""

_IND = ("anc_registered", "anc_four_plus", "institutional_deliveries", "live_birth_male", "live_birth_female",
        "fully_immunized_male", "fully_immunized_female")

STATE_SUMMARY = f"""
SELECT state_key, state_name, {', '.join(_IND)},
  coalesce(live_birth_male, 0) + coalesce(live_birth_female, 0) AS live_births,
  coalesce(fully_immunized_male, 0) + coalesce(fully_immunized_female, 0) AS fully_immunized_children,
  {rd('CASE WHEN anc_registered > 0 THEN anc_four_plus / anc_registered * 100.0 END')} AS anc_four_plus_rate_percent,
  {rd('CASE WHEN coalesce(live_birth_male, 0) + coalesce(live_birth_female, 0) > 0 THEN institutional_deliveries / (coalesce(live_birth_male, 0) + coalesce(live_birth_female, 0)) * 100.0 END')} AS institutional_delivery_to_live_birth_ratio_percent,
  {rd('CASE WHEN coalesce(live_birth_male, 0) + coalesce(live_birth_female, 0) > 0 THEN (coalesce(fully_immunized_male, 0) + coalesce(fully_immunized_female, 0)) / (coalesce(live_birth_male, 0) + coalesce(live_birth_female, 0)) * 100.0 END')} AS fully_immunized_to_live_birth_ratio_percent,
  'anc_four_plus / anc_registered * 100' AS anc_four_plus_rate_formula,
  'institutional_deliveries / (live_birth_male + live_birth_female) * 100' AS institutional_delivery_ratio_formula,
  '(fully_immunized_male + fully_immunized_female) / (live_birth_male + live_birth_female) * 100'
    AS fully_immunized_ratio_formula,
  'state' AS geo_grain, 'state_grain_admin_fallback_not_district_reconciliation' AS data_caution
FROM (SELECT state_key, min(state_name) AS state_name,
        {', '.join(f"max(CASE WHEN indicator_name = '{i}' THEN value END) AS {i}" for i in _IND)}
      FROM admin_totals GROUP BY state_key) w
"""

STATE_PAGE = """
SELECT state_name, anc_four_plus_rate_percent, institutional_delivery_to_live_birth_ratio_percent,
  fully_immunized_to_live_birth_ratio_percent, data_caution
FROM state_summary ORDER BY state_name, state_key LIMIT 8
"""
