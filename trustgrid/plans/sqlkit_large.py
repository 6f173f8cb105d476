"""DuckDB oracle SQL for the queries over the large input tables."""

from __future__ import annotations

from trustgrid.operators.corroborate import THRESHOLDS
from trustgrid.operators.geo import DISTRICT_POLYGONS
from trustgrid.operators.provenance import COUNT_PATTERNS, FLAG_PATTERNS
from trustgrid.plans.sqlkit import band, cap, pk, rd

D = "CAST({} AS DOUBLE)".format


def initcap(b: str) -> str:
    return f"(upper(substr({b}, 1, 1)) || substr({b}, 2))"


CUST_DIMS = f"""
SELECT c_custkey, c_nationkey, CAST(coalesce(n_orders, 0) + 1 AS BIGINT) AS population,
  least({D('1.0')}, greatest({D('0.0')}, (c_acctbal + {D('1000.0')}) / {D('11000.0')})) AS s0,
  least({D('1.0')}, {D('n_orders')} / {D('20.0')}) AS s1,
  {D('n_orders')} / {D('20.0')} AS s1_raw,
  {D('n_recent')} / n_orders AS s2, {D('n_specified')} / n_orders AS s3,
  coalesce(n_orders < 5, true) AS thin
FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) AS n_orders, count_if(o_orderdate >= TIMESTAMP '2000-01-01') AS n_recent,
    count_if(o_orderpriority <> '4-NOT SPECIFIED') AS n_specified
  FROM orders GROUP BY o_custkey) oa ON c_custkey = o_custkey
"""

_NAMES = ("account_standing", "activity", "recency", "priority_specified")
_MEAN = f"(c0 * {D('1.0')} + c1 * {D('1.0')} + c2 * {D('2.0')} + c3 * {D('0.5')}) / {D('4.5')}"
_BIND = ("CASE WHEN c0 = ws THEN 'account_standing' WHEN c1 = ws THEN 'activity' "
         "WHEN c2 = ws THEN 'recency' ELSE 'priority_specified' END")

CUST_VERDICTS = f"""
SELECT c_custkey, c_nationkey, {rd('s0', 4)} AS account_standing_score, {rd('s1', 4)} AS activity_score,
  {rd('s2', 4)} AS recency_score, {rd('s3', 4)} AS priority_specified_score,
  {rd('mean', 4)} AS numeric_score, {band('mean')} AS band_by_mean, {rd('ws', 4)} AS weakest_score,
  bd AS binding_dimension, any_low AS any_low_confidence, b AS band,
  {initcap('b')} || ' - ' || bd || ': binding trust constraint' AS reason
FROM (
  SELECT *, CASE WHEN any_low THEN {cap(cap(band('mean'), band('ws')), "'amber'")}
                 ELSE {cap(band('mean'), band('ws'))} END AS b
  FROM (SELECT *, {_MEAN} AS mean, least(c0, c1, c2, c3) AS ws, {_BIND} AS bd,
          s0 IS NULL OR s1 IS NULL OR thin OR s2 IS NULL OR s3 IS NULL AS any_low
        FROM (SELECT *, coalesce(s0, {D('0.0')}) AS c0, coalesce(s1, {D('0.0')}) AS c1,
                coalesce(s2, {D('0.0')}) AS c2, coalesce(s3, {D('0.0')}) AS c3 FROM cust_dims) a) b) c
"""


def cust_long(fill: bool = True, clamp: bool = True) -> str:
    def sc(i, col):
        return f"coalesce({col}, {D('0.0')})" if fill else col
    s1 = "s1" if clamp else "s1_raw"
    rows = [
        ("account_standing", 0, "s0", "1.0", "s0 IS NULL", "false"),
        ("activity", 1, s1, "1.0", f"{s1} IS NULL", "false"),
        ("recency", 2, "s2", "2.0", "thin OR s2 IS NULL", "false"),
        ("priority_specified", 3, "s3", "0.5", "thin OR s3 IS NULL", "true"),
    ]
    return "\nUNION ALL\n".join(
        f"SELECT c_custkey, population, '{n}' AS dimension, CAST({o} AS INTEGER) AS ordinal, {sc(o, c)} AS score, "
        f"{D(w)} AS weight, coalesce({low}, false) AS low_confidence, {c} IS NULL AS is_missing, {weak} AS weak_signal "
        f"FROM cust_dims" for n, o, c, w, low, weak in rows)


CUST_LONG_VERDICT = f"""
SELECT c_custkey, {rd('sw / w', 4)} AS numeric_score, {band('sw / w')} AS band_by_mean, {rd('ws', 4)} AS weakest_score,
  bd AS binding_dimension, any_low AS any_low_confidence, n AS dimension_count, b AS band,
  {initcap('b')} || ' - ' || bd || ': binding trust constraint' AS reason
FROM (
  SELECT *, CASE WHEN any_low OR only_weak THEN {cap(cap(band('sw / w'), band('ws')), "'amber'")}
                 ELSE {cap(band('sw / w'), band('ws'))} END AS b
  FROM (SELECT c_custkey, sum(score * weight) AS sw, sum(weight) AS w, bool_or(low_confidence) AS any_low,
          bool_and(weak_signal) AS only_weak, count(*) AS n, min(score) AS ws,
          max(CASE WHEN rn = 1 THEN dimension END) AS bd,
          count_if(NOT coalesce(score BETWEEN 0.0 AND 1.0, false)) AS bad
        FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY score, ordinal) AS rn FROM cust_long) x
        GROUP BY c_custkey) y
  WHERE bad = 0) z
"""

CUST_REJECTS = """
SELECT c_custkey, dimension, score,
  CASE WHEN score IS NULL THEN 'missing_score' ELSE 'score_out_of_range' END AS reject_reason
FROM cust_long_raw WHERE NOT coalesce(score BETWEEN 0.0 AND 1.0, false)
"""

_PRIO = (f"((1.0 - score) * weight / sum(weight) OVER (PARTITION BY c_custkey)) * {D('population')} "
         f"* (CASE WHEN is_missing AND weight >= 1.0 THEN {D('1.5')} ELSE {D('1.0')} END)")

FIX_RANKING = f"""
SELECT c_custkey, dimension, ordinal, {rd('score')} AS score, weight, is_missing, {rd('lift')} AS score_lift,
  {rd(D('population'))} AS impact, {rd('prio')} AS priority,
  CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY prio DESC, ordinal) AS INTEGER) AS fix_rank
FROM (SELECT *, (1.0 - score) * weight / sum(weight) OVER (PARTITION BY c_custkey) AS lift, {_PRIO} AS prio
      FROM cust_long WHERE coalesce(score BETWEEN 0.0 AND 1.0, false)) r
WHERE score < 1.0
"""


def _verdict_parts(sw: str, ws: str, low: str) -> tuple[str, str]:
    mean = f"({sw} / w)"
    b = f"(CASE WHEN {low} THEN {cap(cap(band(mean), band(ws)), chr(39) + 'amber' + chr(39))} ELSE {cap(band(mean), band(ws))} END)"
    return mean, b


_M0, _B0 = _verdict_parts("sw0", "ws0", "l0")
_M1, _B1 = _verdict_parts("sw1", "ws1", "l1")

BEFORE_AFTER = f"""
SELECT c_custkey, fixed_dimension, {rd(_M0, 4)} AS score_before, {_B0} AS band_before, bd0 AS binding_before,
  {rd(_M1, 4)} AS score_after, {_B1} AS band_after,
  {initcap(_B1)} || ' - ' || bd1 || ': binding trust constraint' AS reason_after,
  {rd(f'{_M1} - {_M0}', 4)} AS score_delta
FROM (
  SELECT c_custkey, sum(score * weight) AS sw0, sum(score1 * weight) AS sw1, sum(weight) AS w,
    min(score) AS ws0, min(score1) AS ws1, bool_or(low_confidence) AS l0, bool_or(low1) AS l1,
    max(CASE WHEN is_fix THEN dimension END) AS fixed_dimension,
    max(CASE WHEN rn0 = 1 THEN dimension END) AS bd0, max(CASE WHEN rn1 = 1 THEN dimension END) AS bd1
  FROM (
    SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY score, ordinal) AS rn0,
      row_number() OVER (PARTITION BY c_custkey ORDER BY score1, ordinal) AS rn1
    FROM (SELECT *, CASE WHEN is_fix THEN {D('1.0')} ELSE score END AS score1,
            CASE WHEN is_fix THEN false ELSE low_confidence END AS low1
          FROM (SELECT *, coalesce(row_number() OVER (PARTITION BY c_custkey ORDER BY prio DESC NULLS LAST, ordinal) = 1
                  AND prio IS NOT NULL, false) AS is_fix
                FROM (SELECT *, CASE WHEN score < 1.0 THEN {_PRIO} END AS prio
                      FROM cust_long WHERE coalesce(score BETWEEN 0.0 AND 1.0, false)) p) q) r) s
  GROUP BY c_custkey) t
"""

NATION_EST = """
SELECT n_nationkey, n_name, n_orders, n_of, n_ou, n_os, n_lines, n_lf, n_lr, n_ld FROM (
  SELECT c_nationkey, count(*) AS n_orders, count_if(o_orderstatus = 'F') AS n_of,
    count_if(o_orderpriority IN ('1-URGENT', '2-HIGH')) AS n_ou, count_if(o_orderpriority <> '4-NOT SPECIFIED') AS n_os,
    sum(n_lines) AS n_lines, sum(n_lf) AS n_lf, sum(n_lr) AS n_lr, sum(n_ld) AS n_ld
  FROM orders LEFT JOIN (
    SELECT l_orderkey, count(*) AS n_lines, count_if(l_linestatus = 'F') AS n_lf, count_if(l_returnflag = 'R') AS n_lr,
      count_if(l_discount >= 0.05) AS n_ld FROM lineitem GROUP BY l_orderkey) lo ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey) a JOIN nation ON c_nationkey = n_nationkey
"""


def _pct(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN {D(a)} * {D('100.0')} / {D(b)} END"


_PAIRS = "\nUNION ALL\n".join(
    f"SELECT n_nationkey, n_name, '{ind}' AS indicator, {_pct(a1, a2)} AS source_a, {_pct(b1, b2)} AS source_b FROM nation_est"
    for ind, a1, a2, b1, b2 in (
        ("institutional_delivery", "n_of", "n_orders", "n_lf", "n_lines"),
        ("full_immunization", "n_ou", "n_orders", "n_lr", "n_lines"),
        ("anc_4_plus", "n_os", "n_orders", "n_ld", "n_lines"),
        ("anaemia", "n_ou", "n_orders", "n_ld", "n_lines"),
    ))

_TH = ", ".join(f"('{i}', {D(g)}, {D(r)})" for i, g, r in THRESHOLDS)

CORR_RAW = f"""
SELECT n_nationkey, n_name, indicator, source_a, source_b, abs(source_a - source_b) AS gap,
  green_gap_points, red_gap_points,
  CASE WHEN abs(source_a - source_b) < green_gap_points THEN 'green'
       WHEN abs(source_a - source_b) > red_gap_points THEN 'red'
       WHEN abs(source_a - source_b) IS NOT NULL THEN 'amber' END AS band
FROM ({_PAIRS}) p JOIN (VALUES {_TH}) AS th(indicator, green_gap_points, red_gap_points) USING (indicator)
WHERE indicator NOT IN ('anaemia', 'c_section')
"""

CORROBORATION = f"""
SELECT n_nationkey, n_name, indicator, {rd('source_a')} AS source_a_percent, {rd('source_b')} AS source_b_percent,
  {rd('gap')} AS gap_points, green_gap_points, red_gap_points, band
FROM corr_raw
"""


def long_verdict(table: str, keys: str) -> str:
    """Generic SCR-1 over a long dimension table, keyed by ``keys``."""
    return f"""
SELECT {keys}, {rd('sw / w', 4)} AS numeric_score, {band('sw / w')} AS band_by_mean, {rd('ws', 4)} AS weakest_score,
  bd AS binding_dimension, any_low AS any_low_confidence, n AS dimension_count, b AS band,
  {initcap('b')} || ' - ' || bd || ': binding trust constraint' AS reason
FROM (
  SELECT *, CASE WHEN any_low OR only_weak THEN {cap(cap(band('sw / w'), band('ws')), "'amber'")}
                 ELSE {cap(band('sw / w'), band('ws'))} END AS b
  FROM (SELECT {keys}, sum(score * weight) AS sw, sum(weight) AS w, bool_or(low_confidence) AS any_low,
          bool_and(weak_signal) AS only_weak, count(*) AS n, min(score) AS ws,
          max(CASE WHEN rn = 1 THEN dimension END) AS bd,
          count_if(NOT coalesce(score BETWEEN 0.0 AND 1.0, false)) AS bad
        FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score, ordinal) AS rn FROM {table}) x
        GROUP BY {keys}) y
  WHERE bad = 0) z
"""


NATION_DIMS = f"""
SELECT n_nationkey, indicator AS dimension,
  CASE indicator WHEN 'institutional_delivery' THEN 0 WHEN 'full_immunization' THEN 1 WHEN 'anc_4_plus' THEN 2 END AS ordinal,
  coalesce(greatest({D('0.0')}, 1.0 - gap / (2.0 * red_gap_points)), {D('0.0')}) AS score, {D('1.0')} AS weight,
  coalesce(band <> 'green', true) AS low_confidence, gap IS NULL AS is_missing, false AS weak_signal
FROM corr_raw
UNION ALL
SELECT n_nationkey, 'state_anchor' AS dimension, 3 AS ordinal,
  coalesce({D('n_of')} / n_orders, {D('0.0')}) AS score, {D('0.5')} AS weight, false AS low_confidence,
  false AS is_missing, true AS weak_signal
FROM nation_est
"""

DOC_COMPLETENESS = f"""
SELECT lang, source, total_docs, labelled_docs, quality_docs, toxic_docs, {rd(f"{D('chars')} / total_docs")} AS avg_chars,
  {rd('cov')} AS label_coverage_score, {rd('clean')} AS cleanliness_score,
  {rd(f"(c0 * {D('1.0')} + c1 * {D('1.0')}) / {D('2.0')}")} AS numeric_score,
  {band(f"(c0 * {D('1.0')} + c1 * {D('1.0')}) / {D('2.0')}")} AS band_by_mean,
  {rd('least(c0, c1)')} AS weakest_score,
  CASE WHEN c0 = least(c0, c1) THEN 'label_coverage' ELSE 'cleanliness' END AS binding_dimension,
  any_low AS any_low_confidence, b AS band,
  {initcap('b')} || ' - ' || (CASE WHEN c0 = least(c0, c1) THEN 'label_coverage' ELSE 'cleanliness' END)
    || ': binding trust constraint' AS reason
FROM (
  SELECT *, CASE WHEN any_low THEN {cap(cap(band(f"(c0 * {D('1.0')} + c1 * {D('1.0')}) / {D('2.0')}"), band('least(c0, c1)')), "'amber'")}
                 ELSE {cap(band(f"(c0 * {D('1.0')} + c1 * {D('1.0')}) / {D('2.0')}"), band('least(c0, c1)'))} END AS b
  FROM (SELECT *, coalesce(cov, {D('0.0')}) AS c0, coalesce(clean, {D('0.0')}) AS c1,
          cov IS NULL OR coalesce(labelled_docs < 5, false) OR clean IS NULL AS any_low
        FROM (SELECT *, {D('labelled_docs')} / total_docs AS cov,
                CASE WHEN labelled_docs > 0 THEN 1.0 - {D('toxic_docs')} / labelled_docs END AS clean
              FROM (SELECT lang, source, count(*) AS total_docs, count(label_rows) AS labelled_docs,
                      CAST(count_if(coalesce(quality = 1, false)) AS BIGINT) AS quality_docs, CAST(count_if(coalesce(toxic = 1, false)) AS BIGINT) AS toxic_docs,
                      sum(n_chars) AS chars
                    FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic,
                      count(*) AS label_rows FROM labels GROUP BY doc_id) lb USING (doc_id)
                    GROUP BY lang, source) a) b) c) d
"""


def _rule(ds, name, sev, obs, comp="eq", th=0.0):
    return (f"SELECT '{ds}' AS dataset, '{name}' AS check_name, '{sev}' AS severity, CAST({obs} AS DOUBLE) AS observed_value, "
            f"'{comp}' AS comparator, {D(th)} AS threshold FROM {ds}")


def _cw(cond):
    return f"count_if(coalesce({cond}, true))"


def _sw(cond):
    return f"CAST(count_if(coalesce({cond}, false)) AS DOUBLE) / count(*)"


CONTRACTS = "SELECT *, CASE WHEN coalesce(CASE comparator WHEN 'eq' THEN observed_value = threshold " \
    "WHEN 'le' THEN observed_value <= threshold ELSE observed_value >= threshold END, false) THEN 'pass' " \
    "ELSE severity END AS status FROM (\n" + "\nUNION ALL\n".join([
        _rule("orders", "orders_key_unique", "fail", "count(*) - count(DISTINCT o_orderkey)"),
        _rule("orders", "orders_totalprice_positive", "fail", _cw("o_totalprice <= 0")),
        _rule("orders", "orders_status_in_domain", "fail", _cw("o_orderstatus NOT IN ('F', 'O', 'P')")),
        _rule("orders", "orders_priority_specified_share", "warn", _sw("o_orderpriority <> '4-NOT SPECIFIED'"), "ge", 0.9),
        _rule("lineitem", "lineitem_discount_in_range", "fail", _cw("NOT (l_discount BETWEEN 0.0 AND 0.1)")),
        _rule("lineitem", "lineitem_quantity_positive", "fail", _cw("l_quantity <= 0")),
        _rule("lineitem", "lineitem_line_key_unique", "fail", "count(*) - count(DISTINCT (l_orderkey, l_linenumber))"),
        _rule("customer", "customer_key_unique", "fail", "count(*) - count(DISTINCT c_custkey)"),
        _rule("customer", "customer_negative_balance_share", "warn", _sw("c_acctbal < 0"), "le", 0.05),
        _rule("events", "events_props_json_parse_rate", "warn", _sw("json_extract_string(props, '$.k') IS NOT NULL"), "ge", 0.99),
        _rule("events", "events_type_in_domain", "fail",
              _cw("event_type NOT IN ('click', 'error', 'purchase', 'signup', 'view')")),
        _rule("documents", "documents_length_matches_text", "warn", _cw("n_chars <> length(text)")),
        _rule("documents", "documents_lang_in_domain", "warn", _cw("lang NOT IN ('de', 'en', 'es', 'fr')")),
        _rule("labels", "labels_are_binary", "fail", _cw("quality NOT IN (0, 1) OR toxic NOT IN (0, 1)")),
        _rule("labels", "labels_one_row_per_doc", "fail", "count(*) - count(DISTINCT doc_id)"),
        "SELECT 'lineitem_without_order' AS dataset, 'lineitem_order_exists' AS check_name, 'fail' AS severity, "
        "CAST(count(*) AS DOUBLE) AS observed_value, 'eq' AS comparator, CAST(0.0 AS DOUBLE) AS threshold "
        "FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)",
        "SELECT 'orders_without_customer' AS dataset, 'orders_customer_exists' AS check_name, 'fail' AS severity, "
        "CAST(count(*) AS DOUBLE) AS observed_value, 'eq' AS comparator, CAST(0.0 AS DOUBLE) AS threshold "
        "FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)",
    ]) + "\n) r"

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
               "embeddings", "pages", "benchmark", "labels", "conversations")

ROW_COUNTS = "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLE_NAMES)

PREFLIGHT = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS source_name, 'present' AS status, count(*) AS row_count FROM {t}" for t in TABLE_NAMES)

COVERAGE = f"""
WITH s AS (
  SELECT c_nationkey AS nation_key, CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS INTEGER) AS month_index,
    count(*) AS order_count
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
f AS (SELECT *, regr_slope({D('order_count')}, {D('month_index')}) OVER (PARTITION BY nation_key) AS slope,
        regr_intercept({D('order_count')}, {D('month_index')}) OVER (PARTITION BY nation_key) AS icpt FROM s),
g AS (SELECT *, icpt + slope * month_index AS pred, order_count - (icpt + slope * month_index) AS resid FROM f),
h AS (SELECT *, stddev_samp(resid) OVER (PARTITION BY nation_key) AS sd FROM g)
SELECT nation_key, month_index, order_count, {rd('slope')} AS trend_slope, {rd('icpt')} AS trend_intercept,
  {rd('pred')} AS predicted, {rd('resid')} AS residual, coalesce(abs(resid) > {D('2.0')} * sd, false) AS is_anomaly
FROM h
"""


def _edges_values() -> str:
    rows = []
    for did, name, rings in DISTRICT_POLYGONS:
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
                if y1 != y2:
                    rows.append(f"({did}, '{name}', {D(x1)}, {D(y1)}, {D(x2)}, {D(y2)})")
    return ", ".join(rows)


PIP_HITS = f"""
SELECT unique_id, district_id, district_name FROM (
  SELECT f.unique_id, e.district_id, e.district_name,
    count_if(((e.y1 > f.latitude) <> (e.y2 > f.latitude))
             AND f.longitude < (e.x2 - e.x1) * (f.latitude - e.y1) / (e.y2 - e.y1) + e.x1) AS c
  FROM facility_geo f CROSS JOIN (VALUES {_edges_values()}) AS e(district_id, district_name, x1, y1, x2, y2)
  WHERE f.has_valid_coordinates
  GROUP BY 1, 2, 3) x
WHERE c % 2 = 1
"""

PIP = """
SELECT unique_id, CAST(min(district_id) AS INTEGER) AS district_id, arg_min(district_name, district_id) AS district_name,
  count(*) AS district_hits
FROM pip_hits GROUP BY unique_id
"""

_PLACED = f"""
SELECT f.unique_id, f.has_valid_coordinates AS ok, {pk('p.district_name')} AS polygon_district,
  {pk('s.stated_district')} AS stated_district, CASE WHEN s.is_verified THEN {pk('s.stated_district')} END AS verified_district,
  l.representative_district_key AS code_district
FROM facility_geo f LEFT JOIN pip p ON f.unique_id = p.unique_id LEFT JOIN v_facility_stated s ON f.unique_id = s.unique_id
LEFT JOIN lookup l ON f.pincode = l.pincode
"""

GEO_RESOLUTION = f"""
SELECT unique_id, polygon_district, verified_district, code_district, resolved_district, resolution_method, has_geography_conflict,
  CASE WHEN NOT ok OR resolved_district IS NULL THEN 'red'
       WHEN polygon_district IS NOT NULL AND NOT has_geography_conflict THEN 'green' ELSE 'amber' END AS resolution_band
FROM (
  SELECT *, coalesce(polygon_district, verified_district, code_district) AS resolved_district,
    CASE WHEN polygon_district IS NOT NULL THEN 'polygon' WHEN verified_district IS NOT NULL THEN 'verified_field'
         WHEN code_district IS NOT NULL THEN 'code_lookup' ELSE 'manual_review' END AS resolution_method,
    coalesce(polygon_district <> code_district, false) OR coalesce(polygon_district <> verified_district, false)
      AS has_geography_conflict
  FROM ({_PLACED}) a) b
"""

GEO_CONFLICTS = f"""
SELECT unique_id, ok AS has_valid_coordinates, polygon_district, stated_district, agreement, agreement = 'conflict' AS stated_conflict,
  CASE agreement WHEN 'unresolved' THEN 'red' WHEN 'agrees' THEN 'green' ELSE 'amber' END AS location_band,
  CASE agreement WHEN 'conflict' THEN 'correct stated district' WHEN 'unresolved' THEN 'acquire valid coordinates'
    WHEN 'outside_boundaries' THEN 'review coordinates outside of all district boundaries' END AS location_fix
FROM (SELECT *, CASE WHEN NOT ok THEN 'unresolved' WHEN polygon_district IS NULL THEN 'outside_boundaries'
        WHEN stated_district IS NULL THEN 'not_stated' WHEN polygon_district = stated_district THEN 'agrees'
        ELSE 'conflict' END AS agreement FROM ({_PLACED}) a) b
"""


def _count(text: str, pat: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({text}, '{pat}', 1), '') AS BIGINT)"


def _flag(text: str, pat: str) -> str:
    return f"coalesce(regexp_matches({text}, '{pat}'), false)"


CAPABILITIES = f"""
SELECT doc_id, beds, doctors, emergency_24_7, nicu, accreditation, n AS extracted_fact_count,
  CASE WHEN n > 0 THEN {D('0.6')} ELSE {D('0.0')} END AS provenance_confidence,
  CASE WHEN n > 0 THEN 'extracted' ELSE 'absent' END AS provenance
FROM (SELECT *, (CASE WHEN beds IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN doctors IS NOT NULL THEN 1 ELSE 0 END)
        + (CASE WHEN emergency_24_7 THEN 1 ELSE 0 END) + (CASE WHEN nicu THEN 1 ELSE 0 END)
        + (CASE WHEN accreditation THEN 1 ELSE 0 END) AS n
      FROM (SELECT doc_id, {_count('text', COUNT_PATTERNS['beds'])} AS beds, {_count('text', COUNT_PATTERNS['doctors'])} AS doctors,
              {_flag('text', FLAG_PATTERNS['emergency_24_7'])} AS emergency_24_7, {_flag('text', FLAG_PATTERNS['nicu'])} AS nicu,
              {_flag('text', FLAG_PATTERNS['accreditation'])} AS accreditation
            FROM documents) a) b
"""


FACILITY_PROVENANCE = f"""
SELECT unique_id,
  CASE WHEN sd THEN 'structured' WHEN ed THEN 'extracted' ELSE 'absent' END AS doctors_provenance,
  CASE WHEN sd THEN {D('1.0')} WHEN ed THEN {D('0.6')} ELSE {D('0.0')} END AS doctors_confidence,
  CASE WHEN sc THEN 'structured' WHEN ec THEN 'extracted' ELSE 'absent' END AS capacity_provenance,
  CASE WHEN sc THEN {D('1.0')} WHEN ec THEN {D('0.6')} ELSE {D('0.0')} END AS capacity_confidence,
  {rd(f"((CASE WHEN sd THEN {D('1.0')} WHEN ed THEN {D('0.6')} ELSE {D('0.0')} END) + (CASE WHEN sc THEN {D('1.0')} WHEN ec THEN {D('0.6')} ELSE {D('0.0')} END)) / {D('2.0')}")} AS provenance_confidence
FROM (SELECT unique_id,
        NOT coalesce(doctors IS NULL OR lower(trim(doctors)) IN ('', 'null'), false) AS sd,
        coalesce({_count('capability', COUNT_PATTERNS['doctors'])} IS NOT NULL, false) AS ed,
        NOT coalesce(capacity IS NULL OR lower(trim(capacity)) IN ('', 'null'), false) AS sc,
        coalesce({_count('capability', COUNT_PATTERNS['beds'])} IS NOT NULL, false) AS ec
      FROM v_facilities) a
"""

FIX_VALUES = ", ".join(f"('{t}', {lift})" for t, lift in (
    ("Reconcile facility geography with source coordinates", 10),
    ("Assign district with boundary polygons", 7),
    ("Complete missing facility profile fields", 5)))

SIMULATED_FIXES = f"""
SELECT unique_id, fix_title, lift_points, score_points_before, {band(f"score_points_before / {D('100.0')}")} AS band_before,
  score_points_after, {band(f"score_points_after / {D('100.0')}")} AS band_after
FROM (SELECT s.unique_id, f.fix_title, f.lift_points, CAST(round(s.numeric_score * 100) AS INTEGER) AS score_points_before,
        least(100, greatest(0, CAST(round(s.numeric_score * 100) AS INTEGER) + f.lift_points)) AS score_points_after
      FROM scorecard s CROSS JOIN (VALUES {FIX_VALUES}) AS f(fix_title, lift_points)) x
"""


def search_sql(q: str) -> str:
    q = q.strip().lower()
    return (f"SELECT * FROM scorecard WHERE coalesce(contains(lower(name), '{q}'), false) "
            f"OR coalesce(contains(lower(source_state_name), '{q}'), false) OR coalesce(contains(lower(pincode), '{q}'), false)")


KEEP_LIST = "SELECT * FROM v_offices WHERE upper(trim(coalesce(statename, district))) IN ('AFRICA', 'ASIA', 'EUROPE')"
