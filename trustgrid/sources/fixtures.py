"""Source-shaped views derived from the input tables.

Each view is one SQL text that runs unchanged on Spark and on DuckDB, so a
Spark plan and an independent SQL oracle read the very same rows. All views
read whole tables (no id subsets); the ones keyed by ``customer``, ``part`` or
``orders`` grow with the scale factor.

``v_offices``       post-office grain directory (code over several districts,
                    ``NA`` coordinates, padded / broken codes)
``v_facilities``    facility points (``null`` text, JSON in the state field,
                    out-of-range coordinates, missing codes)
``v_facility_stated``  the district each facility states, verified or not
                    (spellings, other districts, none)
``v_survey_cells``  district x indicator survey cells, some indicators
                    outside the metric registry (``*``, ``(29.5)``,
                    blanks, ``1,234``, ``n/a``, ``29-30``, ``.5``)
``v_admin_cells``   state x serial x month x value-type counts aggregated from
                    orders (``NA``, invalid text, NBSP, commas, 20 digits)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgrid.sources.tables import read_table, register_tables

# Survey indicator headings as printed in the source file, and
# the snake_case names they normalise to.
SURVEY_INDICATORS = (
    (1, "Women (age 15-49 years) who are anaemic (%)",
     "women_age_15_49_years_who_are_anaemic_percent"),
    (2, "Children under 5 years who are stunted (height-for-age) (%)",
     "children_under_5_years_who_are_stunted_height_for_age_percent"),
    (3, "Households with any usual member covered under a health insurance/financing scheme (%)",
     "households_with_any_usual_member_covered_under_a_health_insurance_financing_scheme_percent"),
    (4, "Institutional births (in the 5 years before the survey) (%)",
     "institutional_births_in_the_5_years_before_the_survey_percent"),
    (5, "Births delivered by caesarean section in a public health facility (%)",
     "births_delivered_by_caesarean_section_in_a_public_health_facility_percent"),
    (6, "Households that use an improved sanitation facility (%)",
     "households_that_use_an_improved_sanitation_facility_percent"),
    (7, "Mothers who had at least 4 antenatal care visits (%)",
     "mothers_who_had_at_least_4_antenatal_care_visits_percent"),
    (8, "Children age 12-23 months fully vaccinated [card or recall] (%)",
     "children_age_12_23_months_fully_vaccinated_card_or_recall_percent"),
)
SURVEY_STATE_HEADING = "State/UT"
SURVEY_DISTRICT_HEADING = "District Names"

# Admin serial numbers (quoted as in the source), parameters,
# months in reporting order with their calendar number, and value types.
ADMIN_SERIALS = (
    ("'1.1'", "Total number of pregnant women registered for ANC", 1),
    ("'1.2.7'", "Number of pregnant women received 4 or more ANC check ups", 2),
    ("'2.2'", "Number of institutional deliveries conducted", 3),
    ("'4.1.1.a'", "Live birth - Male", 4),
    ("'4.1.1.b'", "Live birth - Female", 5),
    ("'9.2.4.a'", "Children fully immunized - Male", 6),
    ("'9.2.4.b'", "Children fully immunized - Female", 7),
    ("'8.8'", "Number of newborns breast fed within 1 hour of birth", 8),
)
ADMIN_MONTHS = (
    ("April", 4), ("May", 5), ("June", 6), ("July", 7), ("August", 8), ("September", 9),
    ("October", 10), ("November", 11), ("December", 12), ("January", 1), ("February", 2),
    ("March", 3), ("Total", 0),
)
ADMIN_VALUE_TYPES = (("Total", 1, "[(A+B) or (C+D)]"), ("Public", 2, "[A]"))


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


V_OFFICES = """
SELECT c_custkey AS office_id,
  CASE WHEN c_custkey % 97 = 0 THEN 'PIN none'
       WHEN p % 19 = 0 THEN CAST(9000 + p AS STRING)
       ELSE CAST(100000 + p AS STRING) END AS pincode,
  CASE WHEN c_custkey < 6 THEN NULL
       WHEN p % 17 = 0 THEN 'Outer Zone ' || CAST(d AS STRING)
       WHEN c_custkey % 3 = 0 THEN 'ZONE ' || CAST(d AS STRING)
       WHEN c_custkey % 3 = 1 THEN '  zone  ' || CAST(d AS STRING) || ' '
       ELSE 'Zoné ' || CAST(d AS STRING) END AS district,
  CASE WHEN c_custkey % 2 = 0 THEN r_name ELSE ' ' || lower(r_name) END AS statename,
  CASE WHEN c_custkey % 5 = 0 THEN 'NA' WHEN c_custkey % 31 = 0 THEN 'bad'
       ELSE CAST(8 + c_custkey % 28 AS STRING) || '.25' END AS latitude,
  CASE WHEN c_custkey % 5 = 0 THEN ' na ' ELSE CAST(70 + c_custkey % 26 AS STRING) || '.5' END AS longitude
FROM (SELECT c_custkey, p, CASE WHEN c_custkey % 21 = 0 THEN (p + 7) % 40 ELSE p % 40 END AS d
      FROM (SELECT c_custkey, CAST(floor(c_custkey / 3) AS BIGINT) AS p FROM customer) a) b
JOIN region ON r_regionkey = d % 5
"""

V_FACILITIES = """
SELECT c_custkey AS unique_id, c_name AS name,
  CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 43 = 0 THEN 'null'
       WHEN c_custkey % 47 = 0 THEN '560001'
       WHEN c_custkey % 53 = 0 THEN '{"type": "Point", "coordinates": [77.5, 12.9]}'
       WHEN c_custkey % 2 = 0 THEN n_name ELSE lower(n_name) || ' ' END AS state_raw,
  CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 6 = 1 THEN '560 ' || CAST(c_custkey AS STRING)
       ELSE 'PIN ' || CAST(100000 + c_custkey AS STRING) END AS zip_raw,
  CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN '0.0'
       ELSE CAST(6 + c_custkey % 32 AS STRING) || '.5' END AS latitude,
  CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE CAST(68 + c_custkey % 30 AS STRING) || '.25' END AS longitude,
  CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN '' ELSE c_mktsegment END AS capability,
  CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE '4' END AS doctors,
  CASE WHEN c_custkey % 5 < 3 THEN NULL ELSE '20' END AS capacity,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '1999' END AS year_raw,
  CASE WHEN c_custkey % 8 < 5 THEN 'null' ELSE '2024' END AS recency
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


V_FACILITY_STATED = """
SELECT c_custkey AS unique_id,
  CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN ' north  range' WHEN c_custkey % 7 = 2 THEN 'North Range'
       WHEN c_custkey % 7 = 3 THEN 'Éast Delta' WHEN c_custkey % 7 = 4 THEN 'TWIN ISLES' WHEN c_custkey % 7 = 5 THEN 'South Plateau'
       ELSE 'Zone ' || CAST(c_custkey % 40 AS STRING) END AS stated_district,
  c_custkey % 3 = 0 AS is_verified
FROM customer
"""


SURVEY_DISTRICT_SQL = "CASE WHEN p_partkey % 4 = 0 THEN 'ZONE  ' ELSE 'Zone ' END || CAST(p_partkey AS STRING)"


# A second source for the surveyed districts: an institutional delivery figure and how many of its reports are located,
# counted from line items; some districts have a row without any figure.
V_DISTRICT_REPORTS = f"""
SELECT r_name AS state, {SURVEY_DISTRICT_SQL} AS district, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE n END AS reports,
  CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE located END AS located, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE
  CAST(((p_partkey * 131 + 1108) % 1000) / 10 AS DOUBLE) + CAST(100 AS DOUBLE) * done / n - CAST(50 AS DOUBLE) END AS delivery_percent
FROM part JOIN region ON r_regionkey = p_partkey % 5
JOIN (SELECT l_partkey, count(*) AS n, sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS located,
        sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS done FROM lineitem GROUP BY l_partkey) l ON l_partkey = p_partkey
"""

# Claims as facilities publish them: JSON lists of mixed items, single texts, objects, broken lists, plain text.
V_FACILITY_CLAIMS = """
SELECT c_custkey AS unique_id,
  CASE WHEN c_custkey % 11 = 0 THEN NULL
       WHEN c_custkey % 11 = 1 THEN '["' || n || ' beds", "3 doctors", {"service": "24/7 emergency"}]'
       WHEN c_custkey % 11 = 2 THEN '["NICU available", ["accredited", "licensed"], 12, null, true]'
       WHEN c_custkey % 11 = 3 THEN 'Open 24x7, a ' || n || ' bedded ward'
       WHEN c_custkey % 11 = 4 THEN '["' || n || ' doctors", '
       WHEN c_custkey % 11 = 5 THEN '{"beds": "' || n || ' beds", "staff": ["7 physicians"]}'
       WHEN c_custkey % 11 = 6 THEN '"neonatal intensive care, round-the-clock"'
       WHEN c_custkey % 11 = 7 THEN '[]'
       WHEN c_custkey % 11 = 8 THEN ''
       WHEN c_custkey % 11 = 9 THEN '["' || n || ' beds", "' || n || ' physicians", "NICU", "24/7", "Accredited", "5 beds"]'
       ELSE '["nothing to say", "beds: ' || n || '"]' END AS claims
FROM (SELECT c_custkey, CAST(c_custkey % 90 + 1 AS STRING) AS n FROM customer) c
"""


def survey_cell_sql(k: int | str) -> str:
    """Raw survey cell for district ``p_partkey`` and indicator ``k``."""
    n = (f"CAST(CAST(floor(((p_partkey * 131 + {k} * 277) % 1000) / 10) AS BIGINT) AS STRING) || '.' || "
         f"CAST((p_partkey * 131 + {k} * 277) % 10 AS STRING)")
    dk = f"(p_partkey + {k})"
    return (f"CASE WHEN {dk} % 9 = 0 THEN '*' WHEN {dk} % 7 = 0 THEN '(' || {n} || ')' "
            f"WHEN {dk} % 11 = 0 THEN NULL WHEN {dk} % 13 = 0 THEN 'n/a' "
            f"WHEN {dk} % 17 = 0 THEN '1,' || {n} WHEN {dk} % 19 = 0 THEN '29-30' "
            f"WHEN {dk} % 23 = 0 THEN '.5' ELSE {n} END")



V_SURVEY_CELLS = f"""
SELECT r_name AS state, {SURVEY_DISTRICT_SQL} AS district, t.indicator, {survey_cell_sql('t.k')} AS raw_value
FROM part JOIN region ON r_regionkey = p_partkey % 5
CROSS JOIN (VALUES {', '.join(f'({k}, {_sql_str(name)})' for k, _, name in SURVEY_INDICATORS)}) AS t(k, indicator)
"""

def _survey_cell_from(k: int) -> str:
    """Cell ``k`` from precomputed number text ``n{k}`` (Spark-side wide view)."""
    dk = f"(p_partkey + {k})"
    n = f"n{k}"
    return (f"CASE WHEN {dk} % 9 = 0 THEN '*' WHEN {dk} % 7 = 0 THEN '(' || {n} || ')' "
            f"WHEN {dk} % 11 = 0 THEN NULL WHEN {dk} % 13 = 0 THEN 'n/a' "
            f"WHEN {dk} % 17 = 0 THEN '1,' || {n} WHEN {dk} % 19 = 0 THEN '29-30' "
            f"WHEN {dk} % 23 = 0 THEN '.5' ELSE {n} END")


def _survey_number(k: int) -> str:
    return (f"CAST(CAST(floor(((p_partkey * 131 + {k} * 277) % 1000) / 10) AS BIGINT) AS STRING) || '.' || "
            f"CAST((p_partkey * 131 + {k} * 277) % 10 AS STRING)")


# The survey as it is published: one row per district, one column per heading
# (same cells as ``v_survey_cells``; each printed number is computed once).
V_SURVEY_WIDE = f"""
SELECT r_name AS `{SURVEY_STATE_HEADING}`, district AS `{SURVEY_DISTRICT_HEADING}`,
  {', '.join(f'{_survey_cell_from(k)} AS `{heading}`' for k, heading, _ in SURVEY_INDICATORS)}
FROM (SELECT p_partkey, {SURVEY_DISTRICT_SQL} AS district,
        {', '.join(f'{_survey_number(k)} AS n{k}' for k, _, _ in SURVEY_INDICATORS)}
      FROM part) p
JOIN region ON r_regionkey = p_partkey % 5
"""

_ADMIN_SERIAL_VALUES = ", ".join(f"({_sql_str(s)}, {_sql_str(p)}, {h})" for s, p, h in ADMIN_SERIALS)
_ADMIN_MONTH_VALUES = ", ".join(f"({_sql_str(m)}, {n})" for m, n in ADMIN_MONTHS)
_ADMIN_VT_VALUES = ", ".join(f"({_sql_str(v)}, {k})" for v, k, _ in ADMIN_VALUE_TYPES)

_ADMIN_AGG = """
oc AS (
  SELECT o_custkey, CAST(o_orderkey % 8 AS INT) + 1 AS h, CAST(month(o_orderdate) AS INT) AS m,
         sum(CAST(floor(o_totalprice) AS BIGINT)) AS amt,
         sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS urgent
  FROM orders GROUP BY o_custkey, CAST(o_orderkey % 8 AS INT) + 1, CAST(month(o_orderdate) AS INT)
),
agg AS (
  SELECT c_nationkey AS nk, h, coalesce(m, 0) AS m, sum(amt) AS amt, sum(urgent) AS urgent
  FROM oc JOIN customer ON o_custkey = c_custkey
  GROUP BY GROUPING SETS ((c_nationkey, h, m), (c_nationkey, h))
)"""

# The constant grid (nation x serial x month x value type). DuckDB spells it
# as joins with VALUES lists; Spark generates the same rows with ``inline``
# (a generator per nation row, no join).
_ADMIN_GRID_DUCKDB = f"""
grid AS (
  SELECT n_nationkey, n_name, s.serial, s.parameter, s.h, mm.mon, mm.m, v.vt, v.vk
  FROM nation
  CROSS JOIN (VALUES {_ADMIN_SERIAL_VALUES}) AS s(serial, parameter, h)
  CROSS JOIN (VALUES {_ADMIN_MONTH_VALUES}) AS mm(mon, m)
  CROSS JOIN (VALUES {_ADMIN_VT_VALUES}) AS v(vt, vk)
)"""


def _structs(rows, names) -> str:
    return "array(" + ", ".join(
        "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in zip(names, r)) + ")" for r in rows) + ")"


_ADMIN_GRID_SPARK = f"""
grid AS (
  SELECT n_nationkey, n_name, serial, parameter, h, mon, m, vt, vk
  FROM nation
  LATERAL VIEW inline({_structs([(_sql_str(a), _sql_str(b), c) for a, b, c in ADMIN_SERIALS], ('serial', 'parameter', 'h'))}) s
  LATERAL VIEW inline({_structs([(_sql_str(a), b) for a, b in ADMIN_MONTHS], ('mon', 'm'))}) mm
  LATERAL VIEW inline({_structs([(_sql_str(a), b) for a, b, _ in ADMIN_VALUE_TYPES], ('vt', 'vk'))}) v
)"""

_ADMIN_TAIL = """,
val AS (
  SELECT g.n_nationkey, g.n_name, g.serial, g.parameter, g.h, g.mon, g.m, g.vt, g.vk,
    CAST(CASE WHEN g.vk = 1 THEN floor(coalesce(a.amt, 0) / 1000) ELSE coalesce(a.urgent, 0) END AS BIGINT) AS v
  FROM grid g LEFT JOIN agg a ON a.nk = g.n_nationkey AND a.h = g.h AND a.m = g.m
)
SELECT n_name AS state, serial, parameter, 'TOTAL' AS type, mon, vt,
  CASE WHEN (n_nationkey + h + m + vk) % 23 = 0 THEN 'NA'
       WHEN (n_nationkey + h + m + vk) % 29 = 0 THEN 'x12'
       WHEN (n_nationkey + h + m + vk) % 37 = 0 THEN '99999999999999999999'
       WHEN (n_nationkey + h + m + vk) % 31 = 0 THEN chr(160) || CAST(v AS STRING)
       WHEN v >= 1000 THEN CAST(CAST(floor(v / 1000) AS BIGINT) AS STRING) || ',' || lpad(CAST(v % 1000 AS STRING), 3, '0')
       ELSE CAST(v AS STRING) END AS raw_value
FROM val
"""

V_ADMIN_CELLS = "WITH " + _ADMIN_AGG + "," + _ADMIN_GRID_DUCKDB + _ADMIN_TAIL
V_ADMIN_CELLS_SPARK = "WITH " + _ADMIN_AGG + "," + _ADMIN_GRID_SPARK + _ADMIN_TAIL

VIEWS = {
    "v_offices": V_OFFICES,
    "v_facilities": V_FACILITIES,
    "v_facility_stated": V_FACILITY_STATED,
    "v_facility_claims": V_FACILITY_CLAIMS,
    "v_district_reports": V_DISTRICT_REPORTS,
    "v_survey_cells": V_SURVEY_CELLS,
    "v_admin_cells": V_ADMIN_CELLS,
}


def admin_heading(mon: str, vt: str) -> str:
    """Printed admin heading; the grand-total column carries NBSPs like the source."""
    bracket = {v: b for v, _, b in ADMIN_VALUE_TYPES}[vt]
    sep = " - " if mon != "Total" else "\u00a0-\u00a0"
    return f"{mon}{sep}{vt} {bracket}"


VIEW_TABLES = {
    "v_offices": ("customer", "region"),
    "v_facilities": ("customer", "nation"),
    "v_facility_stated": ("customer",),
    "v_facility_claims": ("customer",),
    "v_district_reports": ("part", "region", "lineitem"),
    "v_survey_cells": ("part", "region"),
    "v_survey_wide": ("part", "region"),
    "v_admin_cells": ("orders", "customer", "nation"),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame for one fixture view over ``sf_dir``."""
    register_tables(spark, sf_dir, VIEW_TABLES[name])
    spark_text = {"v_survey_wide": V_SURVEY_WIDE, "v_admin_cells": V_ADMIN_CELLS_SPARK}
    return spark.sql(spark_text.get(name) or VIEWS[name])


def _square(x: Column, y: Column, side: int) -> Column:
    corners = ((0, 0), (side, 0), (side, side), (0, side), (0, 0))
    return F.array(*[F.array((x + dx).cast("double"), (y + dy).cast("double")) for dx, dy in corners])


def supplier_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A GeoJSON feature per supplier, one a line (``value``): a square, every third one with a second part; some have no
    name, half have an area object and the others tags (``to_json`` leaves out fields that are null)."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    key = F.col("s_suppkey")
    x, y = key % 50, F.col("s_nationkey") * 3
    properties = F.struct(
        key.alias("id"), F.when(key % 4 != 0, F.col("s_name")).alias("NAME_2"),
        F.when(key % 2 == 0, F.struct(F.lit(4).alias("km2"))).alias("area"),
        F.when(key % 2 != 0, F.array(F.lit("a"), F.lit("1"))).alias("tags"))

    def feature(kind: str, coordinates: Column) -> Column:
        geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
        return F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry")))

    parts = F.array(F.array(_square(x, y, 2)), F.array(_square(x + 4, y, 1)))
    return s.select(F.when(key % 3 == 0, feature("MultiPolygon", parts))
                    .otherwise(feature("Polygon", F.array(_square(x, y, 2)))).alias("value"))
