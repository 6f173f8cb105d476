"""Melt / pivot, join-safe lookup and enrichment: reference cases, T3, T9, T16, invariants."""

import pytest
from pyspark.sql import functions as F

from trustgrid.functions.schema import resolve_roles
from trustgrid.operators import lookup as lk
from trustgrid.operators.reshape import melt, pivot_fixed
from trustgrid.plans import catalog, silver
from trustgrid.sources.io import stamp_ingest

SF = "/root/testdata/sf0.001"


def test_admin_one_row_three_measures(spark):
    cols = ["State", "S.No.", "Parameters", "Type", "April - Total [(A+B) or (C+D)]",
            "May - Total [(A+B) or (C+D)]", "Total - Total [(A+B) or (C+D)]", "Remarks"]
    df = spark.createDataFrame([("Goa", "'1.1'", "ANC\u00a0registered", "TOTAL", "1,200", "35", "NA", "x")], cols)
    rows = silver.admin_long(df).orderBy("month").collect()
    assert len(rows) == 3
    assert {r["serial_number"] for r in rows} == {"1.1"}
    assert {r["parameter"] for r in rows} == {"ANC registered"}
    by_month = {r["month"]: r["value"] for r in rows}
    assert by_month == {"April": 1200, "May": 35, "Total": None}
    assert {r["geo_grain"] for r in rows} == {"state"}


def test_admin_missing_columns(spark):
    df = spark.createDataFrame([("Goa", "x", "1")], ["State", "Parameters", "April - Total [A]"])
    with pytest.raises(ValueError, match="no column 'S.No.'"):
        silver.admin_long(df)


def test_admin_totals_filter_before_melt(spark):
    wide = silver.admin_landed(spark, SF)
    totals = silver.admin_totals(wide)
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert "April - Total [" not in plan and "May - Public [" not in plan   # only Total/Total is melted
    assert totals.count() == 25 * 7


def test_melt_rows_and_stamps(spark):
    df = stamp_ingest(spark.createDataFrame([("s", "d", "1", "2"), ("t", "e", "3", None)], ["st", "di", "a", "b"]), "f")
    long_df = melt(df, ["st", "di"])
    assert long_df.count() == 2 * 2            # rows x value columns
    assert {r["indicator"] for r in long_df.collect()} == {"a", "b"}   # T3: stamps never melted


def test_survey_indicators_exclude_stamps(spark):
    cells = catalog.survey_cells_df(spark, SF)
    names = {r["indicator"] for r in cells.select("indicator").distinct().collect()}
    assert len(names) == 8 and not any("source_file" in n or "ingested" in n or "medallion" in n for n in names)


def test_pivot_fixed_missing_and_duplicates(spark):
    df = spark.createDataFrame([("k", "a", 1.0), ("k", "a", 3.0)], "key string, ind string, v double")
    out = pivot_fixed(df, ["key"], "ind", [("a", "a"), ("never", "never")], "v").first()
    assert out["a"] == 3.0            # T9: deterministic max, not first
    assert out["never"] is None       # T16: absent value -> null column, not an error


def _offices(spark, rows):
    df = spark.createDataFrame(rows, "pincode string, district string, statename string, has_coordinates boolean")
    from trustgrid.functions.text import place_key
    return df.select(F.col("pincode"), place_key(F.col("district")).alias("district_key"),
                     place_key(F.col("statename")).alias("state_key"), F.col("district").alias("district_name"),
                     F.col("statename").alias("state_name"), "has_coordinates")


def test_lookup_reference_cases(spark):
    o = _offices(spark, [("110001", "New Delhi", "Delhi", True), ("110001", "Central Delhi", "Delhi", False),
                         ("560001", "Bengaluru", "Karnataka", True)])
    rows = {r["pincode"]: r for r in lk.join_safe_lookup(o, "pincode", "district_key", "state_key", "district_name",
                                                         "state_name", "has_coordinates").collect()}
    a = rows["110001"]
    assert (a["post_office_count"], a["district_count"], a["geocoded_office_count"]) == (2, 2, 1)
    assert a["is_geography_ambiguous"] and a["representative_district_key"] is None
    b = rows["560001"]
    assert not b["is_geography_ambiguous"]
    assert (b["representative_district_key"], b["representative_state_key"]) == ("bengaluru", "karnataka")


def test_lookup_all_null_districts_no_failure(spark):
    # T5: element_at on an empty set must not fail the job
    o = _offices(spark, [("100000", None, None, False)])
    r = lk.join_safe_lookup(o, "pincode", "district_key", "state_key", "district_name", "state_name",
                            "has_coordinates").first()
    assert r["representative_district_key"] is None and r["district_count"] == 0


def test_lookup_one_row_per_key_and_left_join_keeps_rows(spark):
    lookup = catalog.lookup_df(spark, SF)
    assert lookup.count() == lookup.select("pincode").distinct().count()
    enriched = catalog.code_enrichment_df(spark, SF)
    assert enriched.count() == lookup.count()


def test_reversed_input_same_rows(spark):
    o = catalog.offices_df(spark, SF)
    fwd = lk.join_safe_lookup(o, "pincode", "district_key", "state_key", "district_name", "state_name",
                              "has_coordinates")
    rev = lk.join_safe_lookup(o.orderBy(F.desc("office_id")).repartition(3), "pincode", "district_key", "state_key",
                              "district_name", "state_name", "has_coordinates")
    assert sorted(fwd.collect()) == sorted(rev.collect())


def test_match_status_branches(spark):
    statuses = {r["match_status"] for r in catalog.code_enrichment_df(spark, "/root/testdata/sf0.01")
                .select("match_status").distinct().collect()}
    assert statuses == {lk.MATCH_AMBIGUOUS, lk.MATCH_NO_REPRESENTATIVE, lk.MATCH_UNMATCHED, lk.MATCH_OK}


@pytest.mark.parametrize("builder,source", [
    ("facility_verdicts", "facility_geo_df"),
    ("survey_districts", "survey_cells_df"),
])
def test_rollups_ignore_input_order(spark, builder, source):
    from trustgrid.plans import gold
    src = getattr(catalog, source)(spark, SF)
    fn = {"facility_verdicts": gold.facility_verdicts, "survey_districts": silver.survey_districts}[builder]
    shuffled = src.orderBy(*[F.desc(c) for c in src.columns[:2]]).repartition(5)
    a = sorted((tuple(r) for r in fn(src).collect()), key=repr)
    b = sorted((tuple(r) for r in fn(shuffled).collect()), key=repr)
    assert a == b


def test_union_by_name_fills_missing(spark):
    from trustgrid.operators.reshape import union_all_by_name
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    rows = sorted(union_all_by_name([a, b]).collect(), key=lambda r: r["k"])
    assert [tuple(r) for r in rows] == [(1, "x", None), (2, None, "y")]


def test_extract_flag_null_safe(spark):
    from trustgrid.operators.provenance import FLAG_PATTERNS, extract_flag
    df = spark.createDataFrame([("NICU ward",), (None,)], "t string")
    got = [r[0] for r in df.select(extract_flag(F.col("t"), FLAG_PATTERNS["nicu"])).collect()]
    assert got == [True, False]


def test_roles_of_columns():
    roles = {"state": ("state", "state_name"), "district": ("district", "district_name")}
    found = resolve_roles(["x", "state_name", "state", "district_name"], roles, "survey")
    assert (found["state"].used, found["state"].spare, found["state"].absent) == ("state", ("state_name",), ())
    assert (found["district"].used, found["district"].spare, found["district"].absent) == (
        "district_name", (), ("district",))
    with pytest.raises(ValueError, match="survey: no column for .*district"):
        resolve_roles(["state"], roles, "survey")


def test_spare_geography_is_no_indicator(spark):
    landed = spark.createDataFrame([("Goa", "Goa state", "North Goa", "(29.5)")],
                                   "`State` string, `State name` string, `District` string, `Share (%)` string")
    rows = silver.survey_cells(landed).collect()
    assert [(r["indicator"], r["value"], r["state_key"]) for r in rows] == [("share_percent", 29.5, "goa")]
