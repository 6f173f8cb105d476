"""Cell, text and schema expressions: reference cases and traps T1-T7, T13-T15."""

import pytest
from pyspark.sql import functions as F

from trustgrid.functions import cells, text
from trustgrid.functions.schema import (
    absent_columns, find_metric, parse_measure_heading, require_columns, require_tables, to_snake_case, unique_snake_names,
)


def one(spark, value, fn, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(fn(F.col("s")).alias("r")).first()["r"]


def test_snake_case_heading():
    assert to_snake_case("Women (age 15-49 years) who are anaemic (%)").endswith("_anaemic_percent")
    assert to_snake_case("S.No.") == "s_no"
    assert to_snake_case("%%%") == "percent_percent_percent"
    assert to_snake_case("!!!") == "unnamed_column"


@pytest.mark.parametrize("raw,expected", [
    ("  South-West & Delhi ", "southwest and delhi"),
    ("A & N Islands", "a and n islands"),          # T1: the helper form, not "a n islands"
    ("Bengalūru", "bengaluru"),                    # T1: accents folded, not dropped
    ("North\tGoa", "north goa"),                   # T1: tab separates words
    ("a - b", "a b"),                              # T2: collapse after dropping punctuation
    ("Zoné 12", "zone 12"),
    ("  ", None),                                  # T1: empty -> null
    (None, None),
])
def test_place_key(spark, raw, expected):
    assert one(spark, raw, text.place_key) == expected


def test_canonical_key_on_ampersands_accents_and_blanks(spark):
    # T1: the older form gave "a n islands", "bengalru" and "" here
    assert one(spark, "A & N Islands", text.place_key) == "a and n islands"
    assert one(spark, "Bengalūru", text.place_key) == "bengaluru"
    assert one(spark, "  ", text.place_key) is None


@pytest.mark.parametrize("raw,value,sup,low,unparsed", [
    ("*", None, True, False, False),
    ("(29.5)", 29.5, False, True, False),
    ("72.4", 72.4, False, False, False),
    ("1,234", 1234.0, False, False, False),
    (".5", 5.0, False, False, True),               # T14: first number kept, flagged
    ("29-30", 29.0, False, False, True),           # T14
    ("n/a", None, False, False, True),
    (None, None, False, False, False),
    ("", None, False, False, False),
])
def test_survey_cells(spark, raw, value, sup, low, unparsed):
    r = spark.createDataFrame([(raw,)], "s string").select(
        cells.survey_value(F.col("s")).alias("v"), cells.is_suppressed(F.col("s")).alias("sup"),
        cells.is_low_sample(F.col("s")).alias("low"), cells.is_unparsed(F.col("s")).alias("u")).first()
    assert (r["v"], r["sup"], r["low"], r["u"]) == (value, sup, low, unparsed)


@pytest.mark.parametrize("raw,value,invalid", [
    ("NA", None, False), ("", None, False), (None, None, False), ("-", None, False), ("n/a", None, False),
    ("not-a-number", None, True),                  # T15: flagged, never raised
    ("1,234", 1234, False), ("0", 0, False),       # T15: 0 is 0
    ("99999999999999999999", None, True),          # T5: 20 digits flagged, job does not fail
    (" 12", 12, False),
])
def test_count_cells(spark, raw, value, invalid):
    r = spark.createDataFrame([(raw,)], "s string").select(
        cells.count_value(F.col("s")).alias("v"), cells.count_is_invalid(F.col("s")).alias("bad")).first()
    assert (r["v"], r["bad"]) == (value, invalid)


@pytest.mark.parametrize("raw,expected", [
    ("PIN 560001", "560001"), ("5600011", None), ("560 001", None), (None, None), ("x110001y", "110001"),
])
def test_code_in_text(spark, raw, expected):
    assert one(spark, raw, text.code6_in_text) == expected   # T7: no cut of longer runs


@pytest.mark.parametrize("raw,expected", [
    ("110001", "110001"), ("1234", "001234"), ("1234567", None), ("PIN none", None), (None, None),
])
def test_code_normalise(spark, raw, expected):
    assert one(spark, raw, text.code6_normalise) == expected  # T7: no 000000, no cut


@pytest.mark.parametrize("raw,expected", [("NA", None), (" 12.5 ", 12.5), ("bad", None), (".5", 0.5), ("1e5", None)])
def test_decimal_or_null(spark, raw, expected):
    assert one(spark, raw, cells.decimal_or_null) == expected  # T5: no cast failure


def test_flags_are_two_valued(spark):
    # T4: a null input never yields a null flag
    df = spark.createDataFrame([(None, None, None)], "lat double, lon double, s string")
    r = df.select(cells.coords_in_range(F.col("lat"), F.col("lon")).alias("c"),
                  cells.has_text(F.col("s")).alias("t"),
                  text.place_text_is_sane(F.col("s")).alias("p")).first()
    assert (r["c"], r["t"], r["p"]) == (False, False, False)
    r = spark.createDataFrame([(0.0, 0.0)], "lat double, lon double").select(
        cells.coords_in_range(F.col("lat"), F.col("lon")).alias("c")).first()
    assert r["c"] is False


def test_missing_field_count(spark):
    df = spark.createDataFrame([("null", None, "", "4")], "a string, b string, c string, d string")
    assert df.select(cells.missing_field_count([F.col(c) for c in "abcd"]).alias("n")).first()["n"] == 3


@pytest.mark.parametrize("raw,ok", [
    ("Karnataka", True), ("null", False), ('{"type": "Point"}', False), ("560001", False),
    ("coordinates 12", False), (None, False),
])
def test_place_text_sanity(spark, raw, ok):
    assert one(spark, raw, text.place_text_is_sane) is ok


def test_unique_names_case_insensitive():
    assert unique_snake_names(["District", "district"]) == ["district", "district_2"]   # T6
    assert unique_snake_names(["A", "a", "a 2"]) == ["a", "a_2", "a_2_2"]


def test_measure_headings():
    assert parse_measure_heading("April - Total [(A+B) or (C+D)]") == ("April", "Total")
    assert parse_measure_heading("Total\u00a0-\u00a0Public  Sector [A]") == ("Total", "Public Sector")
    assert parse_measure_heading("Remarks") is None


def test_require_columns_lists_missing(spark):
    df = spark.createDataFrame([("x",)], "State string")
    with pytest.raises(ValueError, match=r"admin: no column 'S.No.'; admin: no column 'Type'"):
        require_columns(df, {"State", "S.No.", "Type"}, "admin")


def test_required_columns_of_all_tables_in_one_report(spark):
    a = spark.createDataFrame([("x", 1)], "state string, Type int")
    b = spark.createDataFrame([(1,)], "lattitude int")
    assert absent_columns({"a": (a, ["State", "Type"]), "b": (b, ["latitude", "zip"])}) == {
        "a": {"State": ["state"]}, "b": {"latitude": ["lattitude"], "zip": []}}
    with pytest.raises(ValueError, match="a: no column 'State', but 'state'; b: no column 'latitude', but 'lattitude'"):
        require_tables({"a": (a, ["State"]), "b": (b, ["latitude"])})
    require_tables({"a": (a, ["state"]), "b": (b, ())})


def test_headings_keep_their_parts_apart():
    assert to_snake_case("Births \u2014 total\u2013public") == "births_total_public"      # wide dashes separate
    assert to_snake_case("Bengal\u016bru") == "bengaluru"
    assert unique_snake_names(["ज़िला", "State", "  ", "column 1"]) == ["column_1", "state", "column_3", "column_1_2"]


def test_measure_headings_with_several_dashes():
    assert parse_measure_heading("May \u2013 Public - Urban [A]") == ("May", "Public - Urban")
    assert parse_measure_heading("May-Public") is None and parse_measure_heading("2019 - Total") is None
    assert parse_measure_heading("April - [A]") is None


def test_find_metric_reports_candidates():
    cols = ["institutional_births_percent", "institutional_caesarean_percent", "births_in_institution"]
    m = find_metric(cols, ["institutional"], ["caesarean"])
    assert m.column == "institutional_births_percent" and m.candidates == ("institutional_births_percent",)
    m = find_metric(cols, ["births"])
    assert len(m.candidates) == 2   # T13: ambiguity is visible


def test_metric_or_null_and_registry(spark):
    from trustgrid.functions.schema import metric_or_null, prefix_columns, resolve_metrics
    df = spark.createDataFrame([("1.5", "x")], "`women_anaemic (%)` string, other string")
    r = df.select(metric_or_null(df, "women_anaemic (%)", "a"), metric_or_null(df, "absent", "b"),
                  metric_or_null(df, "other", "c")).first()
    assert (r["a"], r["b"], r["c"]) == (1.5, None, None)          # T5: junk text -> null, no failure
    cols = ["households_health_insurance_percent", "institutional_births_percent"]
    got = resolve_metrics(cols, {"insurance": ("health_insurance_percent",), "births": ("births_percent",)},
                          {"births": (["births"], ["caesarean"])})
    assert got == {"insurance": None, "births": "institutional_births_percent"}
    assert prefix_columns(df, "s_", ["other"]).columns == ["s_women_anaemic (%)", "other"]
