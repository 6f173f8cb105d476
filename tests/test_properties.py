"""Spark expressions against brute-force Python statements of the same rules."""

import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trustgrid.functions import cells, text

ALPHABET = "abcXYZ019 -.,&'()*/\t\u00a0éÈüñøÅçß\uff34\uff4f" + "0123456789"
texts = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=14)), min_size=20, max_size=60)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def py_place_key(s):
    if s is None:
        return None
    s = unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii").lower()
    s = s.replace("&", " and ")
    s = re.sub(r"[\t\n\x0b\f\r ]", " ", s)
    s = re.sub(r"[^0-9a-z ]", "", s)
    s = re.sub(r" +", " ", s).strip()
    return s or None


def py_survey(s):
    if s is None:
        return (None, False, False, False)
    t = s.strip(" ")
    sup = t == "*"
    low = re.fullmatch(r"\([-+]?[0-9]+(?:\.[0-9]+)?\)", t) is not None
    m = re.search(r"[-+]?[0-9]+(?:\.[0-9]+)?", t.replace(",", ""))
    value = None if sup or m is None else float(m.group(0))
    whole = re.fullmatch(r"[-+]?[0-9]+(?:\.[0-9]+)?", t.replace(",", "")) is not None
    unparsed = t != "" and not sup and not low and not whole
    return (value, sup, low, unparsed)


def py_count(s):
    if s is None:
        return (None, False)
    t = s.replace("\u00a0", " ").strip(" ")
    if t.upper() in ("", "NA", "N/A", "NULL", "-"):
        return (None, False)
    num = t.replace(",", "")
    if re.fullmatch(r"-?[0-9]+", num) and -2**63 <= int(num) < 2**63:
        return (int(num), False)
    return (None, True)


@SETTINGS
@given(texts)
def test_place_key_matches_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [(r["k"], r["n"]) for r in df.select(text.place_key(F.col("s")).alias("k"), text.place_key("s").alias("n")).collect()]
    assert got == [(py_place_key(v), py_place_key(v)) for v in values]


@SETTINGS
@given(texts)
def test_survey_cells_match_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    s = F.col("s")
    got = [tuple(r) for r in df.select(cells.survey_value(s), cells.is_suppressed(s), cells.is_low_sample(s),
                                       cells.is_unparsed(s)).collect()]
    assert got == [py_survey(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789,- NA/\u00a0x", max_size=22)), min_size=20,
                max_size=60))
def test_counts_match_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    s = F.col("s")
    got = [tuple(r) for r in df.select(cells.count_value(s), cells.count_is_invalid(s)).collect()]
    assert got == [py_count(v) for v in values]


def py_code_in_text(s):
    if s is None:
        return None
    m = re.search(r"(?<![0-9])[0-9]{6}(?![0-9])", s)
    return m.group(0) if m else None


def py_code_normalise(s):
    if s is None:
        return None
    m = re.search(r"[0-9]+", s)
    return m.group(0).zfill(6) if m and 1 <= len(m.group(0)) <= 6 else None


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789 PIN-x", max_size=16)), min_size=20, max_size=60))
def test_codes_match_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [tuple(r) for r in df.select(text.code6_in_text(F.col("s")), text.code6_normalise(F.col("s"))).collect()]
    assert got == [(py_code_in_text(v), py_code_normalise(v)) for v in values]
