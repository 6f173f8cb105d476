"""Overall fix ranks, bounded lists, key counts, grains, claims, features, landing and publishing."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustgrid.functions.cells import is_blank_field
from trustgrid.operators import fix, predict, quality
from trustgrid.operators import lookup as lk
from trustgrid.operators import provenance as pv
from trustgrid.operators.reshape import discover_values
from trustgrid.plans import catalog, decisions, gold, reports, silver
from trustgrid.sources import io, publish

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- fixes over all entities ----------------------------------------------------------------------

def test_overall_rank_keeps_null_keys_and_orders_ties(spark):
    rows = [("a", "x", 0, 0.5), ("a", "y", 1, 0.9), (None, "x", 0, 0.9), ("b", "x", 0, None), ("b", "y", 1, 0.5), (None, "y", 1, 0.1)]
    df = spark.createDataFrame(rows, "k string, dimension string, ordinal int, priority double")
    out = {(r["k"], r["ordinal"]): r["rank_overall"] for r in fix.rank_overall(df, ["k"]).collect()}
    assert out == {(None, 0): 1, ("a", 1): 2, ("a", 0): 3, ("b", 1): 4, (None, 1): 5, ("b", 0): 6}
    assert fix.rank_overall(df.limit(0), ["k"]).collect() == []


def test_overall_rank_sends_one_row_per_range_to_a_single_task(spark):
    lines = plan(catalog.REGISTRY["fix_priorities"].build(spark, SF)).split("\n")
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert single and all("HashAggregate(keys=[__range" in lines[i + 1] for i in single)


def test_district_without_name_keeps_its_fixes(spark):
    from trustgrid.operators.joins import null_safe_join
    dims = spark.createDataFrame([("s", None, 0.4), (None, "d", 0.2), ("s", "d", 0.1)], "state_key string, district_key string, score double")
    impact = spark.createDataFrame([("s", None, 5.0), (None, "d", 7.0)], "state_key string, district_key string, impact double")
    out = {(r[0], r[1]): r["impact"] for r in null_safe_join(dims, impact, ["state_key", "district_key"]).collect()}
    assert out == {("s", None): 5.0, (None, "d"): 7.0, ("s", "d"): None}


# --- lists of spellings ----------------------------------------------------------------------------

def test_lists_are_bounded_and_counts_exact(spark):
    rows = [("1", f"d{i:04d}", "s", f"D {i}", "S", i % 2 == 0) for i in range(500)] + [("2", "e", "s", "E", "S", True)] * 3 + [("3", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "code string, dk string, sk string, dn string, sn string, ok boolean")
    out = {r["code"]: r for r in lk.join_safe_lookup(df, "code", "dk", "sk", "dn", "sn", "ok", names=10).collect()}
    assert (out["1"]["district_count"], out["1"]["district_name_count"], out["1"]["post_office_count"]) == (500, 500, 500)
    assert out["1"]["district_keys"].split("|") == [f"d{i:04d}" for i in range(10)]
    assert out["1"]["geocoded_office_count"] == 250 and out["1"]["is_geography_ambiguous"]
    assert (out["2"]["post_office_count"], out["2"]["representative_district_key"]) == (3, "e")
    assert (out["3"]["district_count"], out["3"]["district_keys"], out["3"]["geocoded_office_count"]) == (0, "", 0)


OFFICE = "code string, dk string, sk string, dn string, sn string, ok boolean"


def enriched(spark, rows):
    lookup = lk.join_safe_lookup(spark.createDataFrame(rows, OFFICE).repartition(4), "code", "dk", "sk", "dn", "sn", "ok")
    return gold.code_enrichment(lookup, spark.createDataFrame([("s", "e", "E")], "state_key string, district_key string, district_name string"))


def test_ambiguous_queue_lists_every_name(spark):
    rows = [("1", f"d{i:04d}", f"s{i % 60:02d}", f"D {i}", f"S {i % 60}", True) for i in range(500)] + [("2", "e", "s", "E", "S", True)]
    queue = reports.ambiguous_queue(enriched(spark, rows).withColumnRenamed("code", "pincode")).collect()
    assert [(r["pincode"], r["district_count"], r["state_count"]) for r in queue] == [("1", 500, 60)]
    assert queue[0]["district_names"] == "|".join(sorted(f"D {i}" for i in range(500)))
    assert queue[0]["state_names"] == "|".join(sorted(f"S {i}" for i in range(60)))


@pytest.mark.parametrize("bits, adaptive", [(0, "true"), (3, "true"), (12, "false")])
def test_code_enrichment_lists_are_whole_in_order(spark, monkeypatch, bits, adaptive):
    monkeypatch.setattr(lk, "BLOCK_BITS", bits)
    rng = random.Random(bits)
    texts = ["", "|", "\u00e9", "\uffee", "\U0001f600", None, *[f"{rng.choice('aZ')} {i}" for i in range(200)]]
    rows = [(rng.choice(["1", "2", "3", None]), rng.choice(texts), rng.choice(texts[:40]), rng.choice(texts), rng.choice(texts), rng.random() < 0.5)
            for _ in range(1500)]
    rows += [("4", "e", "s", f"E {i}", "S", True) for i in range(100)] + [("5", "e", "s", f"E {i}", "S", True) for i in range(lk.NAMES)]
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        out = {r["code"]: r for r in enriched(spark, rows).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert out.keys() == {"1", "2", "3", "4", "5"}
    for code, r in out.items():
        for at, column in enumerate(("district_keys", "state_keys", "district_names", "state_names"), 1):
            every = {row[at] for row in rows if row[0] == code} - {None}
            assert r[column] == "|".join(sorted(every, key=lambda x: x.encode()))
        assert r["post_office_count"] == sum(row[0] == code for row in rows)
    assert [out[c]["match_status"] for c in "145"] == [lk.MATCH_AMBIGUOUS, lk.MATCH_OK, lk.MATCH_OK]


def test_row_limit_is_applied_before_the_shuffle(spark):
    text = plan(catalog.lookup_df(spark, SF))
    assert "WindowGroupLimit" in text and "collect_set" not in text
    assert "collect_set" not in plan(catalog.facility_verdicts_df(spark, SF))


def test_values_table_holds_every_spelling(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "a"), ("1", None), ("2", "b")], "k string, v string")
    out = {(r["k"], r["value"]): r["rows"] for r in lk.key_values(df, ["k"], {"v": "v"}).collect()}
    assert out == {("1", "a"): 2, ("1", None): 1, ("2", "b"): 1}


# --- every indicator ----------------------------------------------------------------------------------

def test_hundreds_of_indicators_become_columns(spark):
    n = 300
    cells = spark.range(n * 4).select(
        F.lit("s").alias("state_key"), (F.col("id") % 4).cast("string").alias("district_key"), F.lit("S").alias("state_name"),
        F.lit("D").alias("district_name"), F.format_string("ind_%03d", F.floor(F.col("id") / 4)).alias("indicator"),
        F.col("id").cast("double").alias("value"), F.lit(False).alias("is_suppressed"), F.lit(False).alias("is_low_sample_estimate"),
        F.lit(False).alias("is_unparsed"))
    out = silver.survey_districts(cells)
    assert len([c for c in out.columns if c.startswith("ind_")]) == n
    row = out.where("district_key = '3'").first()
    assert row["ind_123"] == 123 * 4 + 3 and row["indicator_cell_count"] == n and row["women_anaemia_percent"] is None
    landed = silver.survey_landed(spark, SF)
    known = silver.survey_indicators(landed)
    assert known == discover_values(silver.survey_cells(landed), "indicator") and len(known) == 8
    with pytest.raises(ValueError, match="too many"):
        discover_values(cells, "indicator", 100)


CELL = ("state_key string, district_key string, state_name string, district_name string, indicator string, value double, "
        "is_suppressed boolean, is_low_sample_estimate boolean, is_unparsed boolean")


def test_survey_cells_are_neither_sorted_nor_held_per_indicator(spark):
    cells = spark.createDataFrame([("s", "d", "S", "D", "i", 1.0, False, False, False)], CELL)
    districts = silver.survey_districts(cells, ["i", "j"])
    for df in (districts, districts.select("state_key", "district_key", "district_name")):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        first = [line for line in plan.splitlines() if "Aggregate(" in line or "Sort " in line][-1]
        assert first.strip(" +-:").startswith("HashAggregate(") and "indicator" not in first.split("functions=")[0]


@pytest.mark.parametrize("name", ["district_verdicts", "top_need_districts", "most_flagged_districts", "need_ranking",
                                  "expected_coverage", "metric_values"])
def test_queries_of_a_few_survey_columns_hash_cells_per_district(spark, scratch, name):
    part = spark.range(40).select(F.col("id").alias("p_partkey"))
    customer = spark.range(40).select(F.col("id").alias("c_custkey"))
    region = spark.createDataFrame([(i, f"R{i}") for i in range(5)], "r_regionkey int, r_name string")
    for table, df in {"part": part, "customer": customer, "region": region}.items():
        df.write.parquet(f"{scratch}/{table}.parquet")
    out = catalog.REGISTRY[name].build(spark, scratch)
    lines = plan(out).splitlines()
    cells = [i for i, line in enumerate(lines) if "Generate inline(array(struct(indicator, " in line]
    assert cells
    for i in cells:
        above = next(line for line in reversed(lines[:i]) if "Aggregate(" in line or "Sort [" in line).strip(" +-:")
        assert above.startswith("HashAggregate(keys=") and "indicator" not in above.split("functions=")[0]
    assert out.count() == {"top_need_districts": 25, "most_flagged_districts": 25, "metric_values": 200}.get(name, 40)


@pytest.mark.parametrize("n", [0, 3, 70])
def test_survey_districts_of_spellings_blocks_and_unnamed_cells(spark, n):
    rng = random.Random(n)
    names = [f"ind_{i:02d}" for i in range(n)]
    rows = [(rng.choice(["s", None]), rng.choice(["d", "e", None]), rng.choice(["S", " s", None]), rng.choice(["D", "d ", None]),
             rng.choice([*names, *names, "other", None]), rng.choice([None, float(rng.randrange(50))]), rng.random() < 0.2,
             rng.random() < 0.2, rng.random() < 0.2) for _ in range(900)]
    rows += [("hot", "hot", "Hot", "Hot", names[i % n] if n else None, float(i), False, False, False) for i in range(300)]
    out = {(r["state_key"], r["district_key"]): r.asDict()
           for r in silver.survey_districts(spark.createDataFrame(rows, CELL).repartition(4), names).collect()}
    assert out.keys() == {r[:2] for r in rows}
    for key, got in out.items():
        own = [r for r in rows if r[:2] == key]
        assert got["state_name"] == min((r[2] for r in own if r[2] is not None), default=None)
        assert got["district_name"] == min((r[3] for r in own if r[3] is not None), default=None)
        assert [got[c] for c in silver._CELL_COUNTS] == [
            len(own), sum(r[6] for r in own), sum(r[7] for r in own), sum(r[5] is None for r in own), sum(r[8] for r in own)]
        for i in names:
            assert got[i] == max((r[5] for r in own if r[4] == i and r[5] is not None), default=None)


# --- keys, grains, trends -----------------------------------------------------------------------------

def test_key_counts_equal_plain_counts(spark):
    rng = random.Random(2)
    own = [(rng.choice([1, 2, 3, 4, 5, None]), rng.choice([-1, 1, None])) for _ in range(200)]
    refs = [(rng.choice([3, 4, 5, 6, 7, None]),) for _ in range(300)]
    tables = {
        "own": (spark.createDataFrame(own, "k int, v int"), (quality.KeyUse("key", ("k",), True),), {"bad": F.col("v") < 0}),
        "ref": (spark.createDataFrame(refs, "k int"), (quality.KeyUse("key", ("k",), False),), {}),
    }
    r = quality.key_counts(tables).agg(quality.owned_again("key").alias("again"), quality.used_without_owner("key").alias("lost"),
                                       quality.rows_owned("key").alias("rows"), F.sum("f_0").alias("bad")).first()
    keys = [k for k, _ in own]
    assert r["again"] == len(own) - len({k for k in keys if k is not None})
    assert r["lost"] == sum(k is None or k not in keys for k, in refs)
    assert (r["rows"], r["bad"]) == (200, sum(v is None or v < 0 for _, v in own))


def test_contract_reads_each_keyed_table_once(spark):
    text = plan(catalog.REGISTRY["contract_results"].build(spark, SF))
    for table in ("orders", "lineitem", "customer"):
        assert text.count(f"{table}.parquet") == 1


def test_distinct_by_grain_with_nulls_and_large_codes(spark):
    rows = [("s", "d", c) for c in (1, 1, 40_000, 999_999, None)] + [("s", None, 1), (None, "d", 5), ("t", "e", None)]
    df = spark.createDataFrame(rows, "s string, d string, c long")
    out = {(r["grain"], r["s"], r["d"]): (r["codes"], r["n"]) for r in quality.distinct_by_grain(
        df, F.col("c"), ["s", "d"], ["table", "state", "district"], "codes", "n").collect()}
    assert out[("district", "s", "d")] == (3, 5) and out[("district", "t", "e")] == (0, 1)
    assert out[("state", "s", None)] == (3, 6) and out[("state", None, None)] == (1, 1)
    assert out[("table", None, None)] == (4, 8)
    empty = quality.distinct_by_grain(df.limit(0), F.col("c"), ["s", "d"], ["table", "state", "district"], "codes", "n")
    assert [tuple(r) for r in empty.collect()] == [("table", None, None, 0, 0)]


def test_trends_without_windows(spark):
    rng = random.Random(4)
    rows = [(i, t, 3.0 * t + rng.gauss(0, 1) + (60 if t == 7 else 0)) for i in ("a", "b", None) for t in range(30)] + [("flat", 5, 1.0), ("flat", 5, 2.0)]
    df = spark.createDataFrame(rows, "ind string, t int, y double")
    out = predict.trend_anomalies(df, ["ind"], "t", "y")
    assert "Window" not in plan(out)
    got = out.collect()
    assert len(got) == len(rows)
    assert {(r["ind"], r["t"]) for r in got if r["is_anomaly"]} == {("a", 7), ("b", 7), (None, 7)}
    assert all(r["predicted"] is None and not r["is_anomaly"] for r in got if r["ind"] == "flat")
    import statistics
    for ind in ("a", None):
        pts = [(t, y) for i, t, y in rows if i == ind]
        slope, icpt = statistics.linear_regression(*zip(*pts))
        sd = statistics.stdev([y - slope * t - icpt for t, y in pts])
        f = [r for r in predict.fit_trends(df, ["ind"], "t", "y").collect() if r["ind"] == ind][0]
        assert abs(f["slope"] - slope) < 1e-9 and abs(f["intercept"] - icpt) < 1e-9 and abs(f["residual_sd"] - sd) < 1e-9


# --- claims ------------------------------------------------------------------------------------------

def test_claims_of_every_kind(spark):
    rows = [(1, '["20 beds", {"er": "24/7"}, ["NICU", "licensed"], 7, null]'), (2, "3 physicians, 5-bedded"), (3, '["9 doctors", '),
            (4, '"round the clock"'), (5, "[]"), (6, ""), (7, None), (8, '{"a": "accredited"}'), (9, '["2 beds", "8 beds"]')]
    df = spark.createDataFrame(rows, "id int, claims string")
    items = pv.claim_items(df, "claims", ["id"])
    n = {r["id"]: r["count"] for r in items.groupBy("id").count().collect()}
    assert n == {1: 4, 2: 1, 3: 1, 4: 1, 6: 1, 8: 1, 9: 2}
    facts = {(r["id"], r["item_pos"], r["fact"], r["amount"]) for r in pv.item_facts(items, ["id", "item_pos"]).collect()}
    assert facts == {(1, 0, "beds", 20), (1, 1, "emergency_24_7", None), (1, 2, "nicu", None), (1, 2, "accreditation", None),
                     (2, 0, "doctors", 3), (2, 0, "beds", 5), (3, 0, "doctors", 9), (4, 0, "emergency_24_7", None),
                     (8, 0, "accreditation", None), (9, 0, "beds", 2), (9, 1, "beds", 8)}
    whole = pv.entity_facts(pv.item_facts(items, ["id", "item_pos"]), ["id"])
    assert {r["amount"]: r["items"] for r in whole.where("id = 9").collect()} == {8: 2}


def test_fact_profile_bands(spark):
    ent = spark.createDataFrame([(1, "4", "20"), (2, None, "null"), (3, "4", None)], "id int, doctors string, capacity string")
    facts = spark.createDataFrame([(1, "nicu"), (1, "accreditation"), (1, "emergency_24_7"), (3, "beds")], "id int, fact string")
    out = {r["id"]: r for r in pv.fact_profile(ent, facts, "id", {"beds": ~is_blank_field(F.col("capacity")),
                                                                  "doctors": ~is_blank_field(F.col("doctors"))}).collect()}
    assert (out[1]["fact_confidence"], out[1]["fact_band"], out[1]["inferred_facts"]) == (0.76, "amber", 3)
    assert (out[2]["fact_confidence"], out[2]["fact_band"], out[2]["absent_facts"]) == (0.0, "red", 5)
    assert (out[3]["beds_provenance"], out[3]["doctors_provenance"]) == ("extracted", "structured")


def test_claim_queries_hit_every_fact(spark):
    facts = {r["fact"] for r in catalog.REGISTRY["claim_facts"].build(spark, SF).select("fact").distinct().collect()}
    assert facts == set(decisions.FACTS)


# --- features ------------------------------------------------------------------------------------------

def test_features_of_differing_shape(spark, scratch):
    path = os.path.join(scratch, "a.geojson")
    feature = lambda p, g: {"type": "Feature", "properties": p, "geometry": g}
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    with open(path, "w") as f:
        json.dump({"type": "FeatureCollection", "features": [
            feature({"NAME_2": "A", "n": 1}, {"type": "Polygon", "coordinates": [ring]}), feature({"other": [1, "x"]}, None),
            feature(None, {"type": "MultiPolygon", "coordinates": [[ring], [ring]]})]}, f)
    with open(os.path.join(scratch, "broken.geojson"), "w") as f:
        f.write('{"type": "FeatureCollection", "features": [')
    rows = io.read_features(spark, scratch).select(
        "feature_index", "geometry_type", "is_json", io.feature_property("NAME_2").alias("name"), io.feature_property("n").alias("n"),
        F.to_json("properties").alias("p"), "coordinates_json").collect()
    assert sum(not r["is_json"] for r in rows) == 1                    # the broken file is a row, not a gap
    good = {r["feature_index"]: r for r in rows if r["is_json"]}
    assert (good[0]["name"], good[0]["n"], good[0]["geometry_type"]) == ("A", "1", "Polygon")
    assert good[1]["name"] is None and json.loads(good[1]["p"]) == {"other": [1, "x"]}
    assert json.loads(good[2]["coordinates_json"]) == [[ring], [ring]]


# --- landing and publishing ------------------------------------------------------------------------------

def test_windows_1252_without_a_session_setting(spark, scratch):
    before = spark.conf.get("spark.sql.legacy.javaCharsets", None)
    path = os.path.join(scratch, "w.csv")
    with open(path, "wb") as f:
        f.write("Größe €,“Name”\n5 €,l’été\n".encode("cp1252"))
    df = io.read_csv(spark, path, encoding="windows-1252")
    assert df.columns == ["Größe €", "“Name”"] and tuple(df.first()) == ("5 €", "l’été")
    assert spark.conf.get("spark.sql.legacy.javaCharsets", None) == before


def test_publish_replaces_only_its_partitions(spark, scratch):
    target = os.path.join(scratch, "t")
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, 1), (3, None, 1)], "id int, part string, v int")
    assert {(r["partition"], r["row_count"]) for r in publish.publish(first, target, ["part"], "r1").collect()} == {
        ("part=a", 1), ("part=b", 1), ("part=__null__", 2)}
    second = spark.createDataFrame([(9, "b", 2), (8, "b", 2)], "id int, part string, v int")
    publish.publish(second, target, ["part"], "r2")
    publish.publish(second, target, ["part"], "r2")                   # the same run again
    publish.publish(second.limit(0), target, ["part"], "r3")          # an empty run
    now = sorted(tuple(r) for r in publish.published(spark, target, first).fillna("-").collect())
    assert now == [(1, "a", 1), (3, "-", 1), (3, "-", 1), (8, "b", 2), (9, "b", 2)]
    assert {r["run_id"]: r["count"] for r in publish.manifests(spark, target).groupBy("run_id").count().collect()} == {"r1": 3, "r2": 1}


def test_publish_notices_a_difference(spark, scratch, monkeypatch):
    df = spark.createDataFrame([(1, "a")], "id int, part string")
    real = publish.published
    monkeypatch.setattr(publish, "published", lambda s, t, like: real(s, t, like).withColumn("id", F.lit(2)))
    with pytest.raises(publish.PublishError, match="part=a"):
        publish.publish(df, os.path.join(scratch, "t"), ["part"], "r1")


def test_absent_optional_source_is_typed(spark, scratch):
    schema = T.StructType.fromDDL(decisions.VITAL_RATES)
    df = io.read_optional_csv(spark, os.path.join(scratch, "none.csv"), schema)
    assert df.schema == schema and df.count() == 0


# --- joins -------------------------------------------------------------------------------------------------

def test_hot_and_null_keys_spread_without_aqe(spark):
    """A key with a third of all rows and the null key are dealt over many tasks; the result is the plain join's."""
    from trustgrid.operators.joins import many_to_one_join
    left = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
                                    .otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k"))
    right = spark.createDataFrame([("hot", -1)] + [(f"k{i}", i) for i in range(0, 700, 2)], "rk string, v int")
    want = sorted((r["id"], r["v"]) for r in left.join(right, F.col("k") == F.col("rk"), "left").collect())
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        out = many_to_one_join(left, right, ["k"], ["rk"], hot_threshold=100)
        assert sorted((r["id"], r["v"]) for r in out.collect()) == want
        per = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if(F.col("k") == "hot").alias("hot"), F.count_if(F.col("k").isNull()).alias("none"))
        most = per.agg(F.max("hot"), F.max("none")).first()
        assert max(most) < 700          # of 2,000 each; 16 tasks
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_null_keys_spread_with_aqe(spark):
    from trustgrid.operators.joins import many_to_one_join
    left = spark.range(4000).select("id", F.when(F.col("id") % 50 == 0, "a").alias("k"))
    right = spark.createDataFrame([("a", 1)], "rk string, v int").hint("shuffle_merge")
    out = many_to_one_join(left, right, ["k"], ["rk"])
    assert out.count() == 4000 and out.where("v is not null").count() == 80
    assert any("hashpartitioning" in line and "_salt" in line for line in plan(out).split("\n"))


def test_counted_side_is_broadcast_and_a_long_one_is_not(spark):
    from trustgrid.operators.joins import checked_join
    left = spark.range(100).select("id", (F.col("id") % 7).alias("k"))
    right = spark.range(5).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("v"))
    small = checked_join(left, right, ["k"], ["rk"])
    assert "BroadcastHashJoin" in plan(small) and "hashpartitioning" not in plan(small)
    long = checked_join(left, right, ["k"], ["rk"], most=3)
    assert sorted(small.collect()) == sorted(long.collect()) and small.count() == 100


def test_scorecard_moves_no_facility(spark):
    text = plan(catalog.scorecard_df(spark, SF))
    assert "BroadcastHashJoin" in text and "hashpartitioning(source_state_key" not in text


def test_missing_evidence_never_gives_green(spark):
    from trustgrid.plans import gold
    rows = [("full", True, True, True, 0), ("full", True, True, True, 0)] + [("nocode", True, i > 0, True, 0) for i in range(20)] + \
           [("nocaps", True, True, i > 0, 0) for i in range(20)] + [("nocoords", i > 0, True, True, 0) for i in range(20)] + [("care", True, True, True, 1)]
    geo = spark.createDataFrame([(k, k, a, b, c_, m) for k, a, b, c_, m in rows],
                                "source_state_key string, source_state_name string, has_valid_coordinates boolean, has_pincode boolean, "
                                "has_capability_text boolean, care_substance_missing_count int")
    out = {r["source_state_key"]: (r["band_by_mean"], r["band"]) for r in gold.facility_verdicts(geo).collect()}
    assert out == {"full": ("green", "green"), **{k: ("green", "amber") for k in ("nocode", "nocaps", "nocoords", "care")}}


# --- district evidence --------------------------------------------------------------------------------------

def test_evidence_comes_down_the_hierarchy(spark):
    from trustgrid.plans import gold
    names = [n for m in silver.NEED_METRICS for n in silver.SURVEY_METRICS[m]]
    cells = spark.createDataFrame(
        [(s, d, n, 50.0, False, False) for s, d in (("s", "own"), ("s", "none"), ("t", "alone"), (None, "x")) for n in names],
        "state_key string, district_key string, indicator string, value double, is_suppressed boolean, is_low_sample_estimate boolean")
    reports = spark.createDataFrame([("s", "own", 10, 9, 52.0), ("s", "other", 30, 15, 40.0)],
                                    "state_key string, district_key string, reports long, located long, delivery_percent double")
    out = {(r["district_key"], r["dimension"]): r for r in gold.district_evidence(cells, reports).collect()}
    assert len(out) == 4 * 6
    assert out[("own", "geocoding")]["score"] == 0.9 and out[("own", "corroboration")]["score"] == 1 - 2 / 40
    assert not out[("own", "corroboration")]["low_confidence"] and out[("own", "grain")]["score"] == 1.0
    proxy = out[("none", "corroboration")]              # the state: (10 * 52 + 30 * 40) / 40 = 43
    assert proxy["score"] == 1 - 7 / 40 and proxy["weight"] == 0.5 and proxy["low_confidence"] and proxy["weak_signal"]
    assert out[("none", "geocoding")]["score"] == 24 / 40 and out[("none", "grain")]["evidence_grain"] == "state"
    for d in ("alone", "x"):
        assert all(out[(d, k)]["is_missing"] and out[(d, k)]["score"] == 0.0 for k in ("geocoding", "corroboration", "grain"))


def test_district_verdicts_reach_every_band(spark):
    bands = {r["band"] for r in catalog.REGISTRY["district_evidence_verdicts"].build(spark, "/root/testdata/sf0.01").select("band").distinct().collect()}
    assert bands == {"green", "amber", "red"}
