"""Point-in-polygon against brute force; streaming cell parsing."""

import json
import math
import os
import random

import pandas as pd
import pytest

from trustgrid.operators import geo
from trustgrid.streaming.cells import parse_survey_cells, start_survey_cell_stream


def brute_inside(px, py, rings):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def test_pip_matches_brute_force(spark):
    rnd = random.Random(7)
    pts = [(i, rnd.uniform(66, 100), rnd.uniform(4, 36)) for i in range(2000)]
    pts += [(5000, 75.0, 25.0), (5001, 71.0, 25.0), (5002, 94.5, 31.5), (5003, 70.0, 22.0)]
    df = spark.createDataFrame(pts, "pid long, x double, y double")
    index = geo.grid_index(geo.polygons_frame(spark))
    got = {(r["pid"], r["district_id"]) for r in geo.points_in_polygons(df, index, "pid", "x", "y").collect()}
    want = {(pid, did) for pid, x, y in pts for did, _, rings in geo.DISTRICT_POLYGONS if brute_inside(x, y, rings)}
    assert got == want
    assert (5000, 1) not in got          # inside the hole
    assert (5001, 1) in got and (5002, 3) in got
    assert (5003, 1) in got              # on the left edge: inside by the boundary rule


def test_resolution_order(spark):
    df = spark.createDataFrame([(1, "north range", "zone 1", True), (2, None, "zone 2", False), (3, None, None, False),
                                (4, "north range", "north range", True)],
                               "id int, poly string, code string, has_coords boolean")
    rows = {r["id"]: r for r in geo.resolve_geography(df, "poly", None, "code", "has_coords").collect()}
    assert rows[1]["resolution_method"] == "polygon" and rows[1]["has_geography_conflict"]
    assert rows[1]["resolution_band"] == "amber"
    assert rows[2]["resolution_method"] == "code_lookup" and rows[2]["resolved_district"] == "zone 2"
    assert rows[2]["resolution_band"] == "red"              # no coordinates: a hint, not a resolution
    assert rows[3]["resolution_method"] == "manual_review" and rows[3]["resolution_band"] == "red"
    assert rows[4]["resolution_band"] == "green"


def test_survey_cell_stream(spark, scratch):
    src, sink = os.path.join(scratch, "src"), os.path.join(scratch, "sink")
    os.makedirs(src)
    pd.DataFrame({"state": ["Goa", "Goa"], "district": ["North Goa", "South Goa"],
                  "indicator": ["x", "x"], "raw_value": ["(29.5)", "*"]}).to_parquet(os.path.join(src, "a.parquet"))
    q = start_survey_cell_stream(spark, src, sink, query_name="test_cells_" + os.path.basename(scratch).replace("-", "_"))
    q.awaitTermination(120)
    out = {r["district_key"]: r for r in spark.read.parquet(sink).collect()}
    assert out["north goa"]["value"] == 29.5 and out["north goa"]["is_low_sample_estimate"]
    assert out["south goa"]["is_suppressed"] and out["south goa"]["value"] is None
    batch = parse_survey_cells(spark.read.parquet(src))
    assert sorted(batch.columns) == sorted(spark.read.parquet(sink).columns)


def test_joined_index_same_as_broadcast(spark):
    rnd = random.Random(11)
    pts = [(i, rnd.uniform(74, 75), 25.5) for i in range(500)]       # one hot cell
    pts += [(1000 + i, rnd.uniform(66, 100), rnd.uniform(4, 36)) for i in range(300)] + [(2000, None, 1.0), (2001, 1.0, None)]
    df = spark.createDataFrame(pts, "pid long, x double, y double")
    index = geo.grid_index(geo.polygons_frame(spark))
    a = set(geo.points_in_polygons(df, index, "pid", "x", "y", broadcast_index=True).collect())
    b = set(geo.points_in_polygons(df, index, "pid", "x", "y").collect())
    assert a == b and len(a) > 0
    whole = geo.assign_districts(df, index, "x", "y")
    assert whole.count() == len(pts) and whole.filter("pid >= 2000 and size(districts) > 0").count() == 0


def star(cx, cy, n, rnd, grid):
    """A simple ring around a centre; corners on multiples of 1 / 4 if ``grid``."""
    out = []
    for k in range(n):
        r = rnd.uniform(0.5, 5)
        x, y = cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)
        out.append([round(x * 4) / 4, round(y * 4) / 4] if grid else [x, y])
    return [*out, out[0]]


def test_pip_on_random_polygons_and_cell_sizes(spark):
    """Corners, edges and points on cell sides: the index gives the plain ray count for every point."""
    rnd = random.Random(23)
    polygons = [(i, f"d{i}", [star(rnd.uniform(-8, 8), rnd.uniform(-8, 8), rnd.randint(3, 14), rnd, i % 2 == 0) for _ in range(1 + i % 3)])
                for i in range(14)]
    pts = [(i, rnd.uniform(-14, 14), rnd.uniform(-14, 14)) for i in range(700)]
    pts += [(1000 + i, rnd.randint(-56, 56) / 4, rnd.randint(-56, 56) / 4) for i in range(900)]
    pts += [(3000 + i, *rnd.choice(rnd.choice(polygons)[2][0])) for i in range(200)]
    df = spark.createDataFrame(pts, "pid long, x double, y double")
    frame = spark.createDataFrame([(i, n, json.dumps(r)) for i, n, r in polygons], "district_id int, district_name string, rings_json string")
    want = {(pid, did) for pid, x, y in pts for did, _, rings in polygons if brute_inside(x, y, rings)}
    for cell in (1.0, 0.5, 4.0):
        got = geo.points_in_polygons(df, geo.grid_index(frame, cell), "pid", "x", "y", cell).collect()
        assert {(r["pid"], r["district_id"]) for r in got} == want
    assert geo.grid_index(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        geo.grid_index(frame, 0.3)


def test_stated_district_against_polygon(spark):
    df = spark.createDataFrame([(1, "a", "a", True), (2, "a", "b", True), (3, "a", None, True), (4, None, "b", True),
                                (5, None, "b", False), (6, None, None, None)], "id int, poly string, stated string, ok boolean")
    rows = {r["id"]: r for r in geo.stated_conflicts(df, "poly", "stated", "ok").collect()}
    assert [rows[i]["agreement"] for i in range(1, 7)] == ["agrees", "conflict", "not_stated", "outside_boundaries",
                                                           "unresolved", "unresolved"]
    assert [rows[i]["location_band"] for i in range(1, 7)] == ["green", "amber", "amber", "amber", "red", "red"]
    assert rows[2]["stated_conflict"] and rows[2]["location_fix"] == "correct stated district"


def test_many_to_one_join_salted_equals_plain(spark):
    from trustgrid.operators.joins import many_to_one_join
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("k3", 2), ("k6", 3)], "rk string, v int")
    plain = sorted(many_to_one_join(left, right, ["k"], ["rk"]).collect())
    salted = sorted(many_to_one_join(left, right, ["k"], ["rk"], force_salt=True,
                                     hot_threshold=20).collect())
    assert plain == salted and len(plain) == 300
    assert "rk" not in many_to_one_join(left, right, ["k"], ["rk"]).columns


def test_facility_verdict_stream_matches_batch(spark, scratch):
    from trustgrid.plans import catalog
    from trustgrid.streaming.verdicts import FACILITY_SCHEMA, start_facility_verdict_stream
    from trustgrid.sources import fixtures as fx
    src, sink = os.path.join(scratch, "fsrc"), os.path.join(scratch, "fsink")
    facilities = fx.view(spark, "/root/testdata/sf0.001", "v_facilities").select(*FACILITY_SCHEMA.fieldNames())
    facilities.where("unique_id % 2 = 0").write.parquet(os.path.join(src, "part=a"))
    facilities.where("unique_id % 2 = 1").write.parquet(os.path.join(src, "part=b"))
    name = "fv_" + os.path.basename(scratch).replace("-", "_")
    q = start_facility_verdict_stream(spark, os.path.join(src, "*"), sink, query_name=name)
    q.awaitTermination(180)
    got = sorted((tuple(r) for r in spark.read.parquet(sink).collect()), key=repr)
    want = sorted((tuple(r) for r in catalog.facility_verdicts_df(spark, "/root/testdata/sf0.001").collect()), key=repr)
    assert got == want


def test_verified_field_precedes_code_lookup(spark):
    df = spark.createDataFrame([(1, None, "north goa", "zone 1", True), (2, "x", "north goa", "zone 1", True),
                                (3, None, "north goa", "zone 1", False)],
                               "id int, poly string, verified string, code string, ok boolean")
    rows = {r["id"]: r for r in geo.resolve_geography(df, "poly", "verified", "code", "ok").collect()}
    assert [rows[i]["resolution_band"] for i in (1, 2, 3)] == ["amber", "amber", "red"]
    assert rows[1]["resolution_method"] == "verified_field" and rows[1]["resolved_district"] == "north goa"
    assert rows[2]["resolution_method"] == "polygon"


def test_fact_extraction_from_json_list_and_text(spark):
    from pyspark.sql import functions as F
    from trustgrid.operators import provenance as pv
    rows = [('["120 beds", "NICU available", "open 24/7", "NABH accredited"]',),
            ("Staffed by 12 doctors round-the-clock; licence renewed",),
            ('[not a list',), (None,)]
    df = spark.createDataFrame(rows, "t string")
    out = df.select(*pv.fact_columns(F.lower(pv.as_text(F.col("t"))))).collect()
    assert (out[0]["beds"], out[0]["nicu"], out[0]["emergency_24_7"], out[0]["accreditation"]) == (120, True, True, True)
    assert (out[1]["doctors"], out[1]["emergency_24_7"], out[1]["accreditation"], out[1]["beds"]) == (12, True, True, None)
    assert not any(out[2][k] for k in ("nicu", "emergency_24_7", "accreditation"))
    assert out[3]["beds"] is None and out[3]["nicu"] is False
    conf = spark.createDataFrame([(True, False), (False, True), (False, False)], "s boolean, e boolean").select(
        pv.provenance_confidence(F.col("s"), F.col("e")).alias("c")).collect()
    assert [r["c"] for r in conf] == [1.0, 0.6, 0.0]


def test_hot_key_only_salting(spark):
    from trustgrid.operators.joins import many_to_one_join
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 50}") for i in range(600)], "id int, k string")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(50)], "rk string, v int")
    plain = sorted(many_to_one_join(left, right, ["k"], ["rk"]).collect())
    hot_only = many_to_one_join(left, right, ["k"], ["rk"], force_salt=True, hot_threshold=100)
    assert sorted(hot_only.collect()) == plain and len(plain) == 600
    assert set(hot_only.columns) == {"id", "k", "v"}
