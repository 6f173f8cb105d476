"""Sources, sinks and contract evaluation (SRC-*, SNK-*, QLT-1, SP-12, T10)."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustgrid.operators.quality import Rule, duplicate_keys, evaluate_rules, share_where
from trustgrid.sources import io


def test_read_csv_cp1252_multiline(spark, scratch):
    path = os.path.join(scratch, "admin.csv")
    content = 'State,S.No.,Parameters,"April - Total [A]"\r\n"Tamil Nadu","\'1.1\'","Caf\xe9 note\nsecond line","1,234"\r\n'
    with open(path, "wb") as fh:
        fh.write(content.encode("cp1252"))
    df = io.read_csv(spark, path, encoding="windows-1252", multiline=True)
    rows = df.collect()
    assert df.columns == ["State", "S.No.", "Parameters", "April - Total [A]"]
    assert len(rows) == 1 and rows[0]["Parameters"] == "Café note\nsecond line"
    assert rows[0]["April - Total [A]"] == "1,234"
    assert all(isinstance(f.dataType, T.StringType) for f in df.schema.fields)


def test_optional_source_gives_typed_empty_frame(spark, scratch):
    schema = T.StructType([T.StructField("state", T.StringType()), T.StructField("rate", T.DoubleType())])
    df = io.read_optional_csv(spark, os.path.join(scratch, "absent.csv"), schema)
    assert df.count() == 0 and df.schema == schema


def test_feature_collection(spark, scratch):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"NAME_1": "Goa", "NAME_2": "North Goa"},
         "geometry": {"type": "Polygon", "coordinates": [[[73.0, 15.0], [74.0, 15.0], [74.0, 16.0], [73.0, 15.0]]]}},
        {"type": "Feature", "properties": {"NAME_1": "Goa"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]}},
    ]}
    path = os.path.join(scratch, "b.geojson")
    with open(path, "w") as fh:
        json.dump(fc, fh, indent=2)
    feats = io.read_feature_collection(spark, path)
    assert feats.count() == 2
    chk = io.feature_collection_check(feats).first()
    assert chk["is_feature_collection"] and chk["features_missing_names"] == 1 and not chk["is_valid"]
    coords = json.loads(feats.orderBy("feature_index").first()["coordinates_json"])
    assert coords[0][0] == [73.0, 15.0]


def test_stamps_write_and_read_back(spark, scratch):
    df = io.stamp_ingest(spark.createDataFrame([("a", 1)], "k string, v int"), source="src.csv")
    assert {"_source_file", "_medallion_layer", "_ingested_at_utc"} <= set(df.columns)
    path = os.path.join(scratch, "t")
    io.write_table(df, path)
    io.write_table(df.drop("v"), path)            # overwrite replaces the schema
    back = spark.read.parquet(path)
    assert back.count() == 1 and "v" not in back.columns


def test_file_path_stamp(spark, scratch):
    path = os.path.join(scratch, "p")
    spark.range(3).write.parquet(path)
    stamped = io.stamp_ingest(spark.read.parquet(path))
    assert all(r["_source_file"].endswith(".parquet") for r in stamped.collect())


def test_row_counts_and_preflight(spark, scratch):
    a = spark.range(5)
    b = spark.range(2)
    counts = {r["table_name"]: r["row_count"] for r in io.row_count_summary({"a": a, "b": b}).collect()}
    assert counts == {"a": 5, "b": 2}
    p = os.path.join(scratch, "present.parquet")
    spark.range(4).write.parquet(p)
    rows = {r["source_name"]: r for r in io.preflight(spark, [
        io.SourceSpec("present", p), io.SourceSpec("optional", os.path.join(scratch, "nope.csv"), required=False),
    ]).collect()}
    assert rows["present"]["row_count"] == 4 and rows["optional"]["status"] == "optional_missing"
    with pytest.raises(FileNotFoundError):
        io.preflight(spark, [io.SourceSpec("needed", os.path.join(scratch, "missing.csv"))])


def test_keep_list_and_run_id(spark):
    df = spark.createDataFrame([(" tamil nadu", None), (None, "Kerala"), ("Goa", "x")], "statename string, state string")
    kept = io.keep_list_filter(df, ["statename", "state"], ["Tamil Nadu", " kerala "])
    assert kept.count() == 2
    rid = spark.range(1).select(io.run_id_column("silver").alias("r")).first()["r"]
    assert re.fullmatch(r"silver-\d{8}T\d{6}Z", rid)


def test_create_database_and_preview(spark):
    io.create_database(spark, "trustgrid_test_db")
    assert "trustgrid_test_db" in [d.name for d in spark.catalog.listDatabases()]
    prev = io.table_preview({"r": spark.range(10)}, 3, {"r": ["id"]})
    assert [r["id"] for r in prev["r"].collect()] == [0, 1, 2]


def test_rules_status_is_computed(spark):
    df = spark.createDataFrame([(1, 5.0), (1, -1.0), (2, None)], "k int, v double")
    out = {r["check_name"]: r for r in evaluate_rules(df, [
        Rule("t", "key_unique", "fail", duplicate_keys("k")),
        Rule("t", "v_positive", "warn", share_where(F.col("v") > 0), "ge", 0.5),
        Rule("t", "rows_present", "fail", F.count("*"), "ge", 1),
    ]).collect()}
    assert out["key_unique"]["status"] == "fail" and out["key_unique"]["observed_value"] == 1.0
    assert out["v_positive"]["status"] == "warn"       # null counts against the rule
    assert out["rows_present"]["status"] == "pass"


def test_rule_validation():
    with pytest.raises(ValueError):
        Rule("t", "x", "error", F.count("*"))
    with pytest.raises(ValueError):
        Rule("t", "x", "warn", F.count("*"), "lt")


def test_geojson_polygons_drive_point_in_polygon(spark, scratch):
    from trustgrid.operators import geo
    feats = []
    for did, name, rings in geo.DISTRICT_POLYGONS:
        if len(rings) == 2 and name == "Twin Isles":
            geometry = {"type": "MultiPolygon", "coordinates": [[rings[0]], [rings[1]]]}
        else:
            geometry = {"type": "Polygon", "coordinates": rings}
        feats.append({"type": "Feature", "properties": {"NAME_1": "Demo", "NAME_2": name}, "geometry": geometry})
    path = os.path.join(scratch, "districts.geojson")
    with open(path, "w") as fh:
        json.dump({"type": "FeatureCollection", "features": feats}, fh, indent=1)
    from_file = geo.polygons_from_features(io.read_feature_collection(spark, path))
    pts = spark.createDataFrame([(1, 75.0, 25.0), (2, 71.0, 25.0), (3, 94.5, 31.5), (4, 88.0, 12.0), (5, 60.0, 5.0)],
                                "pid int, x double, y double")

    def hits(polys):
        index = geo.grid_index(polys)
        return {(r["pid"], r["district_name"]) for r in geo.points_in_polygons(pts, index, "pid", "x", "y").collect()}

    assert hits(from_file) == hits(geo.polygons_frame(spark)) == {(2, "North Range"), (3, "Twin Isles"),
                                                                  (4, "East Delta")}


def test_admin_csv_landing_matches_memory_path(spark, scratch):
    from trustgrid.plans import silver
    wide = silver.admin_landed(spark, "/root/testdata/sf0.001")
    path = os.path.join(scratch, "admin_csv")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")   # to write the cp1252 fixture file
    wide.coalesce(1).write.option("header", True).option("encoding", "windows-1252").csv(path)
    landed = io.read_csv(spark, path, encoding="windows-1252")
    assert "S.No." in landed.columns and any("\u00a0" in c for c in landed.columns)
    a = sorted(silver.admin_long(landed).collect())
    b = sorted(silver.admin_long(wide).collect())
    assert a == b and len(a) == 25 * 8 * 26


def test_files_added_under_a_partition_are_read(spark, scratch):
    from trustgrid.sources.tables import read_table
    path = f"{scratch}/region.parquet"
    spark.range(10).selectExpr("id", "1 as p").write.partitionBy("p").parquet(path)
    assert read_table(spark, scratch, "region").count() == 10
    spark.range(3).selectExpr("id").write.mode("append").parquet(f"{path}/p=1")
    assert read_table(spark, scratch, "region").count() == 13


def test_run_id_is_utc_in_any_session_zone(spark):
    from datetime import datetime, timezone
    from trustgrid.sources.io import run_id_column
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        got = spark.range(1).select(run_id_column("r").alias("x")).first().x
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    stamp = datetime.strptime(got, "r-%Y%m%dT%H%M%SZ").replace(tzinfo=timezone.utc)
    assert abs((datetime.now(timezone.utc) - stamp).total_seconds()) < 120
