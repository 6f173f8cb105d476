"""Point-in-polygon over a grid index, without a (point x edge) exchange.

Polygons (with holes and multi-part districts) are rings of edges; the even-odd
rule (ray towards +x) decides, so holes and extra parts are just more rings.

The index has one row per grid cell: the districts that touch the cell, each
with the edges whose bounding box meets it and one parity. A cell without edges
lies wholly inside a district (parity 1) or is left out, so its points are
assigned outright. In a boundary cell a point's crossings are counted with the
cell's own edges only: those between the point and the cell's right side, plus
the sign changes along that side between the cell's lower corner and the
point's height; the parity holds what the ray meets beyond the corner. Points
meet the index by an equi-join on the cell (one row per cell, so points are
never multiplied), and the count is an expression over the row.

Boundary rule: an edge counts when exactly one end lies strictly above the
point and the point lies strictly left of the crossing, so points on
bottom / left edges are inside and on top / right edges outside.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgrid.operators.joins import many_to_one_join

# Demo district boundaries in (lon, lat); rings are closed.
DISTRICT_POLYGONS = (
    (1, "North Range", [  # square with a square hole
        [[70.0, 20.0], [80.0, 20.0], [80.0, 30.0], [70.0, 30.0], [70.0, 20.0]],
        [[74.0, 24.0], [76.0, 24.0], [76.0, 26.0], [74.0, 26.0], [74.0, 24.0]],
    ]),
    (2, "East Delta", [
        [[85.0, 10.0], [97.0, 10.0], [91.0, 22.0], [85.0, 10.0]],
    ]),
    (3, "Twin Isles", [  # two separate parts
        [[69.0, 7.0], [72.0, 7.0], [72.0, 10.0], [69.0, 10.0], [69.0, 7.0]],
        [[93.0, 30.0], [96.0, 30.0], [96.0, 33.0], [93.0, 33.0], [93.0, 30.0]],
    ]),
    (4, "South Plateau", [
        [[74.0, 8.0], [82.0, 8.0], [84.0, 14.0], [78.0, 18.0], [73.0, 13.0], [74.0, 8.0]],
    ]),
)
CELL = 1.0          # a power of two: cell numbers and sides are then exact


def polygons_frame(spark: SparkSession) -> DataFrame:
    """(district_id, district_name, rings_json) for the fixed polygons."""
    rows = [(i, n, json.dumps(r)) for i, n, r in DISTRICT_POLYGONS]
    return spark.createDataFrame(rows, "district_id int, district_name string, rings_json string")


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """One row per edge from ``rings_json`` (array of closed rings)."""
    rings = polygons.select("district_id", "district_name",
                            F.explode(F.from_json("rings_json", "array<array<array<double>>>")).alias("ring"))
    pairs = F.zip_with(F.slice("ring", F.lit(1), F.size("ring") - 1), F.slice("ring", F.lit(2), F.size("ring") - 1),
                       lambda p, q: F.struct(p[0].alias("x1"), p[1].alias("y1"), q[0].alias("x2"), q[1].alias("y2")))
    return rings.where(F.size("ring") > 1).select("district_id", "district_name", F.explode(pairs).alias("edge"))


def _crossing(e: Column, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]


def _changes(edges: Column, side: Column, y: Column, left_of: Callable[[Column], Column]) -> Column:
    """How often the ray's count changes between the lower right corner's level and a point of the cell.

    In an edge's own height ``left_of`` its crossing decides. Outside of it an edge that reaches beyond the cell's
    right side has changed the count along that side below the point, or not: upward ones above their end, level ones
    from their height on; downward ones count as crossed below their start, which the parity of the cell makes up for.
    """
    def one(e: Column) -> Column:
        beyond = (F.least(e["x1"], e["x2"]) < side) & (F.greatest(e["x1"], e["x2"]) >= side)
        rising = (e["x2"] > e["x1"]) == (e["y2"] > e["y1"])
        return (F.when((e["y1"] > y) != (e["y2"] > y), left_of(_crossing(e, y)))
                .when(~beyond, F.lit(False))
                .when(e["y1"] == e["y2"], y >= e["y1"])
                .when(rising, y >= F.greatest(e["y1"], e["y2"]))
                .otherwise(y < F.least(e["y1"], e["y2"]))).cast("int")

    return F.aggregate(edges, F.lit(0), lambda n, e: n + one(e))


def _cells(low: Column, high: Column, cell: float) -> Column:
    return F.explode(F.sequence(F.floor(low / cell), F.floor(high / cell)))


def grid_index(polygons: DataFrame, cell: float = CELL) -> DataFrame:
    """(cx, cy, districts): per grid cell its districts by id, each with ``parity`` and ``edges``.

    ``cell`` is a power of two. All work is per (district, cell) and (district, grid row); a district's edges of one
    grid row are the largest list.
    """
    if math.frexp(cell)[0] != 0.5:
        raise ValueError("the side of a cell has to be a power of two")
    edges = polygon_edges(polygons)
    e = F.col("edge")
    name = ["district_id", "district_name"]
    rows = (edges.withColumn("cy", _cells(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]), cell)))
    touching = (rows.withColumn("cx", _cells(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]), cell))
                .groupBy(*name, "cx", "cy").agg(F.collect_list("edge").alias("edges")))
    boxes = (edges.groupBy(*name).agg(F.min(F.least(e["x1"], e["x2"])).alias("w"), F.max(F.greatest(e["x1"], e["x2"])).alias("e"),
                                      F.min(F.least(e["y1"], e["y2"])).alias("s"), F.max(F.greatest(e["y1"], e["y2"])).alias("n"))
             .select(*name, _cells(F.col("s"), F.col("n"), cell).alias("cy"), "w", "e")
             .select(*name, "cy", _cells(F.col("w"), F.col("e"), cell).alias("cx")))
    of_row = rows.groupBy(*name, "cy").agg(F.collect_list("edge").alias("row_edges"))
    side, corner = (F.col("cx") + 1) * F.lit(cell), F.col("cy") * F.lit(cell)
    at_side = lambda crossing: crossing >= side
    met = F.size(F.filter("row_edges", lambda x: F.when((x["y1"] > corner) != (x["y2"] > corner), at_side(_crossing(x, corner)))
                          .otherwise(F.lit(False))))
    none = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")
    cells = (boxes.join(of_row, [*name, "cy"]).join(touching, [*name, "cx", "cy"], "left")
             .withColumn("edges", F.coalesce("edges", none))
             .withColumn("parity", F.pmod(met + _changes(F.col("edges"), side, corner, at_side), F.lit(2)))
             .where((F.size("edges") > 0) | (F.col("parity") == 1)))
    return cells.groupBy("cx", "cy").agg(F.array_sort(F.collect_list(F.struct(*name, "parity", "edges"))).alias("districts"))


def assign_districts(points: DataFrame, index: DataFrame, x_col: str, y_col: str, cell: float = CELL,
                     broadcast_index: bool = False, out: str = "districts") -> DataFrame:
    """``points`` with ``out``: the districts (id, name) they lie in, by id; empty outside and without coordinates.

    One left join on the cell; a cell that holds a third of all points is split (``operators.joins``). ``broadcast_index``
    is for an index of a known, bounded size (a fixed boundary set): points then never move.
    """
    x, y = F.col(x_col), F.col(y_col)
    cx, cy, found = "__cx", "__cy", "__districts"
    placed = points.withColumns({cx: F.floor(x / cell), cy: F.floor(y / cell)})
    right = index.select(F.col("cx").alias("__x"), F.col("cy").alias("__y"), F.col("districts").alias(found))
    if broadcast_index:
        joined = placed.join(F.broadcast(right), (F.col(cx) == F.col("__x")) & (F.col(cy) == F.col("__y")), "left")
    else:
        joined = many_to_one_join(placed, right, [cx, cy], ["__x", "__y"], "left")
    side = (F.col(cx) + 1) * F.lit(cell)

    def inside(d: Column) -> Column:
        return F.pmod(d["parity"] + _changes(d["edges"], side, y, lambda crossing: x < crossing), F.lit(2)) == 1

    hits = F.transform(F.filter(found, inside), lambda d: F.struct(d["district_id"].alias("district_id"),
                                                                   d["district_name"].alias("district_name")))
    nothing = F.array().cast("array<struct<district_id:int,district_name:string>>")
    return joined.withColumn("__hits", F.coalesce(hits, nothing)).select(*points.columns, F.col("__hits").alias(out))


def points_in_polygons(points: DataFrame, index: DataFrame, id_col: str, x_col: str, y_col: str, cell: float = CELL,
                       broadcast_index: bool = False) -> DataFrame:
    """(point id, district_id, district_name) for every point inside a district."""
    found = assign_districts(points.select(id_col, x_col, y_col), index, x_col, y_col, cell, broadcast_index)
    return found.select(id_col, F.inline("districts"))


def first_district(found: DataFrame, id_col: str, districts: str = "districts") -> DataFrame:
    """One district per point that lies in any (the lowest id when districts overlap)."""
    first = F.try_element_at(districts, F.lit(1))
    return found.where(F.size(districts) > 0).select(
        id_col, first["district_id"].alias("district_id"), first["district_name"].alias("district_name"),
        F.size(districts).cast("long").alias("district_hits"))


# Resolution order.
RESOLUTION_ORDER = ("polygon", "verified_field", "code_lookup", "manual_review")


def resolve_geography(df: DataFrame, polygon_district: str, verified_district: str | None,
                      code_district: str, has_coords: str) -> DataFrame:
    """Pick polygon, then verified field, then code lookup, then manual review.

    A verified or looked-up district that disagrees with the polygon is logged
    as a conflict (the polygon wins). Without valid coordinates a place stays
    unresolved: red, and the district found in another source is only a hint
    (``resolved_district`` with its method). Valid coordinates outside of all
    polygons fall back to the other sources at amber.
    """
    verified = F.col(verified_district) if verified_district else F.lit(None).cast("string")
    has = F.coalesce(F.col(has_coords).cast("boolean"), F.lit(False))
    resolved = F.coalesce(F.col(polygon_district), verified, F.col(code_district))
    method = (F.when(F.col(polygon_district).isNotNull(), F.lit("polygon"))
              .when(verified.isNotNull(), F.lit("verified_field"))
              .when(F.col(code_district).isNotNull(), F.lit("code_lookup"))
              .otherwise(F.lit("manual_review")))
    conflict = (F.coalesce(F.col(polygon_district) != verified, F.lit(False))
                | F.coalesce(F.col(polygon_district) != F.col(code_district), F.lit(False)))
    return df.withColumns({
        "resolved_district": resolved,
        "resolution_method": method,
        "has_geography_conflict": conflict,
        "resolution_band": F.when(~has | resolved.isNull(), F.lit("red"))
        .when(F.col(polygon_district).isNotNull() & ~conflict, F.lit("green"))
        .otherwise(F.lit("amber")),
    })


# What repairs a geography.
FIX_STATED = "correct stated district"
FIX_COORDINATES = "acquire valid coordinates"
FIX_BOUNDARY = "review coordinates outside of all district boundaries"


def stated_conflicts(df: DataFrame, polygon_district: str, stated_district: str, has_coords: str) -> DataFrame:
    """The stated district against the polygon's.

    With valid coordinates the polygon wins and a disagreement is a fixable address error (``stated_conflict``, amber).
    Without them nothing is resolved: red. ``agreement`` says how the two compare; an unknown side is no conflict.
    """
    has = F.coalesce(F.col(has_coords).cast("boolean"), F.lit(False))
    polygon, stated = F.col(polygon_district), F.col(stated_district)
    agreement = (F.when(~has, F.lit("unresolved")).when(polygon.isNull(), F.lit("outside_boundaries"))
                 .when(stated.isNull(), F.lit("not_stated")).when(polygon == stated, F.lit("agrees"))
                 .otherwise(F.lit("conflict")))
    out = df.withColumn("agreement", agreement)
    state = F.col("agreement")
    return out.withColumns({
        "stated_conflict": state == "conflict",
        "location_band": F.when(state == "unresolved", F.lit("red")).when(state == "agrees", F.lit("green")).otherwise(F.lit("amber")),
        "location_fix": F.when(state == "conflict", F.lit(FIX_STATED)).when(state == "unresolved", F.lit(FIX_COORDINATES))
        .when(state == "outside_boundaries", F.lit(FIX_BOUNDARY)),
    })


def polygons_from_features(features: DataFrame, name_key: str = "NAME_2", keep: Sequence[str] = ()) -> DataFrame:
    """GeoJSON features (see ``sources.io.read_feature_collection``) ->
    (district_id, district_name, rings_json) for :func:`polygon_edges`; with ``keep`` (features of
    ``sources.io.read_features``) -> these columns and rings_json.

    A Polygon's rings are used as they are; a MultiPolygon's parts are
    flattened into one ring list (the even-odd rule treats parts and holes
    alike). Ids follow the feature order of the file.
    """
    poly = F.from_json("coordinates_json", "array<array<array<double>>>")
    multi = F.from_json("coordinates_json", "array<array<array<array<double>>>>")
    rings = (F.when(F.col("geometry_type") == "Polygon", poly)
             .when(F.col("geometry_type") == "MultiPolygon", F.flatten(multi)))
    shapes = features.where(F.col("geometry_type").isin("Polygon", "MultiPolygon"))
    if keep:
        return shapes.select(*keep, F.to_json(rings).alias("rings_json"))
    return shapes.select(
        (F.col("feature_index") + 1).cast("int").alias("district_id"),
        F.try_element_at("properties", F.lit(name_key)).alias("district_name"),
        F.to_json(rings).alias("rings_json"),
    )
