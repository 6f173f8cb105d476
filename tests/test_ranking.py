"""Places in a global order against plain sorting."""

import random

from pyspark.sql import functions as F

from trustgrid.operators.ranking import places


def test_places_in_groups_and_overall(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randint(0, 50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(5)
    got = {r["i"]: (r["pos"], r["n"]) for r in places(df, ["v", "i"], ["g"], partitions=7).collect()}
    want = {}
    for g in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: r[1:])
        want |= {r[2]: (k, len(own)) for k, r in enumerate(own)}
    assert got == want
    overall = {r["i"]: r["place"] for r in places(df, [F.desc("v"), "i"], pos="place", size=None).collect()}
    assert overall == {r[2]: k for k, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[2])))}


def test_places_of_ties_and_nothing(spark):
    same = spark.range(100).select(F.lit(1).alias("v"), F.lit("x").alias("pos_kept"))
    assert sorted(r["pos"] for r in places(same, ["v"]).collect()) == list(range(100))
    assert places(same.limit(0), ["v"]).collect() == []


def test_hot_group_spans_ranges(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id")
    out = places(df, ["id"], ["g"], partitions=8)
    hot = sorted((r["id"], r["pos"]) for r in out.filter("g = 'hot'").collect())
    assert [p for _, p in hot] == list(range(1667))
