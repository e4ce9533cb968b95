"""Copies of a place or a target are searched for once and lose nothing."""

import random

from pyspark.sql import functions as F

from hexfield.operators import dedupe, polygons, raster, spatial
from hexfield.plans import shape_queries


def test_nearest_searches_places_once(spark, monkeypatch):
    asked, rounds = [], spatial._nearest_of_place
    monkeypatch.setattr(spatial, "_nearest_of_place", lambda points, targets, *rest: rounds(points, asked.append((points.count(), targets.count())) or targets, *rest))
    rng = random.Random(3)
    spots, ends = [(float(rng.randrange(1000)), float(rng.randrange(1000))) for _ in range(40)], [(float(rng.randrange(1000)), float(rng.randrange(1000))) for _ in range(20)]
    points = [(i, *spots[i % 40]) for i in range(2000)] + [(5000, None, 1.0)]
    sites = [(*ends[i % 20], 900 - i, f"s{i % 60}") for i in range(600)]
    p, s = spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(sites, "sx double, sy double, site long, name string")
    got = {r.id: (r.d2, r.site, r.name) for r in spatial.nearest(p, s, "id", ["site", "name"], 100.0).collect()}
    best = lambda x, y: min(((x - t[0]) ** 2 + (y - t[1]) ** 2, *t[2:]) for t in sites) if x is not None else (None, None, None)
    assert got == {i: best(x, y) for i, x, y in points} and asked == [(len(set(spots)), len(set(ends)))]
    lines = s.select(F.col("sx").alias("x1"), F.col("sy").alias("y1"), (F.col("sx") + 50).alias("x2"), F.col("sy").alias("y2"))
    got = {r.id: r.d2 for r in spatial.nearest_segment(p, lines, "id", [], 100.0).collect()}
    flat = lambda x, y: min(max(t[0] - x, 0.0, x - t[0] - 50) ** 2 + (y - t[1]) ** 2 for t in sites) if x is not None else None
    assert got == {i: flat(x, y) for i, x, y in points} and asked[1] == asked[0]


def test_focal_sum_broadcasts_no_lookups(spark):
    """Lookups come from few bytes a point but are many: their join must not send them through the driver."""
    spark.range(3000).select("id", (F.col("id") % 7).cast("int").alias("row"), (F.col("id") % 5).cast("int").alias("col")).createOrReplaceTempView("at")
    points = spark.table("at")
    pixels = spark.range(49).select((F.col("id") % 7).cast("int").alias("row"), (F.col("id") / 7).cast("int").alias("col"), F.col("id").alias("value"))
    out = raster.focal_disk_sum(points, pixels, "id", 2, 7)
    plan = out._jdf.queryExecution().optimizedPlan().toString() + out._jdf.queryExecution().sparkPlan().toString()
    assert "strategy=merge" in plan
    want = {(r, c): sum(i for i in range(49) if (i % 7 - r) ** 2 + (i // 7 - c) ** 2 <= 4) for r in range(7) for c in range(5)}
    assert {r.id: r.total for r in out.collect()} == {i: want[i % 7, i % 5] for i in range(3000)}


def test_links_connect_what_pairs_connect(spark):
    """Copies of a place make no pairs among themselves, and the clusters are the same."""
    rng = random.Random(5)
    names = ["A", " a", "b", "c ", "", None]
    rows = [(i, float(rng.randrange(30) * 7), float(rng.randrange(3) * 7), rng.choice(names), rng.choice(names)) for i in range(300)] + [(900, None, 1.0, "a", "a"), (901, float("nan"), 1.0, "a", "a"), (902, float("nan"), 1.0, "a", "a")]
    df = spark.createDataFrame(rows, "id long, x double, y double, name string, operator string")
    args = ("id", 8.0, ["name", "operator"])
    pairs, links = dedupe.duplicate_pairs(df, *args), dedupe.duplicate_links(df, *args)

    def of(edges):
        least = {r[0]: r[0] for r in rows}
        edges = [tuple(r) for r in edges.collect()]
        for _ in least:
            for a, b in edges:
                least[a] = least[b] = min(least[a], least[b])
        return least

    assert of(pairs) == of(links) and len(set(of(links).values())) > 4
    many = spark.range(500).select("id", F.lit(1.0).alias("x"), F.lit(2.0).alias("y"), F.lit("n").alias("name"), F.lit("o").alias("operator"))
    assert dedupe.duplicate_links(many, *args).count() == 2 * 499


def test_points_of_shapes_make_no_pairs_of_copies(spark, monkeypatch, tmp_path):
    """Copies of a place count together and copies of a shape are taken apart once; counts are the same."""
    met, tested = [], polygons._in_partial
    monkeypatch.setattr(polygons, "_in_partial", lambda placed, key, areas: met.append((placed.count(), areas.rows.count())) or tested(placed, key, areas))
    spots = [(x * 1.0, y * 1.0) for x in range(-1, 12) for y in range(-1, 12)] + [(2.25, 7.5), (4.5, 0.125), (7.9, 8.9)]
    corners = lambda *at: [{"x": float(x), "y": float(y)} for x, y in at]
    u, bow = corners((0, 0), (9, 0), (9, 9), (6, 9), (6, 3), (3, 3), (3, 9), (0, 9)), corners((20, 20), (21, 20), (21, 21))
    kinds = [[u], [u, corners((0.5, 0.5), (0.5, 2.5), (2.5, 2.5), (2.5, 0.5))], [bow], None]
    points = spark.createDataFrame([(x, y) for i, (x, y) in enumerate(spots) for _ in range(1 + i % 3)] + [(None, 1.0)], "x double, y double")
    shapes = spark.createDataFrame([(i // 2, kinds[i // 2 % 4]) for i in range(24)], "id long, rings array<array<struct<x:double,y:double>>>")  # every id twice
    got = {r.id: r.n for r in polygons.counted(points, shapes, "id", 1.0).collect()}
    assert met == [(len(spots), 4)]
    areas = polygons.decomposed(shapes, ["id"], 1.0)
    pairs = polygons.containing(points.withColumn("k", F.monotonically_increasing_id()), "k", areas).join(areas.rows, "poly")
    assert got == {r.id: r["count"] for r in pairs.groupBy("id").count().collect()} and len(got) == 6 and len(set(got.values())) == 2
    met.clear()
    for name, column, rows in (("customer", "c_custkey", 300_000), ("supplier", "s_suppkey", 3000)):
        spark.range(rows).select((F.col("id") * 1000 if name == "customer" else F.col("id")).alias(column), *(F.lit(v).alias(c) for c, v in (("c_name", ""), ("c_nationkey", 1), ("c_acctbal", 1.0), ("c_mktsegment", ""), ("s_nationkey", 1)))).write.parquet(f"{tmp_path}/{name}.parquet")
    shape_queries.shape_points(spark, str(tmp_path))
    assert met == [(100, 970)]
