"""Polygons taken apart, against plain geometry: concave and holed shapes, overlaps, many corners."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hexfield.functions import geo
from hexfield.functions.geo import hex_ring, ring_area
from hexfield.operators import grid, polygons

RINGS = "array<array<struct<x:double,y:double>>>"


def corners(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def box(x0, y0, x1, y1, hole=False):
    c = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    return corners(*(c[::-1] if hole else c))


def star(cx, cy, r, n, seed):
    rng = random.Random(seed)
    far = [r * rng.uniform(0.3, 1) for _ in range(n)]
    return corners(*((cx + d * math.cos(2 * math.pi * k / n), cy + d * math.sin(2 * math.pi * k / n)) for k, d in enumerate(far)))


U = corners((0, 0), (9, 0), (9, 9), (6, 9), (6, 3), (3, 3), (3, 9), (0, 9))
SHAPES = [(1, [U]), (2, [box(10, 0, 30, 20), box(14, 4, 20, 10, True)]), (3, [star(40.1, 40.3, 17, 300, 1)]), (4, [box(-30, -30, 45, 33), star(1.03, 0.98, 12, 40, 2)[::-1]])]


def inside(rings, x, y):
    n = 0
    for ring in rings:
        for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
            if (a["y"] > y) != (b["y"] > y) and x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]:
                n += 1
    return n % 2 == 1


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame(SHAPES, f"id int, rings {RINGS}")


def test_pixels(shapes):
    got = {(r.id, r.row, r.col) for r in polygons.pixels_in(shapes, "id", -35.0, 60.0, 1.5, 1.0).collect()}
    assert got == {(i, r, c) for i, rings in SHAPES for r in range(100) for c in range(70) if inside(rings, -35.0 + (c + 0.5) * 1.5, 60.0 - r - 0.5)}


@pytest.mark.parametrize("size", [1.0, 4.0, 100.0])
def test_points(spark, shapes, size):
    rng = random.Random(3)
    pts = [(k, rng.uniform(-35, 60), rng.uniform(-35, 60)) for k in range(800)] + [(10_000 + 61 * x + y, float(x), float(y)) for x in range(-5, 35) for y in range(-5, 35)] + [(99_999, None, 1.0)]
    areas = polygons.decomposed(shapes, ["id"], size)
    points = spark.createDataFrame(pts, "k long, x double, y double")
    found = polygons.containing(points, "k", areas).join(areas.rows, "poly").collect()
    got = {(r.k, r.id) for r in found if not r.touch}
    edge = {(r.k, r.id) for r in found if r.touch}
    want = {(k, i) for k, x, y in pts if x is not None for i, rings in SHAPES if inside(rings, x, y)}
    assert got == want - edge and (10_000, 1) in edge and (10_000 + 61 * 5 + 3, 1) in edge


def test_whole_cells_of_many_corners(spark):
    """A polygon of 20,000 corners: few cells hold edges, large ones lie inside, and no row holds it whole."""
    ring = corners(*((1000 * math.cos(2 * math.pi * k / 20_000), 1000 * math.sin(2 * math.pi * k / 20_000)) for k in range(20_000)))
    areas = polygons.decomposed(spark.createDataFrame([(1, [ring])], f"id int, rings {RINGS}"), ["id"], 10.0)
    area = sum((10 * 2**r.level) ** 2 for r in areas.whole.collect())
    assert math.pi * 1e6 * 0.93 < area < math.pi * 1e6 and areas.whole.filter("level = 3").count() > 300
    assert areas.partial.groupBy("bx", "by").count().agg(F.max("count")).first()[0] < 120


def test_shares(spark, shapes):
    """Hexagons and polygons against the share of fine sample points, and sums against areas."""
    cells = spark.range(-4, 12).select(F.col("id").alias("q")).crossJoin(spark.range(-6, 12).select(F.col("id").alias("r")))
    cells = cells.select((F.col("q") * 100 + F.col("r")).alias("cell"), hex_ring(F.col("q"), F.col("r"), 5.0).alias("ring"))
    areas = polygons.decomposed(shapes, ["id"], 6.0)
    found = polygons.shares(cells, "cell", areas).join(areas.rows, "poly").collect()
    whole = {r.id: abs(r.a) for r in shapes.select("id", F.aggregate("rings", F.lit(0.0), lambda s, ring: s + ring_area(ring)).alias("a")).collect()}
    for i in (1, 2, 3):
        assert sum(r.piece for r in found if r.id == i) == pytest.approx(whole[i], rel=1e-9)
    rings = {r.cell: r.ring for r in cells.collect()}
    shape, pieces = dict(SHAPES), {(r.cell, r.id): r.piece for r in found}
    for cell in list(rings)[::9]:
        ring = [{"x": p.x, "y": p.y} for p in rings[cell]]
        cx, cy = sum(p["x"] for p in ring) / 6, sum(p["y"] for p in ring) / 6
        grid = [(cx + (a + 0.5) / 6 - 5, cy + (b + 0.5) / 6 - 5) for a in range(60) for b in range(60)]
        grid = [(x, y) for x, y in grid if inside([ring], x, y)]
        for i, s in shape.items():
            assert sum(inside(s, x, y) for x, y in grid) / 36 == pytest.approx(pieces.get((cell, i), 0.0), abs=2.5)


def test_faults(spark):
    good = [(1, [U]), (2, [box(0, 0, 9, 9), box(2, 2, 4, 4, True)]), (3, [box(0, 0, 1, 1), box(5, 5, 6, 6)]), (4, [star(0, 0, 50, 60, 4)])]
    bad = [
        (11, [corners((0, 0), (4, 4), (4, 0), (0, 6))]), (12, [box(0, 0, 9, 9), box(5, 5, 12, 8, True)]), (13, [box(0, 0, 9, 9), box(0, 2, 3, 4, True)]), (14, [corners((0, 0), (1, 1))]),
        (15, [corners((0, 0), (5, 0), (2, 0), (2, 4))]), (16, []), (17, None), (18, [corners((0, 0), (5, 0), (5, 0), (2, 4))]), (19, [box(0, 0, 9, 9), corners((9, 9), (8, 7), (7, 8))]),
    ]
    df = spark.createDataFrame(good + bad, f"id int, rings {RINGS}")
    assert {r.id for r in polygons.faulty(df, "id", 3.0).collect()} == {i for i, _ in bad}
    assert {r.id for r in polygons.valid(df, "id", 30.0).collect()} == {i for i, _ in good}


def area(ring):
    return sum(a.x * b.y - b.x * a.y for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def test_dissolve(spark):
    """Overlaps and common sides make one outline; a ring of boxes leaves a hole; touching corners stay apart."""
    rows = [("overlap", [box(0, 0, 4, 4)]), ("overlap", [box(2, 2, 6, 6)]), ("side", [box(0, 0, 3, 3)]), ("side", [box(3, 0, 5, 3)]), ("part side", [box(0, 0, 4, 4)]), ("part side", [box(4, 1, 6, 2)]), ("within", [box(0, 0, 9, 9)]), ("within", [box(2, 2, 3, 3)]), ("same", [box(0, 0, 2, 2)]), ("same", [box(0, 0, 2, 2)])]
    rows += [("hole", [b]) for b in (box(0, 0, 6, 2), box(0, 4, 6, 6), box(0, 1, 2, 5), box(4, 1, 6, 5))] + [("corner", [box(0, 0, 2, 2)]), ("corner", [box(2, 2, 4, 4)]), ("filled", [box(0, 0, 9, 9), box(3, 3, 6, 6, True)]), ("filled", [box(3, 3, 6, 6)]), ("slant", [corners((0, 0), (6, 0), (0, 6))]), ("slant", [corners((6, 6), (0, 5), (5, 0))])]
    got = {}
    for r in polygons.dissolve(spark.createDataFrame(rows, f"name string, rings {RINGS}"), "name", 2.5).collect():
        got.setdefault(r.name, []).append(r.corners)
    areas = {k: sorted(round(area(c), 4) for c in v) for k, v in got.items()}
    assert areas == {"overlap": [28.0], "side": [15.0], "part side": [18.0], "within": [81.0], "same": [4.0], "hole": [-4.0, 36.0], "corner": [4.0, 4.0], "filled": [81.0], "slant": areas["slant"]}
    assert len(got["overlap"][0]) == 8 and len(got["side"][0]) == 4 and len(got["part side"][0]) == 8 and len(got["slant"]) == 1
    inner = sum(inside([corners((0, 0), (6, 0), (0, 6))], (a + 0.5) / 50, (b + 0.5) / 50) or inside([corners((6, 6), (0, 5), (5, 0))], (a + 0.5) / 50, (b + 0.5) / 50) for a in range(300) for b in range(300)) / 2500
    assert areas["slant"][0] == pytest.approx(inner, abs=0.05)


def test_copies_dissolve_once(spark, monkeypatch):
    """Copies of a polygon are one before anything is cut."""
    seen, whole = [], polygons.decomposed
    monkeypatch.setattr(polygons, "decomposed", lambda df, *rest: whole(seen.append(df.count()) or df, *rest))
    rows = [("a", [box(i % 3, 0, i % 3 + 2, 2)]) for i in range(90)]
    (r,) = polygons.dissolve(spark.createDataFrame(rows, f"name string, rings {RINGS}"), "name", 2.5).collect()
    assert seen == [3] and {(p.x, p.y) for p in r.corners} == {(0, 0), (4, 0), (4, 2), (0, 2)}


def test_strict_fill(spark):
    """Centres on a side, a corner or the tip of a notch or of a hole are not inside."""
    edge = 2.0
    notch = corners((-30, 0), (0, 6), (30, 0), (30, 21), (0, 15), (-30, 21))
    hole = corners((0, 9), (-2, 10), (0, 12), (2, 10))
    for rings in ([box(0, 3, 30, 21)], [notch], [box(-40, 3, 30, 21), hole]):
        frame = spark.createDataFrame([(rings,)], f"rings {RINGS}")
        strict = {(c.q, c.r) for c in grid.fill(frame, edge, strict=True).collect()}
        every = grid.lattice(spark, -50.0, -5.0, 50.0, 40.0, edge)
        inside = every.crossJoin(frame).filter(geo.rings_contain(F.col("rings"), F.col("x"), F.col("y")) & ~geo.on_edge(F.col("rings"), F.col("x"), F.col("y")))
        assert strict == {(c.q, c.r) for c in inside.collect()} and strict
