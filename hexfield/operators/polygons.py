"""Polygons taken apart into edges: scanline fill, quadtree cells, overlay, validity and dissolving.

A polygon is a row with `rings`, arrays of corners: parts counter-clockwise, holes clockwise.  Nothing here
shuffles one whole.  Its edges go to the cells that they pass through; cells that no edge passes through lie
inside or outside as a whole, and only the former are kept, the larger ones of a quadtree where they fit.
A point counts as inside by the even-odd rule with left and lower sides included.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import ring_box, ring_edges
from ..sources.shared import materialized

ENDS = ["x1", "y1", "x2", "y2"]
#: Edges reach this share of a cell's size beyond their own cells, for rounding.
PAD = 1e-6
#: Sizes of whole cells: `size` and its doublings.
LEVELS = 4
#: Decimals that crossing points are rounded to.
DIGITS = 6


def edges_of(polygons: DataFrame, keys: Sequence[str], rings: str = "rings", numbered: bool = False) -> DataFrame:
    """A row (keys, part, x1, y1, x2, y2) for each edge of each ring, with its number in the ring (`at`) if
    asked for; edges without length are left out."""
    parts = polygons.select(*keys, F.posexplode(rings).alias("part", "_ring"))
    each = parts.select(*keys, "part", F.posexplode(ring_edges(F.col("_ring"))).alias("at", "e"))
    return each.select(*keys, "part", *(["at"] if numbered else []), F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2")).filter("x1 <> x2 OR y1 <> y2")


def crossings(edges: DataFrame, keys: Sequence[str], y0: float, step: float, upper: bool = False) -> DataFrame:
    """(keys, row, x): where edges cross the lines y = y0 + row * step.  Sides along a line count as below
    it, with `upper` as above it."""
    low, high = (f(F.col("y1"), F.col("y2")) for f in (F.least, F.greatest))
    rows = F.sequence(F.ceil((low - y0) / step).cast("long") - 1, F.ceil((high - y0) / step).cast("long"))
    met = edges.filter("y1 <> y2").withColumn("row", F.explode(rows)).withColumn("_y", y0 + F.col("row") * step)
    above = (lambda y: F.col(y) >= F.col("_y")) if upper else (lambda y: F.col(y) > F.col("_y"))
    met = met.filter(above("y1") != above("y2"))
    return met.select(*keys, "row", ((F.col("x2") - F.col("x1")) * (F.col("_y") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")).alias("x"))


def spans(edges: DataFrame, keys: Sequence[str], y0: float, step: float, upper: bool = False) -> DataFrame:
    """(keys, row, x_in, x_out): the stretches [x_in, x_out) of each line that lie inside, lower sides of a
    polygon included, with `upper` its upper sides."""
    along = Window.partitionBy(*keys, "row").orderBy("x")
    found = crossings(edges, keys, y0, step, upper).withColumns({"n": F.row_number().over(along), "x_out": F.lead("x").over(along)})
    return found.filter("n % 2 = 1 AND x < x_out").select(*keys, "row", F.col("x").alias("x_in"), "x_out")


def _steps(low: Column, high: Column) -> Column:
    """Whole numbers from low on and below high, and one more on either side, for rounding."""
    return F.sequence(F.ceil(low).cast("long") - 1, F.ceil(high).cast("long"))


def pixels_in(polygons: DataFrame, key: str, x0: float, y0: float, dx: float, dy: float) -> DataFrame:
    """(key, row, col) of the pixels whose centre lies in a polygon, for a raster whose upper left corner is
    (x0, y0).  Each raster row takes the polygon's crossings with its line: the work follows the crossings
    and the pixels found, not the product of pixels and edges."""
    lines = spans(edges_of(polygons, [key]), [key], y0 - dy / 2, dy)
    x = x0 + (F.col("col") + 0.5) * dx
    cols = lines.withColumn("col", F.explode(_steps((F.col("x_in") - x0) / dx - 0.5, (F.col("x_out") - x0) / dx - 0.5))).filter((x >= F.col("x_in")) & (x < F.col("x_out")))
    return cols.select(key, (-F.col("row")).cast("int").alias("row"), F.col("col").cast("int").alias("col"))


def with_zone(pixels: DataFrame, polygons: DataFrame, key: str, x0: float, y0: float, dx: float, dy: float) -> DataFrame:
    """Pixels (row, col, ...) with the key of each polygon that holds their centre; others are left out."""
    return pixels.join(pixels_in(polygons, key, x0, y0, dx, dy), ["row", "col"])


def _cells(edges: DataFrame, size: float) -> DataFrame:
    """A row for each cell (bx, by) that an edge passes through."""
    x1, y1, x2, y2 = (F.col(c) for c in ENDS)
    pad = PAD * size
    cell = lambda v: F.floor(v / size).cast("long")
    strip = edges.withColumn("bx", F.explode(F.sequence(cell(F.least(x1, x2) - pad), cell(F.greatest(x1, x2) + pad))))
    along = lambda x: y1 + F.try_divide((F.greatest(F.least(x, F.greatest(x1, x2)), F.least(x1, x2)) - x1) * (y2 - y1), x2 - x1)
    here, there = along(F.col("bx") * size - pad), along((F.col("bx") + 1) * size + pad)
    return strip.withColumn("by", F.explode(F.sequence(cell(F.coalesce(F.least(here, there), F.least(y1, y2)) - pad), cell(F.coalesce(F.greatest(here, there), F.greatest(y1, y2)) + pad))))


def _corners(cells: DataFrame, edges: DataFrame, size: float) -> DataFrame:
    """Cells (poly, bx, by) with `inside`: 1 where their lower left corner lies inside, else 0.  Corners and
    crossings of a line are counted in one pass from the right."""
    at = crossings(edges, ["poly"], 0.0, size).select("poly", F.col("row").alias("by"), "x", F.lit(1).alias("n"), F.lit(None).cast("long").alias("bx"))
    asked = cells.select("poly", "by", (F.col("bx") * size).alias("x"), F.lit(0).alias("n"), "bx")
    right = Window.partitionBy("poly", "by").orderBy(F.desc("x"), "n").rowsBetween(Window.unboundedPreceding, 0)
    return at.unionByName(asked).withColumn("inside", (F.sum("n").over(right) % 2).cast("int")).filter("n = 0").select("poly", "bx", "by", "inside")


@dataclass
class Decomposed:
    """`whole` (level, bx, by, poly) lies inside; `partial` (poly, bx, by, inside, x1, y1, x2, y2) has a row for
    each edge in each cell; `rows` (poly, ...) has the polygons' other columns."""

    size: float
    edges: DataFrame
    whole: DataFrame
    partial: DataFrame
    rows: DataFrame


def decomposed(polygons: DataFrame, attrs: Sequence[str], size: float) -> Decomposed:
    """Quadtree cells of polygons, from the largest down: only cells with edges are divided."""
    rows = materialized(polygons.select(F.monotonically_increasing_id().alias("poly"), "rings", *attrs))
    return _decomposed(materialized(edges_of(rows, ["poly"]).select("poly", *ENDS)), rows.drop("rings"), size)


def _decomposed(edges: DataFrame, rows: DataFrame, size: float) -> Decomposed:
    """The cells of polygons that are given by their edges (poly, x1, y1, x2, y2)."""
    key, whole, above = ["poly", "bx", "by"], [], None
    for level in range(LEVELS - 1, -1, -1):
        wide = size * 2**level
        dealt = _cells(edges, wide)
        partial = materialized(dealt.select(*key).distinct())
        if above is None:
            lines = spans(edges, ["poly"], 0.0, wide)
            x = F.col("bx") * wide
            open_ = lines.withColumn("bx", F.explode(_steps(F.col("x_in") / wide, F.col("x_out") / wide))).filter((x >= F.col("x_in")) & (x < F.col("x_out")))
            inside = open_.select("poly", "bx", F.col("row").alias("by")).join(partial, key, "left_anti")
        else:
            quarter = F.array(*(F.struct((F.col("bx") * 2 + i).alias("bx"), (F.col("by") * 2 + j).alias("by")) for i in (0, 1) for j in (0, 1)))
            open_ = above.select("poly", F.explode(quarter).alias("c")).select("poly", "c.*").join(partial, key, "left_anti")
            inside = _corners(open_, edges, wide).filter("inside = 1").select(*key)
        whole.append(inside.withColumn("level", F.lit(level)))
        above = partial
    cells = _corners(above, edges, size)
    return Decomposed(size, edges, materialized(reduce(DataFrame.unionByName, whole)), materialized(_cells(edges, size).join(cells, key)), rows)


def _places(points: DataFrame, key: Sequence[str]) -> DataFrame:
    return points.filter("x is not null and y is not null").select(*key, *(c for c in ("x", "y") if c not in key))


def _in_levels(placed: DataFrame, size: float) -> DataFrame:
    """Each point with its cell (level, bx, by) of every level."""
    at = lambda v, wide: F.floor(F.col(v) / wide).cast("long")
    levels = F.array(*(F.struct(F.lit(v).alias("level"), at("x", size * 2**v).alias("bx"), at("y", size * 2**v).alias("by")) for v in range(LEVELS)))
    return placed.withColumn("c", F.explode(levels)).select("*", "c.*").drop("c")


def _in_partial(placed: DataFrame, key: Sequence[str], areas: Decomposed) -> DataFrame:
    """(key, poly, touch) for points of partial cells: a point follows the cell's own edges to its lower left
    corner."""
    size, x, y = areas.size, F.col("x"), F.col("y")
    at = lambda v, wide: F.floor(v / wide).cast("long")
    x1, y1, x2, y2 = (F.col(c) for c in ENDS)
    left, low = F.col("bx") * size, F.col("by") * size
    here = F.try_divide((x2 - x1) * (y - y1), y2 - y1) + x1
    across = ((y1 > y) != (y2 > y)) & (here > left) & (here <= x)
    height = y1 + F.try_divide((left - x1) * (y2 - y1), x2 - x1)
    over = lambda h: F.when((x2 - x1) * (y2 - y1) > 0, h > height).otherwise(h < height)
    upward = ((x1 > left) != (x2 > left)) & (over(low) != over(y)) & (y1 != y2)
    flat = ((x1 > left) != (x2 > left)) & (y1 == y2) & (y1 > low) & (y1 <= y)
    cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    on = (cross == 0) & x.between(F.least(x1, x2), F.greatest(x1, x2)) & y.between(F.least(y1, y2), F.greatest(y1, y2))
    one = lambda c: F.when(c, 1).otherwise(0)
    met = placed.withColumns({"bx": at(x, size), "by": at(y, size)}).join(areas.partial, ["bx", "by"])
    tested = met.groupBy(*key, "poly").agg((F.max("inside") + F.sum(one(across) + one(upward) + one(flat))).alias("_odd"), F.max(one(on)).alias("touch"))
    return tested.filter("_odd % 2 = 1 OR touch = 1").select(*key, "poly", "touch")


def containing(points: DataFrame, key: str, areas: Decomposed) -> DataFrame:
    """(key, poly, touch) for each point (key, x, y) and polygon that holds it or has it on its boundary
    (touch = 1)."""
    placed = _places(points, [key])
    inner = _in_levels(placed, areas.size).join(areas.whole, ["level", "bx", "by"]).select(key, "poly", F.lit(0).alias("touch"))
    return inner.unionByName(_in_partial(placed, [key], areas))


def counted(points: DataFrame, polygons: DataFrame, key: str, size: float) -> DataFrame:
    """(key, n): how many points (x, y) polygons hold or have on their boundary; those without any are left out.

    Points of one place count together, equal polygons are taken apart once, and a whole cell takes the sum of
    its points.  Only places and edges that share a small cell meet each other.
    """
    named = materialized(polygons.select(key, "rings", F.sha2(F.to_json("rings"), 256).alias("shape")))
    rows = materialized(named.select("shape").distinct().select(F.monotonically_increasing_id().alias("poly"), "shape"))
    once = edges_of(named, ["shape"], numbered=True).distinct()
    areas = _decomposed(materialized(once.join(rows, "shape").select("poly", *ENDS)), rows, size)
    places = materialized(_places(points, []).groupBy("x", "y").agg(F.count("*").alias("n")))
    cells = _in_levels(places, size).groupBy("level", "bx", "by").agg(F.sum("n").alias("n"))
    whole = cells.join(areas.whole, ["level", "bx", "by"]).select("poly", "n")
    partial = _in_partial(places, ["x", "y", "n"], areas).select("poly", "n")
    held = whole.unionByName(partial).groupBy("poly").agg(F.sum("n").alias("n")).join(rows, "poly")
    return named.select(key, "shape").join(held, "shape").groupBy(key).agg(F.sum("n").alias("n"))


def clipped(ring: Column) -> Column:
    """The part [t0, t1] of an edge that lies in a convex counter-clockwise ring; none if t0 >= t1."""
    x1, y1, x2, y2 = (F.col(c) for c in ENDS)

    def side(e: Column, x: Column, y: Column) -> Column:
        return (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (x - e["a"]["x"])

    def cut(t: Column, e: Column) -> Column:
        f, g = side(e, x1, y1), side(e, x2, y2)
        t0 = F.when((g > f) & (f < 0), F.greatest(t["t0"], F.try_divide(-f, g - f))).otherwise(t["t0"])
        t1 = F.when((g < f) & (g < 0), F.least(t["t1"], F.try_divide(f, f - g))).when((g == f) & (f < 0), F.lit(-1.0)).otherwise(t["t1"])
        return F.struct(t0.alias("t0"), t1.alias("t1"))

    return F.aggregate(ring_edges(ring), F.struct(F.lit(0.0).alias("t0"), F.lit(1.0).alias("t1")), cut)


#: Where along its first side a cell's boundary is entered; any share that corners of polygons don't meet.
START = 0.3819660112501051


def shares(cells: DataFrame, key: str, areas: Decomposed) -> DataFrame:
    """(key, poly, piece, area): the area that each convex cell (key, ring) has in common with each polygon.

    By Green's theorem it is a sum over the polygon's edges: what they sweep inside the cell around its
    middle, and the cell's sectors between where they enter and leave, which is one function of a place;
    and the whole cell once more where the start of its boundary lies in the polygon.
    """
    ring = F.col("ring")
    mean = lambda axis: F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[axis]) / F.size(ring)
    mid = F.struct(mean("x").alias("x"), mean("y").alias("y"))
    based = cells.select(key, "ring", mid.alias("mid"), ring_box(ring).alias("box"))
    moved = F.transform("ring", lambda p: F.struct((p["x"] - F.col("mid.x")).alias("x"), (p["y"] - F.col("mid.y")).alias("y")))
    based = based.withColumn("_r", moved)
    a, b = F.col("_r")[0], F.col("_r")[1]
    start = F.struct((a["x"] + START * (b["x"] - a["x"])).alias("x"), (a["y"] + START * (b["y"] - a["y"])).alias("y"))
    based = based.withColumn("_s", start).withColumn("_r", F.concat(F.array("_s"), F.slice("_r", 2, F.size("_r") - 1), F.slice("_r", 1, 1)))
    cross = lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]
    fan = F.aggregate(ring_edges(F.col("_r")), F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>,sum:double>>").alias("out")), lambda s, e: F.struct((s["sum"] + cross(e["a"], e["b"]) / 2).alias("sum"), F.concat(s["out"], F.array(F.struct(e["a"].alias("a"), e["b"].alias("b"), s["sum"].alias("sum")))).alias("out")))
    based = based.withColumn("_f", fan).select(key, "ring", "mid", "box", F.col("_f.out").alias("fan"), F.col("_f.sum").alias("area"), (F.col("mid.x") + F.col("_s.x")).alias("x"), (F.col("mid.y") + F.col("_s.y")).alias("y"))

    cell = lambda v: F.floor(v / areas.size).cast("long")
    spread = based.drop("x", "y").withColumn("bx", F.explode(F.sequence(cell(F.col("box.x0")), cell(F.col("box.x1"))))).withColumn("by", F.explode(F.sequence(cell(F.col("box.y0")), cell(F.col("box.y1")))))
    met = spread.join(areas.partial.drop("inside"), ["bx", "by"]).withColumn("t", clipped(F.col("ring"))).filter("t.t0 < t.t1")
    place = lambda t: (F.col("x1") + t * (F.col("x2") - F.col("x1")), F.col("y1") + t * (F.col("y2") - F.col("y1")))
    (px, py), (qx, qy) = place(F.col("t.t0")), place(F.col("t.t1"))
    # an edge and a cell may meet in several buckets; the one of the first common place counts
    met = met.filter((cell(px) == F.col("bx")) & (cell(py) == F.col("by")))
    p, q = (F.struct((x - F.col("mid.x")).alias("x"), (y - F.col("mid.y")).alias("y")) for x, y in ((px, py), (qx, qy)))
    met = met.withColumns({"p": p, "q": q})
    sector = lambda o: F.aggregate("fan", F.lit(0.0), lambda s, f: s + F.when((cross(f["a"], o) >= 0) & (cross(f["b"], o) < 0), f["sum"] + cross(f["a"], o) / 2).otherwise(0.0))
    swept = met.groupBy(key, "poly").agg(F.sum(cross(F.col("p"), F.col("q")) / 2 + sector(F.col("p")) - sector(F.col("q"))).alias("piece"))
    begun = containing(based.select(key, "x", "y"), key, areas).select(key, "poly", F.lit(1).alias("begun"))
    both = swept.join(begun, [key, "poly"], "full").join(based.select(key, "area"), key)
    return both.select(key, "poly", F.greatest(F.lit(0.0), F.coalesce("piece", F.lit(0.0)) + F.coalesce("begun", F.lit(0)) * F.col("area")).alias("piece"), "area")


def _meets(a: str, b: str) -> Column:
    """Whether the segments with columns prefixed a and b have a point in common."""
    c = lambda p: [F.col(f"{p}{e}") for e in ENDS]
    (ax, ay, bx, by), (cx, cy, dx, dy) = c(a), c(b)
    turn = lambda px, py, qx, qy, rx, ry: F.signum((qx - px) * (ry - py) - (qy - py) * (rx - px))
    one, two, three, four = turn(ax, ay, bx, by, cx, cy), turn(ax, ay, bx, by, dx, dy), turn(cx, cy, dx, dy, ax, ay), turn(cx, cy, dx, dy, bx, by)
    boxes = (F.greatest(ax, bx) >= F.least(cx, dx)) & (F.greatest(cx, dx) >= F.least(ax, bx)) & (F.greatest(ay, by) >= F.least(cy, dy)) & (F.greatest(cy, dy) >= F.least(ay, by))
    return boxes & (one * two <= 0) & (three * four <= 0)


def faulty(polygons: DataFrame, key: str, size: float) -> DataFrame:
    """Keys of polygons that aren't simple: a ring with fewer than three corners or one that repeats a corner
    next to itself back and forth, or edges that meet anywhere but at the corner between two neighbours, in
    one ring or in two (bow-ties, touching and crossing holes)."""
    parts = polygons.select(key, F.posexplode("rings").alias("part", "_ring"))
    short = parts.filter((F.size("_ring") < 3) | F.exists("_ring", lambda p: p.isNull() | p["x"].isNull() | p["y"].isNull())).select(key)
    none = polygons.filter(F.col("rings").isNull() | (F.size("rings") == 0)).select(key)
    each = parts.select(key, "part", F.size("_ring").alias("n"), F.posexplode(ring_edges(F.col("_ring"))).alias("at", "e"))
    each = each.select(key, "part", "n", "at", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))
    still = each.filter("x1 = x2 AND y1 = y2").select(key)
    dealt = materialized(_cells(each, size))
    side = lambda p: dealt.select(key, "bx", "by", *(F.col(c).alias(f"{p}{c}") for c in ("part", "n", "at", *ENDS)))
    pairs = side("a_").join(side("b_"), [key, "bx", "by"]).filter("struct(a_part, a_at) < struct(b_part, b_at)").filter(_meets("a_", "b_"))
    same = F.col("a_part") == F.col("b_part")
    after = same & ((F.col("a_at") + 1 == F.col("b_at")) | ((F.col("a_at") == 0) & (F.col("b_at") == F.col("a_n") - 1)))
    # neighbours share their corner only, unless one turns back along the other
    ax, ay, bx, by = (F.col("a_x2") - F.col("a_x1"), F.col("a_y2") - F.col("a_y1"), F.col("b_x2") - F.col("b_x1"), F.col("b_y2") - F.col("b_y1"))
    back = (ax * by - ay * bx == 0) & (ax * bx + ay * by < 0)
    return pairs.filter(~after | back).select(key).union(short).union(none).union(still).distinct()


def valid(polygons: DataFrame, key: str, size: float) -> DataFrame:
    """The rows whose polygon is simple."""
    return polygons.join(faulty(polygons, key, size), key, "left_anti")


def _cut(areas: Decomposed, group: str) -> DataFrame:
    """Edges (group, poly, x1, y1, x2, y2) cut wherever they meet an edge of another polygon of their group."""
    labelled = areas.edges.join(areas.rows.select("poly", group), "poly").withColumn("edge", F.xxhash64("poly", *ENDS))
    dealt = materialized(_cells(labelled, areas.size))
    side = lambda p: dealt.select(group, "bx", "by", *(F.col(c).alias(f"{p}{c}") for c in ("poly", "edge", *ENDS)))
    pairs = side("a_").join(side("b_"), [group, "bx", "by"]).filter("a_poly <> b_poly").filter(_meets("a_", "b_"))
    c = lambda p: [F.col(f"{p}{e}") for e in ENDS]
    (ax, ay, bx, by), (cx, cy, dx, dy) = c("a_"), c("b_")
    first = F.struct(*(F.col(f"a_{e}") for e in ENDS)) < F.struct(*(F.col(f"b_{e}") for e in ENDS))
    # both edges of a pair take the place from the same one of them, so that it has the same digits
    px, py, qx, qy, rx, ry, sx, sy = (F.when(first, u).otherwise(v) for u, v in zip((ax, ay, bx, by, cx, cy, dx, dy), (cx, cy, dx, dy, ax, ay, bx, by), strict=True))
    turn = (qx - px) * (sy - ry) - (qy - py) * (sx - rx)
    t = F.try_divide((rx - px) * (sy - ry) - (ry - py) * (sx - rx), turn)
    point = lambda x, y: F.struct(F.round(x, DIGITS).alias("x"), F.round(y, DIGITS).alias("y"))
    within = lambda x, y: x.between(F.least(ax, bx), F.greatest(ax, bx)) & y.between(F.least(ay, by), F.greatest(ay, by))
    ends = F.filter(F.array(point(cx, cy), point(dx, dy)), lambda o: within(o["x"], o["y"]))
    cuts = F.when(turn == 0, ends).otherwise(F.array(point(px + t * (qx - px), py + t * (qy - py))))
    found = pairs.select(F.col("a_edge").alias("edge"), F.explode(cuts).alias("p")).groupBy("edge").agg(F.collect_set("p").alias("cuts"))
    all_ = labelled.join(found, "edge", "left")
    begin, end = point(F.col("x1"), F.col("y1")), point(F.col("x2"), F.col("y2"))
    away = lambda o: (o["x"] - F.col("x1")) * (F.col("x2") - F.col("x1")) + (o["y"] - F.col("y1")) * (F.col("y2") - F.col("y1"))
    chain = F.array_sort(F.transform(F.array_distinct(F.concat(F.array(begin, end), F.coalesce("cuts", F.array().cast("array<struct<x:double,y:double>>")))), lambda o: F.struct(away(o).alias("t"), o["x"].alias("x"), o["y"].alias("y"))))
    links = F.arrays_zip(F.slice("chain", 1, F.size("chain") - 1).alias("a"), F.slice("chain", 2, F.size("chain") - 1).alias("b"))
    each = all_.withColumn("chain", chain).select(group, "poly", F.explode(links).alias("e"))
    return each.select(group, "poly", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2")).filter("x1 <> x2 OR y1 <> y2")


def _stitched(edges: DataFrame, group: str) -> DataFrame:
    """(group, ring, place, x1, y1) of the corners of the rings that directed edges form, by pointer jumping.
    Where several edges leave a corner, the first clockwise from the way back continues, so that rings which
    touch stay apart."""
    named = materialized(edges.withColumn("id", F.xxhash64(group, *ENDS)))
    out = named.select(group, F.col("x1").alias("x2"), F.col("y1").alias("y2"), F.col("id").alias("next"), F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")).alias("out"))
    back = F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2"))
    turn = F.pmod(back - F.col("out"), F.lit(2 * 3.141592653589793))
    links = named.join(out, [group, "x2", "y2"]).groupBy("id").agg(F.min_by("next", F.struct(F.when(turn <= 1e-12, 7.0).otherwise(turn).alias("t"), F.col("next").alias("n"))).alias("next"))
    jumps = materialized(links.select("id", "next", F.least("id", "next").alias("ring")))
    while True:
        far = jumps.select(F.col("id").alias("next"), F.col("next").alias("far"), F.col("ring").alias("seen"))
        new = materialized(jumps.join(far, "next").select("id", F.col("far").alias("next"), F.least("ring", "seen").alias("ring"), (F.col("seen") < F.col("ring")).alias("moved")))
        jumps = new.drop("moved")
        if not new.filter("moved").take(1):
            break
    # places count the steps that are left to the ring's least edge
    ranks = materialized(links.join(jumps.select("id", "ring"), "id").select("id", "ring", F.when(F.col("next") != F.col("ring"), F.col("next")).alias("next"), F.lit(1).alias("left")))
    while ranks.filter("next is not null").take(1):
        far = ranks.select(F.col("id").alias("next"), F.col("next").alias("far"), F.col("left").alias("more"))
        ranks = materialized(ranks.join(far, "next", "left").select("id", "ring", F.col("far").alias("next"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left")))
    return named.join(ranks, "id").select(group, "ring", (-F.col("left")).alias("place"), "x1", "y1", "x2", "y2")


def dissolve(polygons: DataFrame, group: str, size: float) -> DataFrame:
    """(group, ring, rings corners): the outline of the union of each group's polygons, a row for each ring,
    outer ones counter-clockwise and holes clockwise, without corners on straight lines.

    Edges are cut where polygons meet.  Pieces inside another polygon go, opposite ones cancel, equal ones
    count once; what is left is stitched together.  Copies of a polygon count once from the start.
    """
    areas = decomposed(polygons.filter(F.col(group).isNotNull()).select(group, "rings").distinct(), [group], size)
    pieces = materialized(_cut(areas, group).withColumn("piece", F.xxhash64("poly", *ENDS)))
    middle = pieces.select("piece", ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))
    low = F.least(F.struct("x1", "y1"), F.struct(F.col("x2").alias("x1"), F.col("y2").alias("y1")))
    high = F.greatest(F.struct("x1", "y1"), F.struct(F.col("x2").alias("x1"), F.col("y2").alias("y1")))
    sides = pieces.withColumns({"low": low, "high": high})
    hits = containing(middle, "piece", areas).select("piece", F.col("poly").alias("other"))
    held = sides.join(hits, "piece").join(areas.rows.select(F.col("poly").alias("other"), F.col(group).alias("of")), "other").filter((F.col("of") == F.col(group)) & (F.col("other") != F.col("poly")))
    own = sides.select(group, "low", "high", F.col("poly").alias("other"))
    inner = held.join(own, [group, "low", "high", "other"], "left_anti").select("piece").distinct()
    kept = sides.join(inner, "piece", "left_anti")
    forward = (F.struct("x1", "y1") == F.col("low")).cast("int")
    once = kept.groupBy(group, "low", "high").agg(F.max(forward).alias("f"), F.max(1 - forward).alias("b")).filter("f + b = 1")
    pick = lambda a, b, c: F.when(F.col("f") == 1, F.col(f"{a}.{c}")).otherwise(F.col(f"{b}.{c}"))
    edges = once.select(group, pick("low", "high", "x1").alias("x1"), pick("low", "high", "y1").alias("y1"), pick("high", "low", "x1").alias("x2"), pick("high", "low", "y1").alias("y2"))
    corners = _stitched(edges, group)
    n = F.size("all")
    at = lambda i: F.element_at("all", i)
    before = lambda i: at(F.when(i == 0, n).otherwise(i))
    bent = lambda p, o, q: F.abs((o["x"] - p["x"]) * (q["y"] - o["y"]) - (o["y"] - p["y"]) * (q["x"] - o["x"])) > 1e-9
    rings = corners.groupBy(group, "ring").agg(F.array_sort(F.collect_list(F.struct("place", F.col("x1").alias("x"), F.col("y1").alias("y")))).alias("all"))
    turning = F.filter("all", lambda p, i: bent(before(i), p, at(F.when(i == n - 1, 1).otherwise(i + 2))))
    return rings.select(group, "ring", F.transform(turning, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("corners"))
