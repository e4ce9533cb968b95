"""Spatial joins as equi-joins on square buckets.

No join here compares all rows with all: a row meets only what lies in its own or a neighbouring
bucket.  Points carry one bucket; targets (points, segments, boxes) are dealt to every bucket that
they can be met from.  Dense buckets are left to adaptive skew handling, which may split them, since
the joins are plain hash-partitioned equi-joins.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import clip_convex, distance2, on_edge, ring_area, ring_box, rings_contain, segment_distance2
from ..sources.shared import materialized
from .polygons import containing, decomposed, shares


def _bucket(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("long")


def bucketed(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """The bucket (bx, by) of each point."""
    return df.withColumn("bx", _bucket(F.col(x), size)).withColumn("by", _bucket(F.col(y), size))


def dealt(df: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column, size: float) -> DataFrame:
    """One row for every bucket that a box touches."""
    span = lambda a, b: F.explode(F.sequence(_bucket(a, size), _bucket(b, size)))
    return df.withColumn("bx", span(x0, x1)).withColumn("by", span(y0, y1))


def dealt_along(df: DataFrame, x1: Column, y1: Column, x2: Column, y2: Column, size: float) -> DataFrame:
    """One row for every bucket that lies within a bucket's size of a segment.  Rows follow the line column
    by column, so a long diagonal costs its length in buckets, not the square of it."""
    strip = df.withColumn("bx", F.explode(F.sequence(_bucket(F.least(x1, x2) - size, size), _bucket(F.greatest(x1, x2) + size, size))))
    along = lambda edge: F.when(x1 == x2, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (edge - x1) / (x2 - x1))))
    at = lambda t: y1 + t * (y2 - y1)
    near, far = at(along((F.col("bx") - 1) * size)), at(F.when(x1 == x2, 1.0).otherwise(along((F.col("bx") + 2) * size)))
    return strip.withColumn("by", F.explode(F.sequence(_bucket(F.least(near, far) - size, size), _bucket(F.greatest(near, far) + size, size))))


def _extent(points: DataFrame, targets: DataFrame, corners: Sequence[str]) -> tuple[float, float, float, int]:
    """The least corner and the longer side of the box around everything, and how many targets there are."""
    xs, ys = corners[0::2], corners[1::2]
    p = points.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    t = targets.agg(*(f(c) for c in xs for f in (F.min, F.max)), *(f(c) for c in ys for f in (F.min, F.max)), F.count("*")).first()
    if p[0] is None or t[0] is None:
        return 0.0, 0.0, 0.0, 0
    n = 2 * len(xs)
    x, y = (p[0], p[1], *t[:n]), (p[2], p[3], *t[n : 2 * n])
    return float(min(x)), float(min(y)), float(max(max(x) - min(x), max(y) - min(y))), t[2 * n]


#: A cell of the descent has FANOUT x FANOUT cells of the next level.
FANOUT = 8
#: Levels of the descent: point targets are cut finer than their number asks for, where they crowd.
MAX_LEVELS = 6
CROWD = 64


def _descended(left: DataFrame, targets: DataFrame, corners: Sequence[str], d2: Column, attrs: Sequence[str], key: str, extent: tuple[float, float, float, int]) -> DataFrame:
    """Exact nearest target of points that have none near them, by descent through a pyramid of cells.

    A level's cells are those that hold a target.  A point keeps the cells whose least distance is no more
    than the smallest of the greatest distances, since one of those holds its nearest target; only their
    cells of the next level are looked at.  So a point meets a few cells a level and the targets of the last
    ones, wherever the targets crowd, and no bucket gathers all points and all targets.
    """
    x0, y0, side, count = extent
    side = side * 1.001 or 1.0
    same = targets.groupBy(*corners).agg(F.min(F.struct(*(F.col(a) for a in attrs), F.lit(0).alias("_"))).alias("a"))  # equal places count once
    ends = [F.col(c) - (x0, y0)[i % 2] for i, c in enumerate(corners)]
    size = lambda level: side / FANOUT**level
    placed = lambda level: dealt_along(same, *ends, size(level)) if len(ends) == 4 else dealt(same, *ends, *ends, size(level))
    levels = 1
    while levels < MAX_LEVELS and FANOUT ** (2 * levels) * 4 < count:
        levels += 1
    bits = FANOUT.bit_length() - 1
    up = lambda level: [F.shiftright(c, bits * (levels - level)).alias(c) for c in ("bx", "by")]
    while True:
        leaves = materialized(placed(levels))
        cells = materialized(leaves.groupBy("bx", "by").agg(F.count("*").alias("n")))
        top = cells.groupBy(*up(1)).agg(F.max("n").alias("n")).collect()  # the cells of the first level, 144 at most
        if len(ends) == 4 or levels == MAX_LEVELS or max((r.n for r in top), default=0) <= CROWD:
            break
        levels += 1
    x, y = F.col("x") - x0, F.col("y") - y0
    # a segment is dealt to cells up to a cell's size beside it, on the last level
    margin = 2 * size(levels) if len(ends) == 4 else 0.0

    def gap(v: Column, cell: Column, wide: float) -> tuple[Column, Column]:
        low, high = cell * wide, (cell + 1) * wide
        return F.greatest(low - v, v - high, F.lit(0.0)), F.greatest(F.abs(v - low), F.abs(v - high)) + margin

    first = F.array(*(F.struct(F.lit(r.bx).cast("long").alias("bx"), F.lit(r.by).cast("long").alias("by")) for r in top))
    open_ = left.select(key, "x", "y", F.explode(first).alias("c")).select(key, "x", "y", "c.*")
    for level in range(1, levels + 1):
        if level > 1:
            below = cells.select(*up(level)).distinct().select(F.shiftright("bx", bits).alias("px"), F.shiftright("by", bits).alias("py"), "bx", "by")
            open_ = open_.withColumnsRenamed({"bx": "px", "by": "py"}).join(below, ["px", "py"]).select(key, "x", "y", "bx", "by")
        (nx, fx), (ny, fy) = gap(x, F.col("bx"), size(level)), gap(y, F.col("by"), size(level))
        seen = open_.withColumns({"near": nx * nx + ny * ny, "far": fx * fx + fy * fy})
        kept = seen.groupBy(key, "x", "y").agg(F.min("far").alias("most"), F.collect_list(F.struct("bx", "by", "near")).alias("cells"))
        kept = kept.select(key, "x", "y", F.explode(F.filter("cells", lambda c: c["near"] <= F.col("most") * (1 + 1e-9) + 1e-9)).alias("c"))
        open_ = kept.select(key, "x", "y", "c.bx", "c.by")
        if level % 2 == 0 and level < levels:
            open_ = materialized(open_)
    met = open_.join(leaves.select("bx", "by", *corners, *(F.col(f"a.{a}") for a in attrs if a not in corners)), ["bx", "by"])
    return met.groupBy(key).agg(F.min(F.struct(d2.alias("d2"), *attrs)).alias("n")).select(key, "n.*")


def _pairs(points: DataFrame, near: DataFrame, radius: float) -> int:
    """How many rows a join of points and dealt targets makes, from the counts of their buckets alone."""
    p = bucketed(points, "x", "y", radius).groupBy("bx", "by").agg(F.count("*").alias("p"))
    return p.join(near.groupBy("bx", "by").agg(F.count("*").alias("t")), ["bx", "by"]).agg(F.sum(F.col("p") * F.col("t"))).first()[0] or 0


#: Rows that a task of the nearest join makes, roughly.
TASK_ROWS = 500_000


def _split(points: DataFrame, near: DataFrame, rows: int) -> DataFrame:
    """The join of points and dealt targets in as many partitions as its rows ask for; a frame that is longer
    than its table, like the dealt one, is never broadcast."""
    parts = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    return points.repartition(parts, "bx", "by").join(near.repartition(parts, "bx", "by").hint("merge"), ["bx", "by"])


#: Rows that a further round of the nearest join may make for each target; beyond them points descend.
WIDEST = 64


def _nearest(points: DataFrame, targets: DataFrame, corners: Sequence[str], d2: Column, attrs: Sequence[str], key: str, radius: float, growth: float) -> DataFrame:
    """Exact nearest target of every point.  A hit within the searched radius is final.  The other points go
    on with a greater radius as long as the join stays linear in the targets, by counts of both sides'
    buckets; else they descend through a pyramid of cells.  The first radius is the given one, or a smaller
    one where so many targets lie evenly in the whole box that about a dozen are within it; so a bucket's
    targets stay few however many there are.  Points of one place are searched for once, and equal targets
    are one with the least attributes; partitions follow the rows that a join makes."""
    places = materialized(points.filter("x is not null and y is not null").select("x", "y").distinct())
    held = [a for a in attrs if a not in corners]
    same = targets.groupBy(*corners).agg(F.min(F.struct(*(F.col(a) for a in attrs), F.lit(0).alias("_"))).alias("a"))
    targets = materialized(same.select(*corners, *(F.col(f"a.{a}") for a in held)))
    found = _nearest_of_place(places.withColumn("place", F.struct("x", "y")), targets, corners, d2, attrs, "place", radius, growth)
    return points.select(key, "x", "y").join(found.select("place.x", "place.y", "d2", *attrs), ["x", "y"], "left").select(key, "d2", *attrs)


def _nearest_of_place(points: DataFrame, targets: DataFrame, corners: Sequence[str], d2: Column, attrs: Sequence[str], key: str, radius: float, growth: float) -> DataFrame:
    """The rounds of the nearest join, for points that have a target if there is any."""
    extent = _extent(points, targets, corners)
    whole, count = extent[2:]
    if whole and count:
        radius = min(radius, whole * (4 / count) ** 0.5)
    ends = [F.col(c) for c in corners]
    spread = lambda: dealt_along(targets, *ends, radius) if len(ends) == 4 else dealt(targets, ends[0] - radius, ends[1] - radius, ends[0] + radius, ends[1] + radius, radius)
    left, near, found = points.select(key, "x", "y"), spread(), None
    rows = _pairs(left, near, radius)
    while True:
        best = _split(bucketed(left, "x", "y", radius), near, rows).groupBy(key).agg(F.min(F.struct(d2.alias("d2"), *attrs)).alias("n"))
        hits = best if radius > whole else best.filter(F.col("n.d2") <= radius * radius)
        hits = materialized(hits.select(key, "n.*"))
        found = hits if found is None else found.unionByName(hits)
        if radius > whole or not count:
            return found
        left = materialized(left.join(hits.select(key), key, "left_anti"))
        if not left.take(1):
            return found
        radius *= growth
        near = spread()
        rows = _pairs(left, near, radius)
        if rows > WIDEST * count:
            return found.unionByName(_descended(left, targets, corners, d2, attrs, key, extent))


def nearest(points: DataFrame, sites: DataFrame, key: str, attrs: Sequence[str], radius: float, growth: float = 3.0) -> DataFrame:
    """Each point (key, x, y) with d2 and the attributes of its nearest site (sx, sy, ...); among equals
    the least attributes count.  Without sites, or for a point without coordinates, they are null."""
    return _nearest(points, sites.select("sx", "sy", *(a for a in attrs if a not in ("sx", "sy"))), ["sx", "sy"], distance2(F.col("x"), F.col("y"), F.col("sx"), F.col("sy")), attrs, key, radius, growth)


def nearest_segment(points: DataFrame, segments: DataFrame, key: str, attrs: Sequence[str], radius: float, growth: float = 3.0) -> DataFrame:
    """Each point with the squared distance to its nearest segment (x1, y1, x2, y2, ...)."""
    d2 = segment_distance2(F.col("x"), F.col("y"), F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    return _nearest(points, segments.select("x1", "y1", "x2", "y2", *attrs), ["x1", "y1", "x2", "y2"], d2, attrs, key, radius, growth)


def within(points: DataFrame, sites: DataFrame, key: str, radius: float, aggs: Sequence[Column]) -> DataFrame:
    """Aggregates over the sites within a radius of each point; points without any are absent."""
    near = dealt(sites, F.col("sx") - radius, F.col("sy") - radius, F.col("sx") + radius, F.col("sy") + radius, radius)
    pairs = bucketed(points.select(key, "x", "y"), "x", "y", radius).join(near, ["bx", "by"])
    return pairs.filter(distance2(F.col("x"), F.col("y"), F.col("sx"), F.col("sy")) <= radius * radius).groupBy(key).agg(*aggs)


#: Polygons of more corners are taken apart; smaller ones are rows small enough to travel whole.
WHOLE_CORNERS = 256


def _by_size(polygons: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Polygons that may travel whole, and those (if any) that may not."""
    corners = F.aggregate("rings", F.lit(0), lambda n, ring: n + F.size(ring))
    large = polygons.filter(corners > WHOLE_CORNERS)
    return polygons.filter(corners <= WHOLE_CORNERS), large if large.take(1) else None


def in_polygon(points: DataFrame, polygons: DataFrame, key: str, attrs: Sequence[str], size: float, edges: bool = False, pick: Callable[[Column], Column] = F.min) -> DataFrame:
    """Each point with the attributes of the polygon (`rings`) that holds it; of several the one that
    `pick` finds among the attribute structs; none gives nulls.  `edges` lets boundaries count.  Polygons of
    many corners are met by their edges and whole cells, never as one row."""
    small, large = _by_size(polygons)
    boxed = small.withColumn("box", ring_box(F.flatten("rings")))
    spread = dealt(boxed, F.col("box.x0"), F.col("box.y0"), F.col("box.x1"), F.col("box.y1"), size)
    x, y = F.col("x"), F.col("y")
    pairs = bucketed(points.select(key, "x", "y"), "x", "y", size).join(spread.select("bx", "by", "rings", "box", *attrs), ["bx", "by"])
    pairs = pairs.filter(x.between(F.col("box.x0"), F.col("box.x1")) & y.between(F.col("box.y0"), F.col("box.y1")))
    touch = on_edge(F.col("rings"), x, y)
    inside = (rings_contain(F.col("rings"), x, y) | touch) if edges else (rings_contain(F.col("rings"), x, y) & ~touch)
    hits = pairs.filter(inside).select(key, *attrs)
    if large is not None:
        areas = decomposed(large, attrs, size)
        found = containing(points, key, areas)
        hits = hits.unionByName((found if edges else found.filter("touch = 0")).join(areas.rows, "poly").select(key, *attrs))
    best = hits.groupBy(key).agg(pick(F.struct(*attrs)).alias("p")).select(key, "p.*")
    return points.select(key).join(best, key, "left")


def in_box(x: Column, y: Column, boxes: Sequence[tuple[str, float, float, float, float]]) -> Column:
    """The name of the first box (name, x0, x1, y0, y1) that holds a point, edges included."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, x0, x1, y0, y1 in boxes:
        out = out.when(x.between(x0, x1) & y.between(y0, y1), name)
    return out


def overlay(cells: DataFrame, polygons: DataFrame, key: str, name: str, code: str, size: float) -> DataFrame:
    """Each cell (convex, counter-clockwise `ring`) with the share of its area under polygons, 1 at most, the
    name of the largest piece and the least code; 0 and nulls without any.

    A polygon has one `outer` ring, or `rings`: parts counter-clockwise, holes clockwise, as signed areas.
    Pairs are found by the polygons' boxes alone; the rings are joined to the pairs afterwards, so they
    are not copied into every bucket.  Polygons of many corners are summed up edge by edge instead.
    """
    c = cells.withColumn("box", ring_box(F.col("ring")))
    left = dealt(c, F.col("box.x0"), F.col("box.y0"), F.col("box.x1"), F.col("box.y1"), size).select(key, "bx", "by")
    p, large = _by_size(polygons.withColumn("rings", F.col("rings") if "rings" in polygons.columns else F.array("outer")))
    p = p.withColumn("_rings", F.col("rings"))
    boxes = p.select("poly_id", ring_box(F.flatten("_rings")).alias("box"))
    right = dealt(boxes, F.col("box.x0"), F.col("box.y0"), F.col("box.x1"), F.col("box.y1"), size).select("poly_id", "bx", "by")
    pairs = left.join(right, ["bx", "by"]).select(key, "poly_id").distinct()
    held = pairs.join(cells.select(key, "ring"), key).join(p.select("poly_id", "_rings", name, code), "poly_id")
    area = F.abs(F.aggregate("_rings", F.lit(0.0), lambda total, ring: total + F.coalesce(ring_area(clip_convex(ring, F.col("ring"))), F.lit(0.0))))
    pieces = held.withColumn("piece", area).filter("piece > 0").withColumn("whole", F.abs(ring_area(F.col("ring"))))
    pieces = pieces.select(key, "piece", "whole", name, code)
    if large is not None:
        areas = decomposed(large, [name, code], size)
        cut = shares(cells, key, areas).filter("piece > 1e-9 * area").join(areas.rows, "poly")
        pieces = pieces.unionByName(cut.select(key, "piece", F.col("area").alias("whole"), name, code))
    out = pieces.groupBy(key).agg((F.sum("piece") / F.max("whole")).alias("share"), F.max_by(F.col(name), F.struct("piece", F.col(name))).alias(name), F.min(code).alias(code))
    joined = cells.select(key).join(out, key, "left")
    return joined.withColumn("share", F.least(F.lit(1.0), F.coalesce("share", F.lit(0.0))))


def close_pairs(df: DataFrame, key: str, radius: float) -> DataFrame:
    """Pairs a < b of rows within a radius of each other, with both rows' other columns as a_, b_."""
    others = [c for c in df.columns if c not in (key,)]
    a = bucketed(df, "x", "y", radius).select("bx", "by", F.col(key).alias("a"), *(F.col(c).alias(f"a_{c}") for c in others))
    b = dealt(df, F.col("x") - radius, F.col("y") - radius, F.col("x") + radius, F.col("y") + radius, radius).select("bx", "by", F.col(key).alias("b"), *(F.col(c).alias(f"b_{c}") for c in others))
    return a.join(b, ["bx", "by"]).filter("a < b").filter(distance2(F.col("a_x"), F.col("a_y"), F.col("b_x"), F.col("b_y")) <= radius * radius).drop("bx", "by")
