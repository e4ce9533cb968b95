"""Queries over concave, holed and overlapping polygons, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import grid, polygons, raster
from . import layers as L

Q: dict = {}


def query(sql: str):
    def add(f):
        Q[f.__name__] = (f, sql)
        return f

    return add


def _ring(*points):
    """A ring around the place (ox, oy)."""
    return F.array(*(F.struct((F.col("ox") + float(x)).alias("x"), (F.col("oy") + float(y)).alias("y")) for x, y in points))


def places(spark, d) -> DataFrame:
    return L.table(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_nationkey AS nation", "cast((s_suppkey * 613) % 970 * 100 AS double) AS ox", "cast((s_suppkey * 357) % 970 * 100 AS double) AS oy")


PLACES = "places AS (SELECT s_suppkey AS id, s_nationkey AS nation, CAST((s_suppkey * 613) % 970 * 100 AS DOUBLE) AS ox, CAST((s_suppkey * 357) % 970 * 100 AS DOUBLE) AS oy FROM supplier)"


def shapes(spark, d) -> DataFrame:
    """A U of 3 km with a hole at the foot for every supplier."""
    outer = _ring((0, 0), (3000, 0), (3000, 3000), (2000, 3000), (2000, 1000), (1000, 1000), (1000, 3000), (0, 3000))
    hole = _ring((400, 300), (400, 700), (800, 700), (800, 300))
    return places(spark, d).select("id", "nation", F.array(outer, hole).alias("rings"))


def _inside(x: str, y: str) -> str:
    return f"{x} >= 0 AND {x} < 3000 AND {y} >= 0 AND {y} < 3000 AND NOT ({x} >= 1000 AND {x} < 2000 AND {y} >= 1000) AND NOT ({x} >= 400 AND {x} < 800 AND {y} >= 300 AND {y} < 700)"


@query(f"WITH {L.PIXELS}, {PLACES} SELECT p.id, count(*) AS pixels, CAST(sum(x.value) AS BIGINT) AS total, CAST(max(x.value) AS BIGINT) AS most FROM places p JOIN pixels x ON {_inside('(x.col + 0.5e0) * 400 - ox', '120000 - (x.row + 0.5e0) * 400 - oy')} GROUP BY p.id")
def zone_shapes(spark, d):
    """Pixels of 400 m assigned to the shapes that hold their centre, and their statistics."""
    zoned = polygons.with_zone(L.pixels(spark, d), shapes(spark, d), "id", 0.0, 120_000.0, 400.0, 400.0)
    stats = raster.zonal_stats(shapes(spark, d).select("id"), zoned, "id", more=[F.sum("value").alias("total")]).filter("pixels > 0")
    return stats.select("id", "pixels", F.col("total").cast("long").alias("total"), F.col("most").cast("long").alias("most"))


@query(f"WITH {L.POINTS}, {PLACES} SELECT p.id, count(*) AS n FROM places p JOIN points c ON {_inside('c.x + 0.5e0 - ox', 'c.y + 0.5e0 - oy')} GROUP BY p.id")
def shape_points(spark, d):
    """Points in each shape, by whole and partial cells of a quadtree."""
    points = L.points(spark, d).select((F.col("x") + 0.5).alias("x"), (F.col("y") + 0.5).alias("y"))
    return polygons.counted(points, shapes(spark, d), "id", 500.0)


@query(f"WITH {PLACES}, all_cells AS (SELECT r, unnest(range(CAST(-r // 2 - 2 AS BIGINT), CAST(330 - r // 2 AS BIGINT))) AS q FROM (SELECT unnest(range(-2, 350)) AS r)), centres AS (SELECT q, r, (q + r / 2) * (1.7320508075688772e0 * 200e0) AS x, r * 300e0 AS y FROM all_cells WHERE (q + r / 2) BETWEEN -1 AND 320) SELECT DISTINCT 'h_' || q || '_' || r AS cell_id FROM centres c JOIN places p ON {_inside('c.x - ox', 'c.y - oy')}")
def shape_cells(spark, d):
    """Cells of 200 m that fill the shapes, overlapping ones among them."""
    return grid.fill(shapes(spark, d), 200.0).select("cell_id")


def stacks(spark, d) -> DataFrame:
    """Overlapping and adjoining boxes, a few dozen of each nation."""
    k = F.col("id")
    at = places(spark, d).select("id", "nation", (k * 37 % 60).cast("double").alias("ox"), (k * 53 % 60).cast("double").alias("oy"), (3 + k % 4).alias("w"), (2 + k % 5).alias("h"))
    corner = lambda x, y: F.struct((F.col("ox") + x).alias("x"), (F.col("oy") + y).alias("y"))
    ring = F.array(corner(F.lit(0), F.lit(0)), corner(F.col("w"), F.lit(0)), corner(F.col("w"), F.col("h")), corner(F.lit(0), F.col("h")))
    return at.select("id", "nation", F.array(ring).alias("rings"))


@query("""WITH b AS (SELECT s_suppkey AS k, s_nationkey AS nation FROM supplier), u AS (SELECT k, nation, unnest(range(k * 37 % 60, k * 37 % 60 + 3 + k % 4)) AS x FROM b),
c AS (SELECT DISTINCT nation, x, unnest(range(k * 53 % 60, k * 53 % 60 + 2 + k % 5)) AS y FROM u), s AS (SELECT * FROM (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) AS s(dx, dy)),
o AS (SELECT c.nation, count(*) AS n FROM c CROSS JOIN s LEFT JOIN c e ON e.nation = c.nation AND e.x = c.x + dx AND e.y = c.y + dy WHERE e.x IS NULL GROUP BY c.nation)
SELECT a.nation, a.area, o.n AS outline FROM (SELECT nation, count(*) AS area FROM c GROUP BY nation) a JOIN o ON a.nation = o.nation""")
def dissolved_shapes(spark, d):
    """Area and length of the outline of the union of each nation's boxes."""
    rings = polygons.dissolve(stacks(spark, d), "nation", 4.0)
    from ..functions.geo import ring_area, ring_edges

    long = F.aggregate(ring_edges(F.col("corners")), F.lit(0.0), lambda s, e: s + F.abs(e["a"]["x"] - e["b"]["x"]) + F.abs(e["a"]["y"] - e["b"]["y"]))
    return rings.groupBy("nation").agg(F.sum(ring_area(F.col("corners"))).cast("long").alias("area"), F.sum(long).cast("long").alias("outline"))


@query("SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 9 > 3")
def simple_shapes(spark, d):
    """Shapes that are simple: of every nine one is a bow-tie, one has a hole that crosses its outline, one a
    hole that touches it, and one two holes that meet."""
    at = places(spark, d)
    outer = _ring((0, 0), (3000, 0), (3000, 3000), (0, 3000))
    box = lambda x0, y0, x1, y1: _ring((x0, y0), (x0, y1), (x1, y1), (x1, y0))
    k = F.col("id") % 9
    rings = F.when(k == 0, F.array(_ring((0, 0), (3000, 3000), (3000, 0), (0, 2000)))).when(k == 1, F.array(outer, box(2500, 100, 3500, 900))).when(k == 2, F.array(outer, box(0, 100, 900, 900)))
    rings = rings.when(k == 3, F.array(outer, box(100, 100, 900, 900), box(500, 500, 1500, 1500))).otherwise(F.array(outer, box(100, 100, 900, 900)))
    return polygons.valid(at.withColumn("rings", rings), "id", 1000.0).select("id")
