"""Queries over cells, spatial joins and duplicates, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import dedupe, disks, grid, spatial
from . import features
from . import layers as L

Q: dict = {}


def query(sql: str):
    def add(f):
        Q[f.__name__] = (f, sql)
        return f

    return add


CELLS = L.cells_sql("points", "cells")
RING_STEPS = "(VALUES (1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1)) AS s(dq, dr)"


@query(f"WITH {L.POINTS}, {CELLS} SELECT id, q, r, cell_id FROM cells")
def point_cells(spark, d):
    """The cell of every point."""
    return grid.with_cells(L.points(spark, d), L.EDGE).select("id", "q", "r", "cell_id")


LATTICE = f"""{L.POINTS}, e AS (SELECT 100000e0 / sqrt(count(*)) AS edge, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM points), rows_ AS (SELECT *, unnest(range(-2, CAST(y1 / (1.5e0 * edge) AS BIGINT) + 3)) AS r FROM e),
lat AS (SELECT *, (q + r / 2e0) * (1.7320508075688772e0 * edge) AS x, r * (1.5e0 * edge) AS y FROM (SELECT *, unnest(range(-r // 2 - 3, CAST(x1 / edge AS BIGINT) + 3)) AS q FROM rows_))"""


def edge_for(points):
    """An edge that makes cells as many as points, roughly."""
    return 100000.0 / points.count() ** 0.5


@query(f"WITH {LATTICE} SELECT CAST(q AS BIGINT) AS q, CAST(r AS BIGINT) AS r, 'h_' || q || '_' || r AS cell_id FROM lat WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1")
def hex_lattice(spark, d):
    """Cells with centres in the points' box, about as many as points."""
    p = L.points(spark, d)
    box = grid.bounding_box(p).first()
    return grid.lattice(spark, *box, edge_for(p)).select("q", "r", "cell_id")


@query(f"WITH {LATTICE}, {L.BOXES} SELECT 'h_' || q || '_' || r AS cell_id, CAST(floor(x + 0.437e0) AS BIGINT) AS x, CAST(floor(y + 0.437e0) AS BIGINT) AS y, 6 AS corners FROM lat l WHERE EXISTS (SELECT 1 FROM boxes b WHERE b.code <> 2 AND l.x > b.x0 AND l.x < b.x1 AND l.y > b.y0 AND l.y < b.y1)")
def job_grid(spark, d):
    """Cells that fill a boundary dissolved from the polygons of four regions."""
    layer = L.boxes(spark, d).withColumn("region", F.col("code").cast("string"))
    out = features.build_grid(layer, ["NAME", "region"], ["0", "1", "3", "4"], edge_for(L.points(spark, d)))
    q = lambda c: F.floor(F.col(c) + 0.437).cast("long").alias(c)
    return out.select("cell_id", q("x"), q("y"), F.size("ring").alias("corners"))


@query(
    f"""WITH {L.POINTS}, {CELLS}, u AS (SELECT DISTINCT q, r, cell_id FROM cells)
SELECT cell_id, CAST(floor(((q + r / 2e0) * (1.7320508075688772e0 * 2000e0)) * 10 + 0.5e0) AS BIGINT) AS cx, CAST(r * 30000 AS BIGINT) AS cy, CAST(floor(6 * 2000e0 * 2000e0 * 1.7320508075688772e0 / 4 + 0.5e0) AS BIGINT) AS area, 6 AS corners FROM u"""
)
def hex_ring(spark, d):
    """Centres, corners and areas of the occupied cells."""
    u = grid.with_rings(grid.with_cells(L.points(spark, d), L.EDGE).select("q", "r", "cell_id").distinct(), L.EDGE)
    c = geo.ring_centroid(F.col("ring"))
    q = lambda v, k: F.floor(v * k + 0.5).cast("long")
    return u.select("cell_id", q(geo.hex_center(F.col("q"), F.col("r"), L.EDGE)[0], 10).alias("cx"), q(c["y"], 10).alias("cy"), q(geo.ring_area(F.col("ring")), 1).alias("area"), F.size("ring").alias("corners"))


@query(f"WITH {L.POINTS}, {CELLS}, u AS (SELECT DISTINCT q, r FROM cells WHERE balance > 9000) SELECT DISTINCT CAST(q + dq AS BIGINT) AS q, CAST(r + dr AS BIGINT) AS r, 'h_' || (q + dq) || '_' || (r + dr) AS cell_id FROM u, {RING_STEPS}")
def cell_neighbors(spark, d):
    """Cells around those of the richest customers."""
    return grid.neighbours(grid.with_cells(L.points(spark, d).filter("balance > 9000"), L.EDGE))


@query(f"WITH {L.POINTS}, ll AS (SELECT id, 20 + x / 2500 AS lat, -130 + y / 1400 AS lon FROM points) SELECT id, CAST(lat BETWEEN 24 AND 50 AND lon BETWEEN -125 AND -66 AS INTEGER) AS is_conus FROM ll")
def conus_box(spark, d):
    """Points inside the box of the contiguous states."""
    df = L.points(spark, d).select("id", (20 + F.col("x") / 2500).alias("lat"), (-130 + F.col("y") / 1400).alias("lon"))
    return grid.conus_flag(df).select("id", "is_conus")


@query(f"WITH {L.POINTS} SELECT id, CAST(greatest(0, ceil(x / 12500e0) - 1) AS BIGINT) AS tx, CAST(greatest(0, ceil(y / 12500e0) - 1) AS BIGINT) AS ty FROM points")
def tile_assign(spark, d):
    """Tiles of 12.5 km; shared edges belong to the lower tile."""
    return grid.tiles(L.points(spark, d), "x", "y", 0.0, 0.0, 12500.0).select("id", "tx", "ty")


def parcels(spark, d):
    """An L-shaped parcel for every point: w by h with the upper right corner, of w - v by h - u, cut out."""
    k = F.col("id")
    df = L.points(spark, d).select("id", "x", "y", (k % 7 * 100 + 300).cast("double").alias("w"), (k % 5 * 80 + 260).cast("double").alias("h"), (k % 3 * 40 + 50).cast("double").alias("v"), (k % 4 * 30 + 70).cast("double").alias("u"))
    at = lambda a, b: F.struct((F.col("x") + a).alias("x"), (F.col("y") + b).alias("y"))
    w, h, v, u, o = F.col("w"), F.col("h"), F.col("v"), F.col("u"), F.lit(0.0)
    return df.withColumn("ring", F.array(at(o, o), at(w, o), at(w, u), at(v, u), at(v, h), at(o, h)))


PARCELS = f"{L.POINTS}, parcels AS (SELECT id, x, y, id % 7 * 100e0 + 300 AS w, id % 5 * 80e0 + 260 AS h, id % 3 * 40e0 + 50 AS v, id % 4 * 30e0 + 70 AS u FROM points)"


@query(f"WITH {PARCELS}, a AS (SELECT *, w * u AS a1, v * (h - u) AS a2 FROM parcels) SELECT id, CAST(a1 + a2 AS BIGINT) AS area, CAST(floor(x + (a1 * w / 2 + a2 * v / 2) / (a1 + a2) + 0.437e0) AS BIGINT) AS cx, CAST(floor(y + (a1 * u / 2 + a2 * (u + h) / 2) / (a1 + a2) + 0.437e0) AS BIGINT) AS cy FROM a")
def polygon_area(spark, d):
    """Area and centroid of the parcels, which are concave."""
    c = geo.ring_centroid(F.col("ring"))
    q = lambda v: F.floor(v + 0.437).cast("long")
    return parcels(spark, d).select("id", F.round(geo.ring_area(F.col("ring"))).cast("long").alias("area"), q(c["x"]).alias("cx"), q(c["y"]).alias("cy"))


@query(f"WITH {L.POINTS} SELECT id FROM points WHERE id % 5 NOT IN (1, 2, 3)")
def geometry_filter(spark, d):
    """Parcels left after some were cut short, flattened or emptied."""
    df = parcels(spark, d)
    none = F.lit(None).cast(df.schema["ring"].dataType)
    flat = F.transform("ring", lambda p: F.struct(p["x"].alias("x"), F.lit(0.0).alias("y")))
    k = F.col("id") % 5
    return grid.valid_polygons(df.withColumn("ring", F.when(k == 1, F.slice("ring", 1, 2)).when(k == 2, flat).when(k == 3, none).otherwise(F.col("ring")))).select("id")


@query(f"WITH {PARCELS}, j AS (SELECT p.id, max(a.id) AS parcel FROM points p JOIN parcels a ON p.x > a.x AND p.y > a.y AND ((p.x < a.x + a.w AND p.y < a.y + a.u) OR (p.x < a.x + a.v AND p.y < a.y + a.h)) GROUP BY 1) SELECT p.id, coalesce(j.parcel, -1) AS parcel FROM points p LEFT JOIN j ON j.id = p.id")
def point_in_parcel(spark, d):
    """The greatest parcel, all of them concave, that holds each point."""
    areas = parcels(spark, d).select(F.col("id").alias("parcel"), F.array("ring").alias("rings"))
    return spatial.in_polygon(L.points(spark, d), areas, "id", ["parcel"], 800.0, pick=F.max).select("id", F.coalesce("parcel", F.lit(-1)).alias("parcel"))


@query(f"WITH {L.POINTS} SELECT min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM points")
def layer_bbox(spark, d):
    """The points' bounding box."""
    return grid.bounding_box(L.points(spark, d))


@query(
    f"""WITH {L.POINTS}, ll AS (SELECT id, -120 + x / 2000 AS lon, 25 + y / 4500 AS lat FROM points)
SELECT id, CAST(floor(radians(lon) * 6378137e0 / 100 + 0.5e0) AS BIGINT) AS mx, CAST(floor(ln(tan(radians(lat) / 2 + 0.7853981633974483e0)) * 6378137e0 / 100 + 0.5e0) AS BIGINT) AS my FROM ll"""
)
def project_points(spark, d):
    """Web-Mercator coordinates in hundreds of metres."""
    ll = L.points(spark, d).select("id", (-120 + F.col("x") / 2000).alias("lon"), (25 + F.col("y") / 4500).alias("lat"))
    q = lambda v: F.floor(v / 100 + 0.5).cast("long")
    return ll.select("id", q(geo.mercator_x(F.col("lon"))).alias("mx"), q(geo.mercator_y(F.col("lat"))).alias("my"))


NEAREST = "n AS (SELECT id, site, site_name, d2, row_number() OVER (PARTITION BY id ORDER BY d2, site) AS k FROM (SELECT p.id, s.site, s.site_name, (p.x - s.sx) * (p.x - s.sx) + (p.y - s.sy) * (p.y - s.sy) AS d2 FROM points p, sites s))"


@query(f"WITH {L.POINTS}, {L.SITES}, {NEAREST} SELECT id, CAST(d2 AS BIGINT) AS d2 FROM n WHERE k = 1")
def nearest_point(spark, d):
    """Squared distance to the nearest site."""
    return spatial.nearest(L.points(spark, d), L.sites(spark, d), "id", ["site"], 4000.0).select("id", F.col("d2").cast("long").alias("d2"))


@query(f"WITH {L.POINTS}, {L.SITES}, {NEAREST} SELECT id, site, site_name, CAST(floor(sqrt(d2) + 0.5e0) AS BIGINT) AS metres FROM n WHERE k = 1")
def nearest_with_attrs(spark, d):
    """The nearest site with its name."""
    return spatial.nearest(L.points(spark, d), L.sites(spark, d), "id", ["site", "site_name"], 4000.0).select("id", "site", "site_name", F.floor(F.sqrt("d2") + 0.5).cast("long").alias("metres"))


@query(
    f"""WITH {L.POINTS}, {L.SEGMENTS}, t AS (SELECT id, x, y, s.*, (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) AS l2, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) AS dot FROM points p, segments s),
u AS (SELECT id, x, y, x1, y1, x2, y2, CASE WHEN l2 = 0 THEN 0e0 ELSE least(1e0, greatest(0e0, dot / l2)) END AS t FROM t)
SELECT id, CAST(floor(sqrt(min((x - (x1 + t * (x2 - x1))) * (x - (x1 + t * (x2 - x1))) + (y - (y1 + t * (y2 - y1))) * (y - (y1 + t * (y2 - y1))))) * 100 + 0.5e0) AS BIGINT) AS centimetres FROM u GROUP BY id"""
)
def nearest_segment(spark, d):
    """Distance to the nearest segment."""
    return spatial.nearest_segment(L.points(spark, d), L.segments(spark, d), "id", [], 4000.0).select("id", F.floor(F.sqrt("d2") * 100 + 0.5).cast("long").alias("centimetres"))


@query(f"WITH {L.POINTS}, {L.SITES} SELECT p.id, CAST(coalesce(sum(mw), 0) AS BIGINT) AS mw, count(site) AS n_sites FROM points p LEFT JOIN sites s ON (p.x - s.sx) * (p.x - s.sx) + (p.y - s.sy) * (p.y - s.sy) <= 5000e0 * 5000e0 GROUP BY p.id")
def radius_sum(spark, d):
    """Megawatts and sites within 5 km."""
    return disks.disk_sums(L.points(spark, d), L.sites(spark, d), "id", {5000.0: {"mw": F.col("mw"), "n_sites": F.lit(1).cast("long")}})


@query(f"WITH {L.POINTS}, {L.SITES} SELECT p.id, count(DISTINCT site_nation) AS nations FROM points p LEFT JOIN sites s ON (p.x - s.sx) * (p.x - s.sx) + (p.y - s.sy) * (p.y - s.sy) <= 10000e0 * 10000e0 GROUP BY p.id")
def radius_distinct(spark, d):
    """Distinct nations of the sites within 10 km."""
    return disks.disk_distinct(L.points(spark, d), L.sites(spark, d), "id", 10000.0, "site_nation", "nations")


@query(f"WITH {L.POINTS}, {L.SITES}, b AS (SELECT p.id, d.r, count(site) AS n FROM points p CROSS JOIN (VALUES (2000e0), (5000e0), (9000e0)) AS d(r) LEFT JOIN sites s ON (p.x - s.sx) * (p.x - s.sx) + (p.y - s.sy) * (p.y - s.sy) <= d.r * d.r GROUP BY p.id, d.r) SELECT id, CAST(sum(CASE WHEN r = 2000 THEN n END) AS BIGINT) AS n_2km, CAST(sum(CASE WHEN r = 5000 THEN n END) AS BIGINT) AS n_5km, CAST(sum(CASE WHEN r = 9000 THEN n END) AS BIGINT) AS n_9km FROM b GROUP BY id")
def radius_bands(spark, d):
    """Sites within three radii."""
    return disks.disk_sums(L.points(spark, d), L.sites(spark, d), "id", {r * 1000.0: {f"n_{r}km": F.lit(1).cast("long")} for r in (2, 5, 9)})


@query(f"WITH {L.POINTS}, {L.BOXES} SELECT p.id, coalesce(b.poly_id, -1) AS poly_id, b.poly_name FROM points p LEFT JOIN boxes b ON x > x0 AND x < x1 AND y > y0 AND y < y1")
def point_in_polygon(spark, d):
    """The rectangle that holds each point, if any."""
    return spatial.in_polygon(L.points(spark, d), L.boxes(spark, d), "id", ["poly_id", "poly_name"], 10000.0).fillna(-1, subset=["poly_id"])


@query(
    f"""WITH {L.POINTS}, grid_ AS (SELECT id, floor(x / 1000) * 1000 AS x, floor(y / 1000) * 1000 AS y FROM points), {L.BOXES}
SELECT g.id, coalesce(s.poly_id, e.poly_id, -1) AS poly_id, CAST(s.poly_id IS NULL AND e.poly_id IS NOT NULL AS INTEGER) AS by_edge FROM grid_ g
LEFT JOIN boxes s ON x > s.x0 AND x < s.x1 AND y > s.y0 AND y < s.y1 LEFT JOIN boxes e ON x >= e.x0 AND x <= e.x1 AND y >= e.y0 AND y <= e.y1"""
)
def pip_fallback(spark, d):
    """Points on whole kilometres: inside first, those left over once more with edges."""
    p = L.points(spark, d).select("id", (F.floor(F.col("x") / 1000) * 1000).cast("double").alias("x"), (F.floor(F.col("y") / 1000) * 1000).cast("double").alias("y"))
    strict = spatial.in_polygon(p, L.boxes(spark, d), "id", ["poly_id"], 10000.0)
    rest = p.join(strict.filter("poly_id is null").select("id"), "id", "left_semi")
    edge = spatial.in_polygon(rest, L.boxes(spark, d), "id", ["poly_id"], 10000.0, edges=True).select("id", F.col("poly_id").alias("edge_id"))
    both = strict.join(edge, "id", "left")
    return both.select("id", F.coalesce("poly_id", "edge_id", F.lit(-1)).alias("poly_id"), (F.col("poly_id").isNull() & F.col("edge_id").isNotNull()).cast("int").alias("by_edge"))


BOX_LIST = [("NJ", 10000.0, 30000.0, 10000.0, 30000.0), ("CO", 20000.0, 50000.0, 20000.0, 60000.0), ("WA", 40000.0, 90000.0, 50000.0, 90000.0)]


@query(f"WITH {L.POINTS} SELECT id, CASE WHEN x BETWEEN 10000 AND 30000 AND y BETWEEN 10000 AND 30000 THEN 'NJ' WHEN x BETWEEN 20000 AND 50000 AND y BETWEEN 20000 AND 60000 THEN 'CO' WHEN x BETWEEN 40000 AND 90000 AND y BETWEEN 50000 AND 90000 THEN 'WA' END AS state FROM points")
def box_join(spark, d):
    """The first box that holds each point."""
    return L.points(spark, d).select("id", spatial.in_box(F.col("x"), F.col("y"), BOX_LIST).alias("state"))


@query(
    f"""WITH {L.SITES}, {L.BOXES}, w AS (SELECT site, sx - 3000 AS a0, sx + 3000 AS a1, sy - 3000 AS b0, sy + 3000 AS b1 FROM sites),
p AS (SELECT site, poly_name, code, greatest(0e0, least(a1, x1) - greatest(a0, x0)) * greatest(0e0, least(b1, y1) - greatest(b0, y0)) AS piece FROM w, boxes),
o AS (SELECT site, sum(piece) / 36000000e0 AS share, max_by(poly_name, piece * 100 + code) AS big, min(code) AS code FROM p WHERE piece > 0 GROUP BY site)
SELECT s.site, CAST(floor(coalesce(least(1e0, share), 0) * 1000000 + 0.5e0) AS BIGINT) AS ppm, coalesce(o.code, -1) AS code, CAST(share IS NOT NULL AS INTEGER) AS touched FROM sites s LEFT JOIN o ON s.site = o.site"""
)
def overlay_share(spark, d):
    """Share of a square window around each site under the rectangles, with the least code."""
    sq = F.array(*(F.struct((F.col("sx") + a).alias("x"), (F.col("sy") + b).alias("y")) for a, b in ((-3000, -3000), (3000, -3000), (3000, 3000), (-3000, 3000))))
    out = spatial.overlay(L.sites(spark, d).select("site", sq.alias("ring")), L.boxes(spark, d), "site", "poly_name", "code", 10000.0)
    return out.select("site", F.floor(F.col("share") * 1000000 + 0.5).cast("long").alias("ppm"), F.coalesce("code", F.lit(-1)).alias("code"), F.col("code").isNotNull().cast("int").alias("touched"))


PAIRS = f"{L.FACILITIES}, pairs AS (SELECT a.id AS a, b.id AS b FROM fac a JOIN fac b ON a.id < b.id AND abs(a.x - b.x) <= 200 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 40000 AND (a.name = b.name OR lower(trim(a.operator)) = lower(trim(b.operator))))"
CLUSTERS = f"RECURSIVE {PAIRS}, both_ AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs), reach AS (SELECT id AS a, id AS b FROM fac UNION SELECT r.a, e.b FROM reach r JOIN both_ e ON r.b = e.a), cl AS (SELECT a AS id, min(b) AS cluster FROM reach GROUP BY a)"


@query(f"WITH {PAIRS} SELECT a, b FROM pairs")
def dup_pairs(spark, d):
    """Facilities within 200 m with the same name or operator."""
    return dedupe.duplicate_pairs(L.facilities(spark, d), "id", 200.0, ["name", "operator"])


@query(f"WITH {CLUSTERS} SELECT id, cluster FROM cl")
def dup_clusters(spark, d):
    """Connected duplicates under their least id."""
    f = L.facilities(spark, d)
    return dedupe.clusters(f, dedupe.duplicate_links(f, "id", 200.0, ["name", "operator"]), "id")


ORDER_SQL = "CASE type WHEN 'campus' THEN 2 WHEN 'building' THEN 1 ELSE 0 END DESC, sqft DESC NULLS LAST, f.id"


@query(f"WITH {CLUSTERS}, k AS (SELECT f.id, cluster, type, sqft, row_number() OVER (PARTITION BY cluster ORDER BY {ORDER_SQL}) AS rn, count(*) OVER (PARTITION BY cluster) AS members FROM fac f JOIN cl ON f.id = cl.id) SELECT id, cluster, type, coalesce(sqft, -1) AS sqft, members FROM k WHERE rn = 1")
def dedupe_facilities(spark, d):
    """One facility of each cluster: campus before building before point, larger first."""
    prio = F.when(F.col("type") == "campus", 2).when(F.col("type") == "building", 1).otherwise(0)
    return dedupe.representatives(L.facilities(spark, d), "id", 200.0, ["name", "operator"], [prio.desc(), F.col("sqft").desc_nulls_last(), F.col("id")]).select("id", "cluster", "type", F.coalesce("sqft", F.lit(-1)).alias("sqft"), "members")


@query("SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def dedupe_records(spark, d):
    """The last event of each user and type."""
    return dedupe.first_of_each(L.table(spark, d, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "ts")
