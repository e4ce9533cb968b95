"""Planar geometry as Column expressions: projections, hexagons, polygons, segments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The sphere of Web Mercator, and the ellipsoid and parallels of the CONUS Albers projection.
EARTH_RADIUS = 6378137.0
ALBERS = {"e2": 0.006694380022900788, "lat1": 29.5, "lat2": 45.5, "lat0": 23.0, "lon0": -96.0}

SQRT3_THIRD = 5.773502691896257e-1
SQRT3 = 1.7320508075688772


def mercator_x(lon: Column) -> Column:
    """Metres east of Greenwich (EPSG:3857)."""
    return F.radians(lon) * EARTH_RADIUS


def mercator_y(lat: Column) -> Column:
    """Metres north of the equator (EPSG:3857)."""
    return F.log(F.tan(F.radians(lat) / 2 + F.lit(0.7853981633974483))) * EARTH_RADIUS


def mercator_lon(x: Column) -> Column:
    return F.degrees(x / EARTH_RADIUS)


def mercator_lat(y: Column) -> Column:
    return F.degrees(2 * F.atan(F.exp(y / EARTH_RADIUS)) - F.lit(1.5707963267948966))


def _albers_q(sin: Column) -> Column:
    e2 = ALBERS["e2"]
    e = e2**0.5
    return (1 - e2) * (sin / (1 - e2 * sin * sin) - F.log((1 - e * sin) / (1 + e * sin)) / (2 * e))


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres in the equal-area projection of the continental US (EPSG:5070)."""
    e2 = ALBERS["e2"]
    s1, s2, s0 = (F.sin(F.radians(F.lit(ALBERS[k]))) for k in ("lat1", "lat2", "lat0"))
    m1, m2 = (F.cos(F.radians(F.lit(ALBERS[k]))) / F.sqrt(1 - e2 * s * s) for k, s in (("lat1", s1), ("lat2", s2)))
    n = (m1 * m1 - m2 * m2) / (_albers_q(s2) - _albers_q(s1))
    c = m1 * m1 + n * _albers_q(s1)
    rho = EARTH_RADIUS * F.sqrt(c - n * _albers_q(F.sin(F.radians(lat)))) / n
    rho0 = EARTH_RADIUS * F.sqrt(c - n * _albers_q(s0)) / n
    theta = n * F.radians(lon - ALBERS["lon0"])
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def albers_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a place in the equal-area projection: the authalic latitude follows from the
    distance to the cone's tip, and the geographic one from it by its series in the squared eccentricity."""
    e2 = ALBERS["e2"]
    s1, s2, s0 = (F.sin(F.radians(F.lit(ALBERS[k]))) for k in ("lat1", "lat2", "lat0"))
    m1, m2 = (F.cos(F.radians(F.lit(ALBERS[k]))) / F.sqrt(1 - e2 * s * s) for k, s in (("lat1", s1), ("lat2", s2)))
    n = (m1 * m1 - m2 * m2) / (_albers_q(s2) - _albers_q(s1))
    c = m1 * m1 + n * _albers_q(s1)
    rho0 = EARTH_RADIUS * F.sqrt(c - n * _albers_q(s0)) / n
    rho2 = x * x + (rho0 - y) * (rho0 - y)
    q = (c - rho2 * n * n / (EARTH_RADIUS * EARTH_RADIUS)) / n
    beta = F.asin(q / _albers_q(F.lit(1.0)))
    e4, e6, e8 = e2**2, e2**3, e2**4
    series = [(e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040 + 120389 * e8 / 1814400), (23 * e4 / 360 + 251 * e6 / 3780 + 102287 * e8 / 1814400), (761 * e6 / 45360 + 47561 * e8 / 1814400), 6059 * e8 / 1209600]
    lat = beta
    for k, term in enumerate(series, 1):
        lat = lat + term * F.sin(2 * k * beta)
    return ALBERS["lon0"] + F.degrees(F.atan2(x, rho0 - y) / n), F.degrees(lat)


def projected(rings: Column, to: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Rings with every corner taken to another projection."""

    def moved(p: Column) -> Column:
        x, y = to(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(rings, lambda ring: F.transform(ring, moved))


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Ground distance on the sphere."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS * F.asin(F.sqrt(a))


def distance2(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared planar distance."""
    return (x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)


def _nearest_int(v: Column) -> Column:
    return F.floor(v + 0.5).cast("double")


def hex_axial(x: Column, y: Column, edge: float) -> tuple[Column, Column]:
    """Axial (q, r) of the pointy-top hexagon of the given edge that holds a point."""
    q, r = (SQRT3_THIRD * x - y / 3) / edge, (y * 2 / 3) / edge
    s = -q - r
    rq, rr, rs = _nearest_int(q), _nearest_int(r), _nearest_int(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    q_off = (dq > dr) & (dq > ds)
    r_off = ~q_off & (dr > ds)
    return F.when(q_off, -rr - rs).otherwise(rq).cast("long"), F.when(r_off, -rq - rs).otherwise(rr).cast("long")


def hex_id(q: Column, r: Column) -> Column:
    """Cell id as text."""
    return F.concat(F.lit("h_"), q.cast("string"), F.lit("_"), r.cast("string"))


def hex_center(q: Column, r: Column, edge: float) -> tuple[Column, Column]:
    """Centre of a cell."""
    return (q + r / 2) * (SQRT3 * edge), r * (1.5 * edge)


def hex_ring(q: Column, r: Column, edge: float) -> Column:
    """The six corners of a cell, counter-clockwise from the east-north-east one."""
    cx, cy = hex_center(q, r, edge)
    half, up = SQRT3 * edge / 2, edge / 2
    corners = [(half, up), (0.0, edge), (-half, up), (-half, -up), (0.0, -edge), (half, -up)]
    return F.array(*(F.struct((cx + dx).alias("x"), (cy + dy).alias("y")) for dx, dy in corners))


#: Axial steps to a cell's six neighbours.
NEIGHBOURS = [(1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1)]


def hex_neighbours(q: Column, r: Column, with_self: bool = False) -> Column:
    """Array of (q, r) around a cell."""
    steps = [*([(0, 0)] if with_self else []), *NEIGHBOURS]
    return F.array(*(F.struct((q + a).alias("q"), (r + b).alias("r")) for a, b in steps))


def ring_edges(ring: Column) -> Column:
    """Consecutive corner pairs of a ring, the last with the first."""
    n = F.size(ring)
    following = F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.arrays_zip(ring.alias("a"), following.alias("b"))


def ring_area(ring: Column) -> Column:
    """Signed area by the shoelace rule; positive counter-clockwise."""
    return F.aggregate(ring_edges(ring), F.lit(0.0), lambda s, e: s + (e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]) / 2)


def ring_centroid(ring: Column) -> Column:
    """Area-weighted centroid."""
    zero = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("w"))

    def step(s: Column, e: Column) -> Column:
        w = e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]
        return F.struct((s["x"] + (e["a"]["x"] + e["b"]["x"]) * w).alias("x"), (s["y"] + (e["a"]["y"] + e["b"]["y"]) * w).alias("y"), (s["w"] + w).alias("w"))

    return F.aggregate(ring_edges(ring), zero, step, lambda s: F.struct((s["x"] / (3 * s["w"])).alias("x"), (s["y"] / (3 * s["w"])).alias("y")))


def rings_centroid(rings: Column) -> Column:
    """Centroid of a polygon of several rings, holes turning the other way, weighed by their signed areas."""
    zero = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("w"))

    def step(s: Column, ring: Column) -> Column:
        w, c = ring_area(ring), ring_centroid(ring)
        moved = F.struct((s["x"] + c["x"] * w).alias("x"), (s["y"] + c["y"] * w).alias("y"), (s["w"] + w).alias("w"))
        return F.when(w != 0, moved).otherwise(s)

    return F.aggregate(rings, zero, step, lambda s: F.struct(F.try_divide(s["x"], s["w"]).alias("x"), F.try_divide(s["y"], s["w"]).alias("y")))


def valid_ring(ring: Column) -> Column:
    """Three corners or more, none null, and an area."""
    complete = (F.size(ring) >= 3) & ~F.exists(ring, lambda p: p.isNull() | p["x"].isNull() | p["y"].isNull())
    return ring.isNotNull() & F.when(complete, F.abs(ring_area(ring)) > 0).otherwise(False)


def ring_box(ring: Column) -> Column:
    """Least and greatest coordinates."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def rings_contain(rings: Column, x: Column, y: Column) -> Column:
    """Even-odd test over all rings: holes and several parts come out right."""

    def crossings(ring: Column) -> Column:
        return F.aggregate(ring_edges(ring), F.lit(0), lambda n, e: n + F.when(((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]), 1).otherwise(0))

    return F.aggregate(rings, F.lit(0), lambda n, ring: n + crossings(ring)) % 2 == 1


def on_edge(rings: Column, x: Column, y: Column) -> Column:
    """Whether a point lies exactly on some ring."""

    def touches(e: Column) -> Column:
        cross = (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (x - e["a"]["x"])
        inside = x.between(F.least(e["a"]["x"], e["b"]["x"]), F.greatest(e["a"]["x"], e["b"]["x"])) & y.between(F.least(e["a"]["y"], e["b"]["y"]), F.greatest(e["a"]["y"], e["b"]["y"]))
        return (cross == 0) & inside

    return F.exists(rings, lambda ring: F.exists(ring_edges(ring), touches))


def segment_distance2(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared distance from a point to a segment."""
    dx, dy = x2 - x1, y2 - y1
    long2 = dx * dx + dy * dy
    t = F.when(long2 == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - x1) * dx + (py - y1) * dy) / long2)))
    return distance2(px, py, x1 + t * dx, y1 + t * dy)


def clip_convex(ring: Column, window: Column) -> Column:
    """A ring cut to a convex counter-clockwise window, edge by edge."""

    def side(p: Column, e: Column) -> Column:
        return (e["b"]["x"] - e["a"]["x"]) * (p["y"] - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (p["x"] - e["a"]["x"])

    def meet(p: Column, q: Column, e: Column) -> Column:
        t = side(p, e) / (side(p, e) - side(q, e))
        return F.struct((p["x"] + t * (q["x"] - p["x"])).alias("x"), (p["y"] + t * (q["y"] - p["y"])).alias("y"))

    def cut(points: Column, e: Column) -> Column:
        def keep(pair: Column) -> Column:
            p, q = pair["a"], pair["b"]
            return F.when(side(q, e) >= 0, F.when(side(p, e) >= 0, F.array(q)).otherwise(F.array(meet(p, q, e), q))).otherwise(F.when(side(p, e) >= 0, F.array(meet(p, q, e))).otherwise(F.slice(F.array(q), 1, 0)))

        return F.when(F.size(points) > 0, F.flatten(F.transform(ring_edges(points), keep))).otherwise(points)

    return F.aggregate(ring_edges(window), ring, cut)
