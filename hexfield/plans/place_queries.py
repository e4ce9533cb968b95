"""Queries on named places, staged grids, scores and records, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..functions.reference import CLOUD_REGIONS, STATE_BOXES
from ..operators import grid, model, places, scoring, spatial
from . import features
from . import layers as L
from .job_queries import cells, milli
from .space_queries import CLUSTERS, ORDER_SQL

Q: dict = {}


def query(sql: str):
    def add(f):
        Q[f.__name__] = (f, sql)
        return f

    return add


#: Counties are the tiles of 4 km that hold a supplier; every sixth diagonal lies in a territory, not a state.
TILE = 4000
CODES, STATES = ["01", "06", "8", "48", "60", "36"], ["AL", "CA", "CO", "TX", "AS", "NY"]
SPELLED = [" al", "CA ", "co", "Tx", "AS", "NY"]
ENDINGS, OTHERS = [" County", " Parish", " Borough", " city"], [" COUNTY ", "", " borough", " City"]


def _pick(values, at):
    return F.element_at(F.array(*(F.lit(v) for v in values)), (at + 1).cast("int"))


def _pick_sql(values, at):
    return f"list_extract([{', '.join(repr(v) for v in values)}], CAST({at} AS INTEGER) + 1)"


def tiled(df, x, y):
    """Adds the tile (tx, ty) and its number."""
    t = df.withColumns({"tx": F.floor(F.col(x) / TILE), "ty": F.floor(F.col(y) / TILE)})
    return t.withColumn("code", F.col("tx") * 25 + F.col("ty"))


def counties(spark, d):
    """County polygons as they are published: codes without zeros, names with endings."""
    t = tiled(L.sites(spark, d), "sx", "sy").select("tx", "ty", "code").distinct()
    x0, y0 = (F.col("tx") * TILE).cast("double"), (F.col("ty") * TILE).cast("double")
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ring = F.array(corner(x0, y0), corner(x0 + TILE, y0), corner(x0 + TILE, y0 + TILE), corner(x0, y0 + TILE))
    return t.select(_pick(CODES, (F.col("tx") + F.col("ty")) % 6).alias("STATEFP"), F.col("code").cast("string").alias("COUNTYFP"), F.concat(F.lit("Land "), F.col("code"), _pick(ENDINGS, F.col("tx") % 4)).alias("NAME"), F.array(ring).alias("rings"))


def spelled(df, x, y):
    """Rows with the state and county of their tile, as another source spells them."""
    return tiled(df, x, y).withColumns({"state": _pick(SPELLED, (F.col("tx") + F.col("ty")) % 6), "county": F.concat(F.lit(" LAND "), F.col("code"), _pick(OTHERS, F.col("tx") % 4))})


COUNTIES = f"""{L.POINTS}, {L.SITES}, ts AS (SELECT *, CAST(floor(sx / {TILE}) AS BIGINT) AS tx, CAST(floor(sy / {TILE}) AS BIGINT) AS ty, CAST(floor(sx / {TILE}) * 25 + floor(sy / {TILE}) AS BIGINT) AS code FROM sites),
tp AS (SELECT *, CAST(floor(x / {TILE}) * 25 + floor(y / {TILE}) AS BIGINT) AS code, CAST(floor(x / {TILE}) + floor(y / {TILE}) AS BIGINT) % 6 AS st FROM points),
co AS (SELECT DISTINCT code, tx, ty, lpad({_pick_sql(CODES, '(tx + ty) % 6')}, 2, '0') || lpad(CAST(code AS VARCHAR), 3, '0') AS county_fips, {_pick_sql(STATES, '(tx + ty) % 6')} AS state FROM ts WHERE (tx + ty) % 6 <> 4),
held AS (SELECT id, co.* FROM points LEFT JOIN co ON x > tx * {TILE} AND x < tx * {TILE} + {TILE} AND y > ty * {TILE} AND y < ty * {TILE} + {TILE})"""


@query(f"WITH {COUNTIES} SELECT CAST(id AS VARCHAR) AS cell_id, county_fips, state, 'land ' || code AS county, 'Land ' || code || {_pick_sql(ENDINGS, 'tx % 4')} AS county_name FROM held")
def cell_counties(spark, d):
    """The county that holds each cell, with its code, state and name for comparison."""
    return places.with_county(cells(spark, d), places.county_layer(counties(spark, d)), size=10_000.0).select("cell_id", *places.COUNTY)


@query(
    f"""WITH {COUNTIES}, op AS (SELECT code, site % 3 AS ba, CASE WHEN mw % 3 = 0 THEN mw * 2 ELSE mw END AS mw FROM ts WHERE mw > 0), pl AS (SELECT code, site % 3 AS ba, count(*) AS n FROM ts GROUP BY 1, 2), bc AS (SELECT code, arg_min(ba, -n * 10 + ba) AS ba FROM pl GROUP BY 1),
qu AS (SELECT code, (id % 10 + 1) % 3 AS ba, id % 50 AS mw FROM tp WHERE segment = 'BUILDING' AND id % 50 > 0),
oc AS (SELECT code, sum(mw) AS mw FROM op GROUP BY 1), qc AS (SELECT code, sum(mw) AS mw, count(*) AS n FROM qu GROUP BY 1), ob AS (SELECT ba, sum(mw) AS mw FROM op GROUP BY 1), qb AS (SELECT ba, sum(mw) AS mw, count(*) AS n FROM qu GROUP BY 1)
SELECT CAST(id AS VARCHAR) AS cell_id, county_fips, 'B' || bc.ba AS ba_code, CAST(coalesce(oc.mw, 0) AS BIGINT) AS operating_capacity_mw, CAST(coalesce(qc.mw, 0) AS BIGINT) AS queue_capacity_mw, coalesce(qc.n, 0) AS queue_generator_count, CAST(floor(coalesce(qc.mw, 0) / greatest(coalesce(oc.mw, 0), 1e0) * 1000 + 0.5e0) AS BIGINT) AS queue_congestion_ratio,
CAST(coalesce(ob.mw, 0) AS BIGINT) AS operating_capacity_mw_ba, CAST(coalesce(qb.mw, 0) AS BIGINT) AS queue_capacity_mw_ba, coalesce(qb.n, 0) AS queue_generator_count_ba, CAST(floor(coalesce(qb.mw, 0) / greatest(coalesce(ob.mw, 0), 1e0) * 1000 + 0.5e0) AS BIGINT) AS queue_congestion_ratio_ba
FROM held LEFT JOIN oc USING (code) LEFT JOIN qc USING (code) LEFT JOIN bc USING (code) LEFT JOIN ob ON ob.ba = bc.ba LEFT JOIN qb ON qb.ba = bc.ba"""
)
def county_capacity(spark, d):
    """The whole capacity job: counties from polygons, names as three sources spell them, both capacities."""
    s, p = spelled(L.sites(spark, d), "sx", "sy"), spelled(L.points(spark, d), "x", "y")
    code = F.concat(F.lit("B"), F.col("site") % 3)
    plants = s.select(F.col("site").alias("plant_code"), "state", "county", code.alias("ba_code"), F.concat(F.lit("name "), code).alias("ba_name"))
    operable = s.select(F.col("site").alias("plant_code"), "state", "county", F.when(F.col("mw") % 3 == 0, "x").otherwise(F.col("mw").cast("string")).alias("summer_mw"), (F.col("mw") * 2).cast("string").alias("nameplate_mw"))
    proposed = p.filter("segment = 'BUILDING'").select((F.col("id") % 10 + 1).alias("plant_code"), "state", "county", (F.col("id") % 50).cast("string").alias("nameplate_mw"))
    out = features.county_capacity(cells(spark, d), counties(spark, d), plants, operable, proposed, 10_000.0)
    whole = [f"{m}_capacity_mw{end}" for m in ("operating", "queue") for end in ("", "_ba")]
    return out.select("cell_id", "county_fips", "ba_code", *(F.col(c).cast("long").alias(c) for c in whole), "queue_generator_count", "queue_generator_count_ba", milli("queue_congestion_ratio"), milli("queue_congestion_ratio_ba"))


@query(
    f"""WITH {COUNTIES}, t AS (SELECT s_suppkey % 97 + 1 AS u, s_suppkey % 6 AS st, sum(s_suppkey % 50 * 1000e0) AS revenue, sum(s_suppkey % 20 * 100e0) AS volume FROM supplier WHERE s_suppkey % 5 <> 0 GROUP BY 1, 2), m AS (SELECT DISTINCT id % 97 + 1 AS u, st, code FROM tp), z AS (SELECT u, st, count(*) AS n FROM m GROUP BY 1, 2),
e AS (SELECT code, sum(revenue / n) / nullif(sum(volume / n), 0) AS price, count(*) AS utilities FROM m JOIN z USING (u, st) JOIN t USING (u, st) WHERE volume >= 1000 GROUP BY 1)
SELECT CAST(id AS VARCHAR) AS cell_id, county_fips, state, CASE WHEN code IS NOT NULL THEN 'land ' || code || CASE WHEN tx % 4 = 3 THEN ' city' ELSE '' END END AS county, CAST(floor(price * 1000 + 0.5e0) AS BIGINT) AS industrial_price_mwh, utilities AS utility_count FROM held LEFT JOIN e USING (code)"""
)
def county_price(spark, d):
    """The whole price job: counties from polygons, territories as they are spelled, cities apart from counties."""
    k = F.col("site")
    sales = L.sites(spark, d).select((k % 97 + 1).cast("string").alias("utility_number"), _pick(SPELLED, k % 6).alias("state"), F.when(k % 5 == 0, "B").otherwise("A").alias("part"), F.lit("Bundled").alias("service_type"), (k % 50).cast("double").alias("revenue_kusd"), (k % 20 * 100).cast("double").alias("sales_mwh"))
    territory = spelled(L.points(spark, d), "x", "y").select((F.col("id") % 97 + 1).cast("string").alias("utility_number"), "state", "county")
    out = features.county_price(cells(spark, d), counties(spark, d), sales, territory, size=10_000.0)
    return out.select("cell_id", "county_fips", "state", "county", milli("industrial_price_mwh"), "utility_count")


@query(
    f"""WITH {COUNTIES}, {L.BOXES}, pl AS (SELECT code, site % 4 AS ba, count(*) AS n FROM ts WHERE site % 4 <> 3 GROUP BY 1, 2), bc AS (SELECT code, arg_min(ba, -n * 10 + ba) AS ba FROM pl GROUP BY 1), g AS (SELECT site % 4 AS ba, sum(CASE WHEN site % 3 = 0 THEN mw ELSE 0 END) * 100e0 / nullif(sum(mw), 0) AS share FROM sites GROUP BY 1), r AS (SELECT site_nation AS k, sum(CASE WHEN site % 3 = 0 THEN mw ELSE 0 END) * 100e0 / nullif(sum(mw), 0) AS share FROM sites GROUP BY 1)
SELECT CAST(held.id AS VARCHAR) AS cell_id, county_fips, 'B' || bc.ba AS ba_code, poly_name AS egrid_subregion, CAST(floor(g.share * 1000 + 0.5e0) AS BIGINT) AS renewable_pct_ba, CAST(floor(r.share * 1000 + 0.5e0) AS BIGINT) AS renewable_pct_subregion
FROM held JOIN points p ON p.id = held.id LEFT JOIN boxes ON p.x > x0 AND p.x < x1 AND p.y > y0 AND p.y < y1 LEFT JOIN bc ON bc.code = held.code LEFT JOIN g ON g.ba = bc.ba LEFT JOIN r ON r.k = poly_id"""
)
def county_mix(spark, d):
    """The whole grid mix job: counties and subregions from polygons, authorities by county from plants."""
    s = L.sites(spark, d)
    rows = lambda key: s.groupBy(key).agg(F.sum(F.when(F.col("site") % 3 == 0, F.col("mw")).otherwise(0)).cast("double").alias("SUN"), F.sum(F.when(F.col("site") % 3 != 0, F.col("mw")).otherwise(0)).cast("double").alias("CL"), F.lit(0.0).alias("NC"), F.lit(0.0).alias("co2"), F.lit(0.0).alias("co2e"), F.lit(0.0).alias("net"))
    mix = lambda r, key, end: features.generation_mix(r, key, end, ["SUN", "NC", "CL"], ["SUN"], fossil=["CL"])
    boxes = L.boxes(spark, d).withColumnRenamed("poly_name", "egrid_subregion")
    by_subregion = rows("site_nation").join(boxes.select(F.col("poly_id").alias("site_nation"), "egrid_subregion"), "site_nation")
    code = F.concat(F.lit("B"), F.col("site") % 4)
    plants = spelled(s, "sx", "sy").select("state", "county", F.when(F.col("site") % 4 == 3, "NA").otherwise(code).alias("ba_code"), F.lit("name").alias("ba_name"))
    out = features.county_mix(cells(spark, d), counties(spark, d), boxes.select("egrid_subregion", "rings"), plants, mix(rows(code.alias("ba_code")), "ba_code", "ba"), mix(by_subregion, "egrid_subregion", "subregion"), 10_000.0)
    return out.select("cell_id", "county_fips", "ba_code", "egrid_subregion", milli("renewable_pct_ba"), milli("renewable_pct_subregion"))


def areas(spark, d):
    """Places of two squares and a hole, named with brackets and endings."""
    k, x, y = F.col("site"), F.col("sx"), F.col("sy")
    box = lambda a, b, w, turn: F.array(*(F.struct((x + a + u * w).alias("x"), (y + b + v * w).alias("y")) for u, v in [(0, 0), (1, 0), (1, 1), (0, 1)][::turn]))
    name = F.concat(F.lit("Town of "), k, _pick(["", " city", " (East) Town", " CITY"], k % 4))
    return L.sites(spark, d).select("site", name.alias("NAME"), F.array(box(0, 0, 1000, 1), box(2000, 0, 1000, 1), box(100, 100, 200, -1)).alias("rings"))


def listed(spark, d, k):
    """A list of every k-th place, without its ending or with it."""
    s = L.sites(spark, d).filter(F.col("site") % k == 0)
    return s.select(F.concat(F.lit("Town of "), F.col("site"), F.when(F.col("site") % 8 == 1, " City").otherwise("")).alias("name"))


#: A place counts if its name, as it is or without its ending, is one of the list's three spellings.
NAMED = f"""named AS (SELECT site, 'Town of ' || site || {_pick_sql(['', ' city', ' (East) Town', ' CITY'], 'site % 4')} AS name, (sx * 1e6 + 500e0 * 1e6 + (sx + 2500) * 1e6 - (sx + 200) * 4e4) / 196e4 AS sx, ((sy + 500) * 2e6 - (sy + 200) * 4e4) / 196e4 AS sy FROM sites)"""


@query(f"WITH {L.SITES}, {NAMED} SELECT name, CAST(floor(sx * 1000 + 0.5e0) AS BIGINT) AS sx, CAST(floor(sy * 1000 + 0.5e0) AS BIGINT) AS sy FROM named WHERE site % 3 = 0")
def city_points(spark, d):
    """Centroids of the places that a list of city names holds."""
    return places.cities(areas(spark, d), listed(spark, d, 3)).select("name", milli("sx"), milli("sy"))


CITY_D2 = "(p.x - s.sx) * (p.x - s.sx) + (p.y - s.sy) * (p.y - s.sy)"


@query(
    f"""WITH {L.POINTS}, {L.SITES}, {NAMED}, a AS (SELECT id, s.name, {CITY_D2} AS d2, row_number() OVER (PARTITION BY id ORDER BY {CITY_D2}, s.name) AS k FROM points p, named s WHERE site % 3 = 0), b AS (SELECT id, s.name, {CITY_D2} AS d2, row_number() OVER (PARTITION BY id ORDER BY {CITY_D2}, s.name) AS k FROM points p, named s WHERE site % 5 = 0),
cl AS (SELECT ['AWS', 'GCP', 'Azure'][site % 3 + 1] AS provider, 'r' || site_nation AS region, site_name, sx, sy FROM sites WHERE mw % 7 = 0), c AS (SELECT id, provider, region, site_name, {CITY_D2} AS d2, row_number() OVER (PARTITION BY id ORDER BY {CITY_D2}, provider, region, site_name) AS k FROM points p, cl s)
SELECT CAST(a.id AS VARCHAR) AS cell_id, a.name AS nearest_city_50k_name, CAST(floor(sqrt(a.d2) + 0.5e0) AS BIGINT) AS dist_nearest_city_50k_km, b.name AS nearest_city_100k_name, CAST(floor(sqrt(b.d2) + 0.5e0) AS BIGINT) AS dist_nearest_city_100k_km, c.provider AS nearest_cloud_provider, c.region AS nearest_cloud_region, c.site_name AS nearest_cloud_region_name
FROM a JOIN b ON a.id = b.id JOIN c ON a.id = c.id WHERE a.k = 1 AND b.k = 1 AND c.k = 1"""
)
def city_markets(spark, d):
    """The whole markets job: place polygons, two lists of names, regions of three providers."""
    s = L.sites(spark, d).filter("mw % 7 = 0")
    clouds = s.select(_pick(["AWS", "GCP", "Azure"], F.col("site") % 3).alias("provider"), F.concat(F.lit("r"), F.col("site_nation")).alias("region"), F.col("site_name").alias("name"), "sx", "sy")
    out = features.city_markets(cells(spark, d), areas(spark, d), {"50k": listed(spark, d, 3), "100k": listed(spark, d, 5)}, clouds, 20_000.0)
    return out.select("cell_id", "nearest_city_50k_name", "nearest_city_100k_name", milli("dist_nearest_city_50k_km"), milli("dist_nearest_city_100k_km"), "nearest_cloud_provider", "nearest_cloud_region", "nearest_cloud_region_name")


#: Customers on the contiguous states by longitude and latitude.
LONLAT = "ll AS (SELECT c_custkey AS id, 25 + CAST((c_custkey * 7919) % 24000 AS DOUBLE) / 1000 AS lat, -124 + CAST((c_custkey * 104729) % 57000 AS DOUBLE) / 1000 AS lon FROM customer)"


def lonlat(spark, d):
    return L.table(spark, d, "customer").selectExpr("c_custkey AS id", "25 + cast((c_custkey * 7919) % 24000 AS double) / 1000 AS lat", "-124 + cast((c_custkey * 104729) % 57000 AS double) / 1000 AS lon")


RADIUS = geo.EARTH_RADIUS
REGIONS = "regions(provider, region, name, lat, lon) AS (VALUES " + ", ".join(f"('{p}', '{r}', '{n}', {a}e0, {o}e0)" for p, r, n, a, o in CLOUD_REGIONS) + ")"
METRES = f"radians(lon) * {RADIUS}e0 AS x, ln(tan(radians(lat) / 2 + 0.7853981633974483e0)) * {RADIUS}e0 AS y"


@query(
    f"""WITH {LONLAT}, {REGIONS}, p AS (SELECT id, {METRES} FROM ll), r AS (SELECT provider, region, name, {METRES} FROM regions), j AS (SELECT id, r.* EXCLUDE (x, y), (p.x - r.x) * (p.x - r.x) + (p.y - r.y) * (p.y - r.y) AS d2 FROM p, r), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, provider, region, name) AS k FROM j)
SELECT id, provider, region, name, CAST(floor(sqrt(d2) / 1000 + 0.5e0) AS BIGINT) AS km FROM k WHERE k = 1"""
)
def cloud_nearest(spark, d):
    """The nearest region of the reference table."""
    points = grid.center_points(lonlat(spark, d), "id")
    near = spatial.nearest(points, places.cloud_regions(spark), "id", ["provider", "region", "name"], 100_000.0)
    return near.select("id", "provider", "region", "name", F.floor(F.sqrt("d2") / 1000 + 0.5).cast("long").alias("km"))


@query(f"WITH {LONLAT} SELECT id, CASE " + " ".join(f"WHEN lat BETWEEN {s}e0 AND {n}e0 AND lon BETWEEN {w}e0 AND {e}e0 THEN '{k}'" for k, (s, w, n, e) in STATE_BOXES.items()) + " END AS state_abb FROM ll")
def state_boxes(spark, d):
    """The state whose box is the first to hold a point."""
    return lonlat(spark, d).select("id", places.state_at(F.col("lat"), F.col("lon")).alias("state_abb"))


@query(f"WITH {LONLAT}, p AS (SELECT id, {METRES} FROM ll) SELECT 'c' || id AS cell_id, CAST(floor(x * 100 + 0.5e0) AS BIGINT) AS x, CAST(floor(y * 100 + 0.5e0) AS BIGINT) AS y FROM p")
def grid_points(spark, d):
    """A staged grid whose key is its index, as points in metres."""
    staged = lonlat(spark, d).select(F.concat(F.lit("c"), "id").alias("__index_level_0__"), "lat", "lon")
    return grid.center_points(staged).select("cell_id", milli("x", 100), milli("y", 100))


@query("WITH ok AS (SELECT upper(trim(CASE WHEN c_custkey % 9 = 0 THEN ' pr ' WHEN c_custkey % 9 = 1 THEN 'ON' WHEN c_custkey % 9 = 2 THEN NULL WHEN c_custkey % 2 = 0 THEN 'nj' ELSE ' TX' END)) AS state_abb FROM customer) SELECT DISTINCT state_abb FROM ok WHERE state_abb IN ('PR', 'ON')")
def unknown_states(spark, d):
    """Abbreviations that name no state."""
    k = F.col("c_custkey")
    told = F.when(k % 9 == 0, " pr ").when(k % 9 == 1, "ON").when(k % 9 == 2, None).when(k % 2 == 0, "nj").otherwise(" TX")
    return places.unknown_states(L.table(spark, d, "customer").select(told.alias("state_abb")))


@query(f"WITH {CLUSTERS}, k AS (SELECT f.*, row_number() OVER (PARTITION BY cluster ORDER BY {ORDER_SQL}) AS rn FROM fac f JOIN cl ON f.id = cl.id), one AS (SELECT * FROM k WHERE rn = 1), {L.cells_sql('one', 'oc')} SELECT cell_id, name, operator, state_abb, sqft, type, 'told' AS source FROM oc")
def ingest_facilities(spark, d):
    """The whole facility job from rows with longitude and latitude, some of them without."""
    f = L.facilities(spark, d).withColumns({"lon": geo.mercator_lon(F.col("x")), "lat": geo.mercator_lat(F.col("y"))})
    raw = f.select(F.format_string("%012d", "id").alias("id"), "lat", "lon", F.concat(F.lit(" "), "name").alias("name"), "operator", F.lit(None).cast("string").alias("state"), "state_abb", F.lit(None).cast("string").alias("county"), "sqft", "type")
    lost = raw.withColumns({"id": F.concat(F.lit("x"), "id"), "lat": F.lit(None).cast("double")})
    out = features.ingest_facilities(raw.unionByName(lost), L.EDGE, "told")
    return out.select("cell_id", "name", "operator", "state_abb", "sqft", "type", "source")


@query("SELECT CAST(c_custkey AS VARCHAR) AS cell_id, CASE WHEN c_acctbal > 0 THEN c_nationkey / 25e0 ELSE 0e0 END AS viability, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 2 AS INTEGER) WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS has_dc, CASE WHEN c_acctbal > 0 AND c_custkey % 3 = 0 THEN 1 ELSE 0 END AS is_soft, CAST(c_custkey % 7 = 0 AS INTEGER) AS in_wetland FROM customer")
def merged_scores(spark, d):
    """Scores merged into the master table, cells without a score at 0."""
    t = L.table(spark, d, "customer")
    key, k = F.col("c_custkey").cast("string").alias("cell_id"), F.col("c_custkey")
    master = t.select(key, F.when(k % 4 != 0, k % 2).cast("int").alias("has_dc"), (k % 7 == 0).cast("int").alias("in_wetland"), *(F.lit(0).alias(c) for c in ("in_protected_area", "in_tribal_land", "in_critical_habitat")))
    scores = t.filter("c_acctbal > 0").select(key, (F.col("c_nationkey") / 25).alias("viability"), F.lit(1).alias("has_dc"), F.when(k % 3 == 0, 1).alias("is_soft"))
    return scoring.merged(master, scores).select("cell_id", "viability", "has_dc", "is_soft", "in_wetland")


RECORD = "sc AS (SELECT c_custkey AS id, CAST((c_custkey * 7919) % 997 AS DOUBLE) AS score, CASE WHEN (c_custkey * 7919) % 997 + (c_custkey * 31) % 400 > 1100 THEN 1 ELSE 0 END AS has_dc, CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS is_soft, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS is_test FROM customer)"


def _million(value):
    return f"CAST(floor({value} * 1000000 + 0.5e0) AS BIGINT)"


@query(
    f"""WITH {RECORD}, g AS (SELECT is_test, score, sum(has_dc) AS pos, sum(1 - has_dc) AS neg FROM sc GROUP BY 1, 2), c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY is_test) AS total FROM g WINDOW w AS (PARTITION BY is_test ORDER BY score DESC)),
s AS (SELECT is_test, sum(neg * (tp - pos) + pos * neg / 2e0) / (sum(pos) * sum(neg)) AS auc, sum(tp * 1e0 / (tp + fp) * pos / total) AS ap FROM c GROUP BY 1), r AS (SELECT score, tp * 1e0 / (tp + fp) AS p FROM c WHERE is_test = 1 AND tp * 1e0 / total >= 0.6e0 ORDER BY score DESC LIMIT 1), k AS (SELECT has_dc, row_number() OVER (ORDER BY score DESC, id) AS k FROM sc WHERE is_test = 1)
SELECT 'trees' AS model, 12 AS best_iteration, 'NJ,CO' AS test_states, (SELECT count(*) FROM sc WHERE is_test = 0) AS train_cells, (SELECT count(*) FROM sc WHERE is_test = 1) AS test_cells, (SELECT CAST(sum(has_dc) AS BIGINT) FROM sc WHERE is_test = 0) AS train_positives, (SELECT count(*) FROM sc WHERE is_test = 0 AND is_soft = 1 AND has_dc = 0) AS train_soft_positives, (SELECT CAST(sum(has_dc) AS BIGINT) FROM sc WHERE is_test = 1) AS test_positives, (SELECT CAST(sum(has_dc) AS BIGINT) FROM sc) AS hard_positives, (SELECT CAST(sum(is_soft) AS BIGINT) FROM sc) AS soft_positives,
(SELECT {_million('auc')} FROM s WHERE is_test = 0) AS train_auc_roc, (SELECT {_million('ap')} FROM s WHERE is_test = 0) AS train_auc_pr, (SELECT {_million('auc')} FROM s WHERE is_test = 1) AS auc_roc, (SELECT {_million('ap')} FROM s WHERE is_test = 1) AS auc_pr, (SELECT {_million('p')} FROM r) AS precision_at_r60, (SELECT score FROM r) AS threshold_at_r60,
(SELECT {_million('avg(has_dc)')} FROM k WHERE k <= 100) AS top_100_precision, (SELECT {_million('avg(has_dc)')} FROM k WHERE k <= 500) AS top_500_precision, (SELECT {_million('avg(has_dc)')} FROM k WHERE k <= 1000) AS top_1000_precision"""
)
def evaluation_record(spark, d):
    """The whole record of an evaluation on a holdout."""
    t = L.table(spark, d, "customer").selectExpr("c_custkey AS id", "cast((c_custkey * 7919) % 997 AS double) AS score", "CASE WHEN (c_custkey * 7919) % 997 + (c_custkey * 31) % 400 > 1100 THEN 1 ELSE 0 END AS has_dc", "cast(c_custkey % 6 = 0 AS int) AS is_soft", "cast(c_custkey % 3 = 0 AS int) AS is_test")
    out = model.evaluation_record(t, "id", {"model": "trees", "best_iteration": 12, "test_states": "NJ,CO"})
    rates = ["train_auc_roc", "train_auc_pr", "auc_roc", "auc_pr", "precision_at_r60", "top_100_precision", "top_500_precision", "top_1000_precision"]
    return out.select(*(milli(c, 1_000_000) if c in rates else c for c in out.columns))
