"""Queries that run whole feature jobs on layers from the supplied tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import raster
from . import features
from . import layers as L

Q: dict = {}


def query(sql: str):
    def add(f):
        Q[f.__name__] = (f, sql)
        return f

    return add


def cells(spark, d):
    """Customers as cells."""
    return L.points(spark, d).withColumn("cell_id", F.col("id").cast("string"))


def milli(c, k=1000):
    return F.floor(F.col(c) * k + 0.5).cast("long").alias(c)


D2 = "(p.x - s.sx) * (p.x - s.sx) + (p.y - s.sy) * (p.y - s.sy)"


@query(f"WITH {L.POINTS}, {L.SITES}, ok AS (SELECT * FROM sites WHERE site % 5 <> 0 AND site % 3 <> 1) SELECT CAST(p.id AS VARCHAR) AS cell_id, CAST(floor(sqrt(min({D2})) / 1000 * 1000 + 0.5e0) AS BIGINT) AS dist_substation_km FROM points p, ok s GROUP BY 1")
def job_substations(spark, d):
    """Distance to the nearest substation in service at home."""
    stations = L.sites(spark, d).withColumn("COUNTRY", F.when(F.col("site") % 5 == 0, "CAN").otherwise(" usa ")).withColumn("STATUS", F.when(F.col("site") % 3 == 1, "closed").otherwise("In Service"))
    return features.substation_distance(cells(spark, d), stations).select("cell_id", milli("dist_substation_km"))


@query(f"WITH {L.POINTS}, {L.SEGMENTS}, ok AS (SELECT * FROM segments WHERE kind IN (1, 2)), t AS (SELECT p.id, p.x, p.y, s.*, (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) AS l2, (x - x1) * (x2 - x1) + (y - y1) * (y2 - y1) AS dot FROM points p, ok s), u AS (SELECT *, CASE WHEN l2 = 0 THEN 0e0 ELSE least(1e0, greatest(0e0, dot / l2)) END AS f FROM t) SELECT CAST(id AS VARCHAR) AS cell_id, CAST(floor(sqrt(min((x - (x1 + f * (x2 - x1))) * (x - (x1 + f * (x2 - x1))) + (y - (y1 + f * (y2 - y1))) * (y - (y1 + f * (y2 - y1))))) / 1000 * 1000 + 0.5e0) AS BIGINT) AS dist_tx_line_km FROM u GROUP BY 1")
def job_lines(spark, d):
    """Distance to the nearest line of 69 kV or more."""
    kv = F.element_at(F.array(F.lit("-999999"), F.lit("115"), F.lit("69"), F.lit("12")), (F.col("kind") + 1).cast("int"))
    return features.line_distance(cells(spark, d), L.segments(spark, d).withColumn("VOLTAGE", kv)).select("cell_id", milli("dist_tx_line_km"))


PLANTS = f"{L.POINTS}, {L.SITES}, gen AS (SELECT site AS plant, CASE WHEN mw % 3 = 0 THEN mw * 2 ELSE mw END AS mw, CASE WHEN site % 4 = 0 THEN 'SUN' ELSE 'NG' END AS src FROM sites WHERE site % 7 <> 0 AND mw > 0), pl AS (SELECT s.*, g.mw AS gmw, CASE WHEN src = 'SUN' THEN g.mw ELSE 0 END AS green FROM sites s JOIN gen g ON s.site = g.plant)"


@query(
    f"""WITH {PLANTS}, j AS (SELECT p.id, s.site, gmw, green, {D2} AS d2 FROM points p, pl s)
SELECT CAST(id AS VARCHAR) AS cell_id, CAST(floor(sqrt(min(d2)) / 1000 * 1000 + 0.5e0) AS BIGINT) AS dist_nearest_plant_km, CAST(sum(CASE WHEN d2 <= 25e6 THEN gmw ELSE 0 END) AS BIGINT) AS operating_capacity_mw_5km, CAST(sum(CASE WHEN d2 <= 625e6 THEN gmw ELSE 0 END) AS BIGINT) AS operating_capacity_mw_25km,
CAST(arg_min(gmw, d2 * 1000 + gmw) AS BIGINT) AS nearest_plant_operating_mw, CAST(sum(CASE WHEN d2 <= 25e8 THEN gmw ELSE 0 END) AS BIGINT) AS operating_capacity_mw_50km,
CAST(sum(CASE WHEN d2 <= 625e6 THEN green ELSE 0 END) AS BIGINT) AS renewable_capacity_mw_25km, count(DISTINCT CASE WHEN d2 <= 625e6 THEN site END) AS plant_count_25km, min(d2) <= 4e6 AS colocated_with_power FROM j GROUP BY 1"""
)
def job_generation(spark, d):
    """Generation near every cell."""
    s = L.sites(spark, d)
    plants = s.select(F.col("site").alias("plant_code"), "sx", "sy")
    gens = s.select(F.col("site").alias("plant_code"), F.when(F.col("site") % 7 == 0, "OS").otherwise("OP").alias("status"), F.when(F.col("mw") % 3 == 0, "x").otherwise(F.col("mw").cast("string")).alias("summer_mw"), F.when(F.col("mw") % 3 == 0, F.col("mw") * 2).otherwise(1).cast("string").alias("nameplate_mw"), F.when(F.col("site") % 4 == 0, "SUN").otherwise("NG").alias("energy_source"))
    gens = gens.withColumn("nameplate_mw", F.when(F.col("summer_mw") == "0", "0").otherwise(F.col("nameplate_mw")))
    out = features.nearby_generation(cells(spark, d), plants, gens)
    whole = ["nearest_plant_operating_mw", "operating_capacity_mw_5km", "operating_capacity_mw_25km", "operating_capacity_mw_50km", "renewable_capacity_mw_25km"]
    return out.select("cell_id", milli("dist_nearest_plant_km"), *(F.round(c).cast("long").alias(c) for c in whole), "plant_count_25km", "colocated_with_power")


@query(f"WITH {L.POINTS}, {L.SITES} SELECT CAST(p.id AS VARCHAR) AS cell_id, CAST(floor(sqrt(min({D2})) / 1000 * 1000 + 0.5e0) AS BIGINT) AS dist_nearest_ixp_km, count(DISTINCT CASE WHEN {D2} <= 2500000000e0 THEN site_nation END) AS ixp_count_500km FROM points p, sites s GROUP BY 1")
def job_exchanges(spark, d):
    """Nearest exchange point, and how many lie within 50 km."""
    sites = L.sites(spark, d).withColumn("ix_id", F.col("site_nation"))
    return features.exchange_distance(cells(spark, d), sites, 50_000.0).select("cell_id", milli("dist_nearest_ixp_km"), "ixp_count_500km")


ZONED = f"{L.PIXELS}, z AS (SELECT DISTINCT zone FROM pixels)"


@query(f"WITH {ZONED}, k AS (SELECT zone, avg(CASE WHEN class IN (90, 95) THEN 1e0 ELSE 0e0 END) AS f FROM pixels GROUP BY 1) SELECT CAST(zone AS VARCHAR) AS cell_id, CAST(floor(f * 1000 + 0.5e0) AS BIGINT) AS pct_wetland, CAST(f >= 0.25 AS INTEGER) AS in_wetland, CAST(f >= 0.5 AS INTEGER) AS in_wetland_strict, CAST(f > 0 AS INTEGER) AS in_wetland_any FROM k")
def job_wetland(spark, d):
    """Wetland tiers from land cover."""
    p = L.pixels(spark, d).withColumn("cell_id", F.col("zone").cast("string"))
    return features.wetland(features.land_cover(p.select("cell_id").distinct(), p)).select("cell_id", milli("pct_wetland"), "in_wetland", "in_wetland_strict", "in_wetland_any")


@query(f"WITH {ZONED} SELECT CAST(zone AS VARCHAR) AS cell_id, CAST(floor(avg(v) * 1000 + 0.5e0) AS BIGINT) AS mean_slope_deg, CAST(avg(v) <= 5 AS INTEGER) AS is_flat, CAST(avg(v) <= 2 AS INTEGER) AS is_very_flat, count(*) AS slope_pixel_count FROM (SELECT zone, CAST(value % 13 AS DOUBLE) AS v FROM pixels WHERE value % 13 <> 7) GROUP BY 1")
def job_slope(spark, d):
    """Slopes by zone, one value standing for missing."""
    p = L.pixels(spark, d).select(F.col("zone").cast("string").alias("cell_id"), (F.col("value") % 13).cast("double").alias("value"))
    return features.slope(p.select("cell_id").distinct(), p, 7.0).filter("slope_pixel_count > 0").select("cell_id", milli("mean_slope_deg"), "is_flat", "is_very_flat", "slope_pixel_count")


@query(f"WITH {L.POINTS}, {L.BOXES}, ok AS (SELECT * FROM boxes WHERE poly_id % 3 <> 2) SELECT CAST(p.id AS VARCHAR) AS cell_id, CAST(b.poly_id IS NOT NULL AS INTEGER) AS in_tribal_land, CASE WHEN b.poly_id % 3 = 0 THEN b.poly_name || ' Reservation' ELSE b.poly_name || ' Trust Land' END AS tribal_name FROM points p LEFT JOIN ok b ON x > x0 AND x < x1 AND y > y0 AND y < y1")
def job_tribal(spark, d):
    """Tribal areas by name, statistical ones left out."""
    k = F.col("poly_id") % 3
    name = F.concat("poly_name", F.when(k == 0, " Reservation").when(k == 1, " Trust Land").otherwise(" Reservation OTSA"))
    layer = L.boxes(spark, d).select(F.lit("zz").alias("LSAD"), name.alias("NAMELSAD"), "rings")
    return features.tribal_land(cells(spark, d), layer)


@query(f"WITH {L.POINTS}, {L.BOXES}, h AS (SELECT poly_id % 4 AS sp, x0, x1, y0, y1 FROM boxes WHERE poly_id % 6 <> 0 UNION ALL SELECT 9 + code, x0 + 3000, x1, y0, y1 FROM boxes) SELECT CAST(p.id AS VARCHAR) AS cell_id, CAST(count(sp) > 0 AS INTEGER) AS in_critical_habitat, count(DISTINCT sp) AS critical_habitat_species_count FROM points p LEFT JOIN h ON x > x0 AND x < x1 AND y > y0 AND y < y1 GROUP BY 1")
def job_habitat(spark, d):
    """Habitats of several species, proposed ones left out."""
    b = L.boxes(spark, d)
    first = b.select((F.col("poly_id") % 4).cast("string").alias("COMNAME"), F.when(F.col("poly_id") % 6 == 0, "Proposed").otherwise(" final").alias("STATUS"), "rings")
    corner = lambda x, y: F.struct(x.alias("x"), F.col(y).alias("y"))
    left = F.col("x0") + 3000
    inner = F.array(F.array(corner(left, "y0"), corner(F.col("x1"), "y0"), corner(F.col("x1"), "y1"), corner(left, "y1")))
    second = b.select((F.col("code") + 9).cast("string").alias("COMNAME"), F.lit("Final").alias("STATUS"), inner.alias("rings"))
    return features.critical_habitat(cells(spark, d), first.unionByName(second))


INSIDE = "x > x0 AND x < x1 AND y > y0 AND y < y1"


@query(
    f"""WITH {L.POINTS}, {L.BOXES} SELECT CAST(p.id AS VARCHAR) AS cell_id, CAST(coalesce(poly_id % 4 = 1 OR poly_id % 4 = 2, FALSE) AS INTEGER) AS in_floodplain_100yr, CAST(coalesce(poly_id % 4 <> 0, FALSE) AS INTEGER) AS in_floodplain_500yr,
CAST(coalesce(poly_id % 3 = 1, FALSE) AS INTEGER) AS in_high_seismic, CAST(coalesce(poly_id % 5 = 2, FALSE) AS INTEGER) AS in_high_wildfire, poly_id * 2e0 AS flood_risk_score, CASE poly_id % 4 WHEN 0 THEN 'Very Low' WHEN 1 THEN 'Relatively High' WHEN 2 THEN 'Very High' WHEN 3 THEN 'Relatively Moderate' END AS flood_risk_rating,
poly_id * 3e0 AS flood_eal_dollars, CAST(floor((poly_id * 10e0 + 5) * 1000 / 240 * 100 - 5e0 * 1000 / 240 * 100 + 0.5e0) AS BIGINT) AS seismic_risk_score, CAST(floor(poly_id * 4e0 * 1000 + 0.5e0) AS BIGINT) AS wildfire_risk_score, poly_id * 7e0 AS wildfire_eal_dollars, poly_id * 1e0 AS composite_risk_score, CAST(poly_id AS VARCHAR) AS tract_fips
FROM points p LEFT JOIN boxes b ON {INSIDE}"""
)
def job_hazards(spark, d):
    """Hazard scores and flags of the tract that holds each cell; seismic scores leave 0 to 100 and are rescaled."""
    b = L.boxes(spark, d)
    tracts = b.select(F.col("poly_id").cast("string").alias("GEOID"), "rings")
    k = F.col("poly_id")
    rating = F.element_at(F.array(F.lit("Very Low"), F.lit("Relatively High"), F.lit("Very High"), F.lit("Relatively Moderate")), (k % 4 + 1).cast("int"))
    high = lambda c: F.when(c, "Very High").otherwise("No Rating")
    number = lambda c: c.cast("double")
    table = b.select(
        k.cast("string").alias("GEOID"), number(k * 2).alias("c_score"), number(k).alias("i_score"), rating.alias("c_rating"), F.lit("x").alias("i_rating"), number(k).alias("c_loss"), number(k * 2).alias("i_loss"),
        number(k * 10 + 5).alias("seismic_score"), high(k % 3 == 1).alias("seismic_rating"), number(k).alias("seismic_loss"), number(k * 4).alias("wildfire_score"), high(k % 5 == 2).alias("wildfire_rating"), number(k * 7).alias("wildfire_loss"),
        number(k).alias("composite_score"), F.lit("x").alias("composite_rating"),
    )
    out = features.hazards(cells(spark, d), tracts, table, 10_000.0)
    return out.select("cell_id", "in_floodplain_100yr", "in_floodplain_500yr", "in_high_seismic", "in_high_wildfire", "flood_risk_score", "flood_risk_rating", "flood_eal_dollars", milli("seismic_risk_score"), milli("wildfire_risk_score"), "wildfire_eal_dollars", "composite_risk_score", "tract_fips")


GROUPS_SQL = ", ".join(f"CAST(floor(avg(CASE WHEN class IN ({', '.join(map(str, g))}) THEN 1e0 ELSE 0e0 END) * 1000 + 0.5e0) AS BIGINT) AS pct_{n}" for n, g in raster.CLASS_GROUPS.items())
NAMES_SQL = " ".join(f"WHEN {k} THEN '{v}'" for k, v in raster.CLASS_NAMES.items())


@query(
    f"""WITH {ZONED}, n AS (SELECT zone, class, count(*) AS n FROM pixels GROUP BY 1, 2), best AS (SELECT zone, arg_min(class, -n * 1000 + class) AS dominant_class FROM n GROUP BY 1), k AS (SELECT zone, count(*) AS total_pixels, {GROUPS_SQL} FROM pixels GROUP BY 1)
SELECT CAST(zone AS VARCHAR) AS cell_id, dominant_class, CASE dominant_class {NAMES_SQL} END AS dominant_class_name, k.* EXCLUDE (zone) FROM k JOIN best USING (zone)"""
)
def job_land_cover(spark, d):
    """Shares of land-cover classes by zone and the dominant class."""
    p = L.pixels(spark, d).withColumn("cell_id", F.col("zone").cast("string"))
    out = features.land_cover(p.select("cell_id").distinct(), p)
    return out.select("cell_id", "dominant_class", "dominant_class_name", "total_pixels", *(milli(f"pct_{n}") for n in raster.CLASS_GROUPS))


@query(f"WITH {ZONED}, v AS (SELECT zone, CAST(value % 128 AS DOUBLE) AS v FROM pixels WHERE value % 128 <> 127) SELECT CAST(zone AS VARCHAR) AS cell_id, CAST(floor(avg(v) * 1000 + 0.5e0) AS BIGINT) AS mean_impervious_pct, max(v) AS max_impervious_pct, CAST(floor(avg(CASE WHEN v >= 50 THEN 1e0 ELSE 0e0 END) * 1000 + 0.5e0) AS BIGINT) AS pct_high_impervious, CAST(avg(v) >= 30 AS INTEGER) AS is_built_up, count(*) AS valid_pixel_count FROM v GROUP BY 1")
def job_impervious(spark, d):
    """Imperviousness by zone, one value standing for missing."""
    p = L.pixels(spark, d).select(F.col("zone").cast("string").alias("cell_id"), (F.col("value") % 128).cast("double").alias("value"))
    out = features.impervious(p.select("cell_id").distinct(), p, 127.0).filter("valid_pixel_count > 0")
    return out.select("cell_id", milli("mean_impervious_pct"), "max_impervious_pct", milli("pct_high_impervious"), "is_built_up", "valid_pixel_count")


LAPPED = "greatest(0e0, least(x + 1000, {x1}) - greatest(x - 1000, {x0})) * greatest(0e0, least(y + 1000, {y1}) - greatest(y - 1000, {y0}))"
OUTER = LAPPED.format(x0="x0", x1="x1", y0="y0", y1="y1")
HOLE = LAPPED.format(x0="(x0 + 4000)", x1="(x1 - 4000)", y0="(y0 + 4000)", y1="(y1 - 4000)")
ISLAND = LAPPED.format(x0="(x0 + 6000)", x1="(x1 - 6000)", y0="(y0 + 6000)", y1="(y1 - 6000)")


@query(
    f"""WITH {L.POINTS}, {L.BOXES}, j AS (SELECT id, poly_name, poly_id % 3 + 1 AS gap, {OUTER} - {HOLE} + {ISLAND} AS piece FROM points p JOIN boxes b ON poly_id % 3 <> 2 AND x + 1000 > x0 AND x - 1000 < x1 AND y + 1000 > y0 AND y - 1000 < y1),
o AS (SELECT id, sum(piece) / 4e6 AS share, arg_max(poly_name, piece) AS poly_name, min(gap) AS gap FROM j WHERE piece > 0 GROUP BY 1)
SELECT CAST(p.id AS VARCHAR) AS cell_id, CAST(coalesce(share, 0) > 0 AS INTEGER) AS in_protected_area, CAST(floor(coalesce(share, 0) * 1000 + 0.5e0) AS BIGINT) AS protected_area_pct, poly_name AS protected_area_name, CAST(gap AS INTEGER) AS gap_status_min FROM points p LEFT JOIN o ON p.id = o.id"""
)
def job_protected(spark, d):
    """Share of square cells under areas that have a hole with an island in it."""
    around = lambda m, turn: F.array(*(F.struct(x.alias("x"), y.alias("y")) for x, y in [(F.col("x0") + m, F.col("y0") + m), (F.col("x1") - m, F.col("y0") + m), (F.col("x1") - m, F.col("y1") - m), (F.col("x0") + m, F.col("y1") - m)][::turn]))
    areas = L.boxes(spark, d).select("poly_id", F.array(around(0, 1), around(4000, -1), around(6000, 1)).alias("rings"), F.col("poly_name").alias("Unit_Nm"), (F.col("poly_id") % 3 + 1).cast("string").alias("GAP_Sts"))
    square = F.array(*(F.struct((F.col("x") + a).alias("x"), (F.col("y") + b).alias("y")) for a, b in ((-1000, -1000), (1000, -1000), (1000, 1000), (-1000, 1000))))
    out = features.protected_area(cells(spark, d).select("cell_id", square.alias("ring")), areas, 10_000.0)
    return out.select("cell_id", "in_protected_area", milli("protected_area_pct"), "protected_area_name", "gap_status_min")


MONTHS = ", ".join(f"({m}, {n})" for m, n in enumerate(clean.DAYS, 1))


@query(
    f"""WITH {L.POINTS}, {L.PIXELS}, days(m, n) AS (VALUES {MONTHS}), t AS (SELECT p.id, value % 35 - 6 AS mean, value FROM points p LEFT JOIN pixels ON row = p.id % 300 AND col = (p.id * 7) % 300),
c AS (SELECT id, sum(greatest((value + m * 3) % 35 - 6 - 18.3e0, 0e0) * n) AS cdd FROM t CROSS JOIN days WHERE value IS NOT NULL GROUP BY 1)
SELECT CAST(t.id AS VARCHAR) AS cell_id, CAST(mean AS DOUBLE) AS mean_temp_c, CAST(floor(cdd * 1000 + 0.5e0) AS BIGINT) AS annual_cdd, CASE WHEN mean IS NULL THEN NULL WHEN mean < 5 THEN 'Cold' WHEN mean < 12 THEN 'Cool' WHEN mean < 18 THEN 'Moderate' WHEN mean < 24 THEN 'Warm' ELSE 'Hot' END AS climate_zone, CAST(coalesce(mean < 12, FALSE) AS INTEGER) AS cooling_favorable
FROM t LEFT JOIN c ON t.id = c.id"""
)
def job_climate(spark, d):
    """Temperature of the year and its months under each cell."""
    bands = L.pixels(spark, d).select("row", "col", "value", F.explode(F.sequence(F.lit(0), F.lit(12))).alias("band"))
    pixels = bands.select("row", "col", "band", ((F.col("value") + F.col("band") * 3) % 35 - 6).cast("double").alias("value"))
    at = cells(spark, d).select("cell_id", (F.col("id") % 300).cast("int").alias("row"), (F.col("id") * 7 % 300).cast("int").alias("col"))
    return features.climate(at, pixels).select("cell_id", "mean_temp_c", milli("annual_cdd"), "climate_zone", "cooling_favorable")


@query(
    f"""WITH {L.POINTS}, {L.BOXES}, b AS (SELECT *, CASE WHEN poly_id % 7 <> 3 THEN poly_id * 2e0 END AS raw FROM boxes), s AS (SELECT p.id, p.x, p.y, b.* FROM points p LEFT JOIN b ON {INSIDE} AND raw IS NOT NULL),
o AS (SELECT p.id, arg_max(b.poly_id, coalesce(raw, -1)) AS poly_id FROM points p JOIN b ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY 1), j AS (SELECT s.id, b.* FROM s LEFT JOIN o ON s.id = o.id LEFT JOIN b ON b.poly_id = coalesce(s.poly_id, o.poly_id))
SELECT CAST(id AS VARCHAR) AS cell_id, raw AS water_stress_score, CAST(poly_id % 6 - 1 AS BIGINT) AS water_stress_cat, poly_name AS water_stress_label, CAST(coalesce(poly_id % 6 - 1 >= 3, FALSE) AS INTEGER) AS high_water_stress, CAST(coalesce(poly_id % 6 - 1 = 4, FALSE) AS INTEGER) AS extreme_water_stress, CAST(coalesce(poly_id % 6 = 0, FALSE) AS INTEGER) AS arid_low_use,
poly_id * 3e0 AS water_depletion_score, CAST(coalesce(poly_id % 4 >= 2, FALSE) AS INTEGER) AS high_drought_risk, CAST(coalesce(poly_id / 24e0 >= 0.5, FALSE) AS INTEGER) AS high_drought_risk_raw, code * 1e0 AS overall_water_risk FROM j"""
)
def job_water(spark, d):
    """Water risk of the basin that holds each cell; a sentinel stands for no score."""
    k = F.col("poly_id")
    basins = L.boxes(spark, d).select(
        "rings", F.when(k % 7 != 3, k * 2.0).otherwise(-9999.0).alias("bws_raw"), (k % 6 - 1).cast("double").alias("bws_cat"), F.col("poly_name").alias("bws_label"), (k * 3.0).alias("bwd_raw"), F.lit(1.0).alias("iav_raw"), F.lit(1.0).alias("gtd_raw"), (k / 24.0).alias("drr_raw"), (k % 4).cast("double").alias("drr_cat"), F.col("code").cast("double").alias("w_awr_def_tot_raw"),
    )
    out = features.water_stress(cells(spark, d), basins, 10_000.0)
    return out.select("cell_id", "water_stress_score", "water_stress_cat", "water_stress_label", "high_water_stress", "extreme_water_stress", "arid_low_use", "water_depletion_score", "high_drought_risk", "high_drought_risk_raw", "overall_water_risk")


@query(
    f"""WITH {L.POINTS}, {L.BOXES}, g AS (SELECT * FROM boxes WHERE code <> 2)
SELECT CAST(p.id AS VARCHAR) AS cell_id, CAST(poly_id AS VARCHAR) AS block_group_fips, poly_id * 4e0 AS pm25_pctile, CASE WHEN poly_id % 5 <> 0 THEN poly_id * 3e0 END AS traffic_pctile, CAST(floor(poly_id / 8e0 * 1000 + 0.5e0) AS BIGINT) AS demographic_index, CAST(coalesce(poly_id * 4 >= 80, FALSE) AS INTEGER) AS high_pm25, 0 AS high_traffic, CAST(coalesce(poly_id / 8e0 >= 2, FALSE) AS INTEGER) AS high_ej_burden, poly_id * 1e0 AS ej_pm25_pctile, CASE WHEN poly_id IS NOT NULL THEN CAST(floor(least(1e0, poly_id / 32e0) * 1000 + 0.5e0) AS BIGINT) END AS demographic_index_norm
FROM points p LEFT JOIN g ON {INSIDE}"""
)
def job_justice(spark, d):
    """Percentiles of the block group that holds each cell, those of territories left out."""
    k = F.col("poly_id")
    b = L.boxes(spark, d).filter("code <> 2")
    groups = b.select(k.cast("string").alias("GEOID"), "rings")
    table = b.select(k.cast("string").alias("ID"), (k * 4).cast("string").alias("P_PM25"), F.when(k % 5 == 0, "none").otherwise((k * 3).cast("string")).alias("P_PTRAF"), (k / 8.0).cast("string").alias("DEMOGIDX_2"), F.concat(k.cast("string"), F.lit(" %ile")).alias("T_PM25"), F.lit("n/a").alias("T_PTRAF"))
    out = features.environmental_justice(cells(spark, d), groups, table, 10_000.0)
    return out.select("cell_id", "block_group_fips", "pm25_pctile", "traffic_pctile", milli("demographic_index"), "high_pm25", "high_traffic", "high_ej_burden", "ej_pm25_pctile", milli("demographic_index_norm"))


@query(
    f"""WITH {L.POINTS}, {L.SITES}, op AS (SELECT site_nation % 7 AS state, site_nation AS county, site % 3 AS ba, CAST(mw AS DOUBLE) AS mw FROM sites), qu AS (SELECT nation % 7 AS state, nation AS county, id % 4 AS ba, CAST(id % 50 AS DOUBLE) AS mw FROM points WHERE segment = 'BUILDING'),
oc AS (SELECT county, sum(mw) AS mw FROM op GROUP BY 1), qc AS (SELECT county, sum(mw) AS mw, count(*) AS n FROM qu GROUP BY 1), ob AS (SELECT ba, sum(mw) AS mw FROM op GROUP BY 1), qb AS (SELECT ba, sum(mw) AS mw, count(*) AS n FROM qu GROUP BY 1),
bn AS (SELECT county, ba, count(*) AS n FROM op GROUP BY 1, 2), bc AS (SELECT county, arg_min(ba, -n * 10 + ba) AS ba FROM bn GROUP BY 1)
SELECT CAST(p.id AS VARCHAR) AS cell_id, 'B' || bc.ba AS ba_code, coalesce(oc.mw, 0) AS operating_capacity_mw, coalesce(qc.mw, 0) AS queue_capacity_mw, coalesce(qc.n, 0) AS queue_generator_count, CAST(floor(coalesce(qc.mw, 0) / greatest(coalesce(oc.mw, 0), 1e0) * 1000 + 0.5e0) AS BIGINT) AS queue_congestion_ratio,
CASE WHEN bc.ba IS NULL THEN 0 ELSE coalesce(ob.mw, 0) END AS operating_capacity_mw_ba, CASE WHEN bc.ba IS NULL THEN 0 ELSE coalesce(qb.mw, 0) END AS queue_capacity_mw_ba, CASE WHEN bc.ba IS NULL THEN 0 ELSE coalesce(qb.n, 0) END AS queue_generator_count_ba
FROM points p LEFT JOIN oc ON oc.county = p.nation LEFT JOIN qc ON qc.county = p.nation LEFT JOIN bc ON bc.county = p.nation LEFT JOIN ob ON ob.ba = bc.ba LEFT JOIN qb ON qb.ba = bc.ba"""
)
def job_capacity(spark, d):
    """Operating and queued capacity by county and by the county's most frequent authority."""
    place = lambda n: [(n % 7).cast("string").alias("state"), n.cast("string").alias("county")]
    code = lambda c: F.concat(F.lit("B"), c.cast("string")).alias("ba_code")
    s, p = L.sites(spark, d), L.points(spark, d)
    operating = s.select(*place(F.col("site_nation")), code(F.col("site") % 3), F.col("mw").cast("double").alias("mw"))
    queued = p.filter("segment = 'BUILDING'").select(*place(F.col("nation")), code(F.col("id") % 4), (F.col("id") % 50).cast("double").alias("mw"))
    at = p.select(F.col("id").cast("string").alias("cell_id"), *place(F.col("nation")))
    out = features.capacity_and_queue(at, operating, queued, operating.withColumn("ba_name", F.concat(F.lit("name "), "ba_code")))
    return out.select("cell_id", "ba_code", "operating_capacity_mw", "queue_capacity_mw", "queue_generator_count", milli("queue_congestion_ratio"), "operating_capacity_mw_ba", "queue_capacity_mw_ba", "queue_generator_count_ba")


@query(
    f"""WITH {L.POINTS}, t AS (SELECT s_suppkey AS u, s_suppkey % 50 * 1000e0 AS revenue, s_suppkey % 20 * 100e0 AS volume FROM supplier WHERE s_suppkey % 5 <> 0 AND s_suppkey % 20 >= 10), m AS (SELECT DISTINCT id % 97 + 1 AS u, nation FROM points), z AS (SELECT u, count(*) AS n FROM m GROUP BY 1),
e AS (SELECT m.u % 7 AS state, nation, sum(revenue / n) / sum(volume / n) AS price, count(*) AS utilities FROM m JOIN z USING (u) JOIN t USING (u) GROUP BY 1, 2)
SELECT CAST(p.id AS VARCHAR) AS cell_id, CAST(floor(price * 1000 + 0.5e0) AS BIGINT) AS industrial_price_mwh, utilities AS utility_count FROM points p LEFT JOIN e ON e.state = p.id % 7 AND e.nation = p.nation"""
)
def job_price(spark, d):
    """Industrial price by county, sales dealt evenly over the counties that a utility serves; small ones left out."""
    s, p = L.sites(spark, d), L.points(spark, d)
    state = lambda c: (c % 7).cast("string").alias("state")
    k, u = F.col("site"), F.col("id") % 97 + 1
    sales = s.select(k.cast("string").alias("utility_number"), state(k), F.when(k % 5 == 0, "B").otherwise("A").alias("part"), F.lit("Bundled").alias("service_type"), (k % 50).cast("double").alias("revenue_kusd"), (k % 20 * 100).cast("double").alias("sales_mwh"))
    territory = p.select(u.cast("string").alias("utility_number"), state(u), F.col("nation").cast("string").alias("county"))
    at = p.select(F.col("id").cast("string").alias("cell_id"), state(F.col("id")), F.col("nation").cast("string").alias("county"))
    return features.industrial_price(at, sales, territory).select("cell_id", milli("industrial_price_mwh"), "utility_count")


def _mix_sql(end):
    share = lambda c: f"CAST(floor(100e0 * {c} / nullif(sun + nc + cl, 0) * 1000 + 0.5e0) AS BIGINT)"
    return f"{share('sun')} AS renewable_pct_{end}, {share('nc')} AS nuclear_pct_{end}, {share('cl')} AS fossil_pct_{end}, co2 AS co2_lb_mwh_{end}, net AS net_generation_mwh_{end}"


def _fuel_sql(key):
    part = lambda i: f"CAST(sum(CASE WHEN site % 3 = {i} THEN mw ELSE 0 END) AS DOUBLE)"
    return f"SELECT {key} AS k, {part(0)} AS sun, {part(1)} AS nc, {part(2)} AS cl, CAST(max(mw) AS DOUBLE) AS co2, CAST(sum(mw) AS DOUBLE) AS net FROM sites GROUP BY 1"


@query(
    f"""WITH {L.POINTS}, {L.SITES}, {L.BOXES}, g1 AS ({_fuel_sql('site % 10')}), g2 AS ({_fuel_sql('site_nation')}), a AS (SELECT k AS ba, {_mix_sql('ba')} FROM g1), s AS (SELECT k AS sub, {_mix_sql('subregion')} FROM g2),
n AS (SELECT site_nation AS county, site % 10 AS ba, count(*) AS n FROM sites GROUP BY 1, 2), c AS (SELECT county, arg_min(ba, -n * 100 + ba) AS ba FROM n GROUP BY 1)
SELECT CAST(p.id AS VARCHAR) AS cell_id, poly_name AS egrid_subregion, 'B' || c.ba AS ba_code, a.* EXCLUDE (ba), s.* EXCLUDE (sub) FROM points p LEFT JOIN boxes ON {INSIDE} LEFT JOIN c ON c.county = p.nation LEFT JOIN a ON a.ba = c.ba LEFT JOIN s ON s.sub = poly_id"""
)
def job_grid_mix(spark, d):
    """The subregion that holds each cell, its county's authority, and the generation of both by fuel."""
    s = L.sites(spark, d)
    fuels = ["SUN", "NC", "CL"]
    rows = lambda key: s.groupBy(key).agg(*(F.sum(F.when(F.col("site") % 3 == i, F.col("mw")).otherwise(0)).cast("double").alias(n) for i, n in enumerate(fuels)), F.max("mw").cast("double").alias("co2"), F.lit(0.0).alias("co2e"), F.sum("mw").cast("double").alias("net"))
    mix = lambda r, key, end: features.generation_mix(r, key, end, fuels, ["SUN"], fossil=["CL"])
    code = F.concat(F.lit("B"), (F.col("site") % 10).cast("string")).alias("ba_code")
    boxes = L.boxes(spark, d).withColumnRenamed("poly_name", "egrid_subregion")
    names = boxes.select(F.col("poly_id").alias("site_nation"), "egrid_subregion")
    by_subregion = rows(F.col("site_nation")).join(names, "site_nation")
    counties = s.select(F.col("site_nation").cast("string").alias("county_fips"), code, F.concat(F.lit("name "), code).alias("ba_name"))
    at = cells(spark, d).withColumn("county_fips", F.col("nation").cast("string"))
    out = features.grid_mix(at, boxes.select("egrid_subregion", "rings"), counties, mix(rows(code), "ba_code", "ba"), mix(by_subregion, "egrid_subregion", "subregion"), 10_000.0)
    kept = [f"{c}_{end}" for end in ("ba", "subregion") for c in ("co2_lb_mwh", "net_generation_mwh")]
    return out.select("cell_id", "egrid_subregion", "ba_code", *kept, *(milli(f"{c}_pct_{end}") for end in ("ba", "subregion") for c in ("renewable", "nuclear", "fossil")))


def _nearest_sql(name, where):
    return f"{name} AS (SELECT id, s.*, {D2} AS d2, row_number() OVER (PARTITION BY id ORDER BY {D2}, site_name) AS k FROM points p, sites s WHERE {where})"


@query(
    f"""WITH {L.POINTS}, {L.SITES}, {_nearest_sql('a', 'mw >= 50')}, {_nearest_sql('b', 'mw >= 250')}, {_nearest_sql('c', 'mw % 7 = 0')}, w AS (SELECT id, count(*) AS n FROM c WHERE d2 <= 400000000e0 GROUP BY 1)
SELECT CAST(p.id AS VARCHAR) AS cell_id, CAST(floor(sqrt(a.d2) / 1000 * 1000 + 0.5e0) AS BIGINT) AS dist_nearest_city_50k_km, a.site_name AS nearest_city_50k_name, CAST(floor(sqrt(b.d2) / 1000 * 1000 + 0.5e0) AS BIGINT) AS dist_nearest_city_100k_km, b.site_name AS nearest_city_100k_name,
CAST(floor(sqrt(c.d2) / 1000 * 1000 + 0.5e0) AS BIGINT) AS dist_nearest_cloud_km, c.site_name AS nearest_cloud_region_name, coalesce(w.n, 0) AS cloud_regions_within_500km
FROM points p JOIN a ON a.id = p.id AND a.k = 1 JOIN b ON b.id = p.id AND b.k = 1 JOIN c ON c.id = p.id AND c.k = 1 LEFT JOIN w ON w.id = p.id"""
)
def job_markets(spark, d):
    """Nearest city of two sizes, nearest cloud region, and regions within 20 km."""
    s = L.sites(spark, d).withColumn("name", F.col("site_name"))
    city = lambda least: s.filter(F.col("mw") >= least).select("name", "sx", "sy")
    clouds = s.filter("mw % 7 = 0").select(F.lit("p").alias("provider"), F.lit("r").alias("region"), "name", "sx", "sy")
    out = features.market_proximity(cells(spark, d), {"50k": city(50), "100k": city(250)}, clouds, 20_000.0)
    names = ["nearest_city_50k_name", "nearest_city_100k_name", "nearest_cloud_region_name", "cloud_regions_within_500km"]
    return out.select("cell_id", *names, *(milli(f"dist_nearest_{c}_km") for c in ("city_50k", "city_100k", "cloud")))


@query(
    f"""WITH {L.POINTS}, {L.PIXELS}, v AS (SELECT row, col, CASE WHEN value % 11 = 0 THEN -1e0 ELSE value % 400 * 1e0 END AS d FROM pixels), t AS (SELECT p.id, p.id * 7 % 300 * 90 // 1000 AS gx, p.id % 300 * 90 // 1000 AS gy, d FROM points p LEFT JOIN v ON row = p.id % 300 AND col = p.id * 7 % 300 AND d >= 0),
m AS (SELECT (col * 90 + 45) // 1000 AS gx, (row * 90 + 45) // 1000 AS gy, avg(d) AS people FROM v WHERE d >= 0 GROUP BY 1, 2), w AS (SELECT t.id, sum(people) AS around FROM t JOIN m ON (m.gx - t.gx) * (m.gx - t.gx) + (m.gy - t.gy) * (m.gy - t.gy) <= 9 GROUP BY 1)
SELECT CAST(t.id AS VARCHAR) AS cell_id, d * 2.5e0 AS pop_count_cell, d AS pop_density_km2, CASE WHEN d IS NULL THEN 'No Data' WHEN d = 0 THEN 'Unpopulated' WHEN d < 10 THEN 'Very Rural' WHEN d < 50 THEN 'Rural' WHEN d < 250 THEN 'Suburban' WHEN d < 1000 THEN 'Urban' ELSE 'Dense Urban' END AS pop_density_class,
CAST(floor(coalesce(around, 0) * 1000 + 0.5e0) AS BIGINT) AS pop_within_25mi, CAST(coalesce(d < 50, FALSE) AS INTEGER) AS is_rural, CAST(coalesce(around, 0) < 10000 AS INTEGER) AS is_isolated, CAST(d IS NOT NULL AS INTEGER) AS pixel_count FROM t LEFT JOIN w ON w.id = t.id"""
)
def job_population(spark, d):
    """Density under each cell, and people within three cells of a grid of 1 km that the raster is averaged to."""
    v = F.when(F.col("value") % 11 == 0, -1.0).otherwise((F.col("value") % 400).cast("double"))
    pixels = L.pixels(spark, d).select("row", "col", v.alias("value"))
    grid = raster.regridded(pixels.filter("value >= 0"), F.col("col") * 90 + 45.0, F.col("row") * 90 + 45.0, 1000.0)
    row, col = F.col("id") % 300, F.col("id") * 7 % 300
    at = cells(spark, d).select("cell_id", row.cast("int").alias("row"), col.cast("int").alias("col"), F.floor(row * 90 / 1000).cast("int").alias("mrow"), F.floor(col * 90 / 1000).cast("int").alias("mcol"))
    out = features.population(at, pixels, grid.select(F.col("gy").cast("int").alias("row"), F.col("gx").cast("int").alias("col"), "value"), 2.5, 3, 27)
    return out.select("cell_id", "pop_count_cell", "pop_density_km2", "pop_density_class", milli("pop_within_25mi"), "is_rural", "is_isolated", "pixel_count")
