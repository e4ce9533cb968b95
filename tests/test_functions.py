"""Hand-computed cases of the functions and operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexfield.functions import clean, geo
from hexfield.operators import dedupe, grid, model, raster, scoring, spatial, tables
from hexfield.sources import readers, writers


def value(spark, column, **fields):
    df = spark.range(1).select(*(F.expr(v).alias(k) for k, v in fields.items())) if fields else spark.range(1)
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("name", "want"), [("Carson City", "carson"), ("Juneau City and Borough", "juneau city and"), (" Kent County ", "kent"), ("  ", None), (None, None)])
def test_county_endings(spark, name, want):
    assert value(spark, clean.strip_endings(F.lit(name).cast("string"))) == want


def test_county_endings_keep_city(spark):
    assert value(spark, clean.strip_endings(F.lit("Carson City"), clean.COUNTY_ENDINGS_KEEP_CITY)) == "carson city"


@pytest.mark.parametrize(("text", "want"), [("San Buenaventura (Ventura) city", "San Buenaventura"), ("Kent city", "Kent"), ("Kent TOWN", "Kent")])
def test_place(spark, text, want):
    assert value(spark, clean.place_name(F.lit(text))) == want


@pytest.mark.parametrize(("text", "want"), [("83 %ile (9.1 ug)", 83.0), (None, None), ("none", None)])
def test_first_number(spark, text, want):
    assert value(spark, clean.first_number(F.lit(text).cast("string"))) == want


def test_fallback(spark):
    assert value(spark, clean.fallback_measure(clean.number(F.lit("x")), clean.number(F.lit("3.5")))) == 3.5
    assert value(spark, clean.fallback_measure(F.lit(-1.0), F.lit(0.0))) is None


def test_degree_days(spark):
    assert value(spark, clean.cooling_degree_days(F.array(*[F.lit(20.3)] * 12))) == pytest.approx(730)
    assert value(spark, clean.cooling_degree_days(F.array(*[F.lit(20.3)] * 11, F.lit(None).cast("double")))) is None


def test_isolated(spark):
    assert [value(spark, clean.flag_below(F.lit(v).cast("double"), 10000, null_is_zero=False)) for v in (9999, 10000, None)] == [1, 0, None]


def test_density_bins(spark):
    edges = [(1e-300, "Unpopulated"), (10, "Very Rural"), (50, "Rural"), (250, "Suburban"), (1000, "Urban")]
    got = [value(spark, clean.bins(F.lit(v).cast("double"), edges, "Dense Urban", "No Data")) for v in (None, 0, 9.9, 10, 1000)]
    assert got == ["No Data", "Unpopulated", "Very Rural", "Rural", "Dense Urban"]


def test_ratings(spark):
    assert [value(spark, clean.rating_flag(F.lit(r).cast("string"), ["Relatively High", "Very High"])) for r in ("Relatively Moderate", " Very High", "No Rating", None)] == [0, 1, 0, 0]


def test_sentinels(spark):
    df = spark.createDataFrame([(-9999.0,), (9999.0,), (-1.0,)], "v double")
    assert [r.v for r in clean.mask_sentinels(df).collect()] == [None, None, -1.0]


def test_flood_merge(spark):
    df = spark.createDataFrame([(None, 40.0, None, 5.0, "c", "i"), (None, None, None, None, "c", "i")], "c_score double, i_score double, c_loss double, i_loss double, c_rating string, i_rating string")
    got = [tuple(r) for r in df.select(*tables.merged_hazard("c", "i")).collect()]
    assert got == [(40.0, 5.0, "i"), (None, None, "c")]


def test_labels(spark):
    rows = [("a", None, "Z", "point", "b"), ("a", None, "A", "building", "b"), ("a", None, "Z", None, "a"), ("a", None, None, "point", "a"), ("b", 5, "the AWS east", None, None), ("b", None, None, None, None)]
    got = {r.cell_id: r for r in tables.cell_labels(spark.createDataFrame(rows, "cell_id string, sqft int, operator string, type string, state_abb string")).collect()}
    assert (got["a"].total_sqft, got["a"].operators, got["a"].dominant_type, got["a"].state_abb) == (None, "A, Z", "building", "a")
    assert (got["b"].total_sqft, got["b"].has_hyperscaler, got["b"].dominant_type, got["b"].state_abb) == (5, 1, "point", None)


def test_equal_shares(spark):
    totals = spark.createDataFrame([("u", 10000.0, 2000.0)], "u string, rev double, mwh double")
    places = spark.createDataFrame([("u", 1), ("u", 2)], "u string, place int")
    got = [(r.rev, r.mwh, r.price) for r in tables.equal_shares(totals, places, "u", "place", "rev", "mwh", 1000).collect()]
    assert got == [(5000.0, 1000.0, 5.0)] * 2


def test_penalty(spark):
    ones = spark.range(1).select(*(F.lit(1.0).alias(f"c_{c}") for c in scoring.WEIGHTS))
    nulls = spark.range(1).select(*(F.lit(None).cast("double").alias(f"c_{c}") for c in scoring.WEIGHTS))
    assert ones.select(scoring.penalty()).first()[0] == pytest.approx(1.0)
    assert nulls.select(scoring.penalty()).first()[0] == 0.0


def test_hexagons(spark):
    cells = grid.lattice(spark, -5000, -5000, 5000, 5000, 1000.0)
    back = grid.with_cells(cells.select("cell_id", "x", "y").withColumnRenamed("cell_id", "own"), 1000.0)
    assert back.filter("own <> cell_id").count() == 0
    area = grid.with_rings(cells, 1000.0).select(geo.ring_area(F.col("ring")).alias("a")).first()["a"]
    assert area == pytest.approx(3 * math.sqrt(3) / 2 * 1e6)
    assert grid.neighbours(cells.filter("q = 0 and r = 0")).count() == 6


def ring(*points):
    return F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points))


def test_polygons_with_holes(spark):
    rings = F.array(ring((0, 0), (10, 0), (10, 10), (0, 10)), ring((4, 4), (6, 4), (6, 6), (4, 6)))
    at = lambda x, y: value(spark, geo.rings_contain(rings, F.lit(float(x)), F.lit(float(y))))
    assert [at(1, 1), at(5, 5), at(11, 5)] == [True, False, False]
    assert value(spark, geo.on_edge(rings, F.lit(10.0), F.lit(3.0))) and not value(spark, geo.on_edge(rings, F.lit(9.0), F.lit(3.0)))


def test_clip(spark):
    comb = ring((-2, -2), (2, -2), (2, 2), (0.5, 2), (0.5, -1), (-0.5, -1), (-0.5, 2), (-2, 2))
    unit = value(spark, F.abs(geo.ring_area(geo.clip_convex(comb, ring((-1, -1), (1, -1), (1, 1), (-1, 1))))))
    assert unit == pytest.approx(2.0)
    assert value(spark, F.size(geo.clip_convex(ring((5, 5), (6, 5), (6, 6)), ring((-1, -1), (1, -1), (1, 1), (-1, 1))))) == 0


def test_projections(spark):
    assert value(spark, geo.mercator_lat(geo.mercator_y(F.lit(40.0)))) == pytest.approx(40.0)
    x, y = geo.albers(F.lit(-96.0), F.lit(23.0))
    assert value(spark, x) == pytest.approx(0, abs=1e-6) and value(spark, y) == pytest.approx(0, abs=1e-6)
    assert value(spark, geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0))) == pytest.approx(111319.49, abs=0.01)


def test_nearest_without_sites(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0)], "id int, x double, y double")
    none = spark.createDataFrame([], "site int, sx double, sy double")
    assert [tuple(r) for r in spatial.nearest(points, none, "id", ["site"], 10.0).orderBy("id").collect()] == [(1, None, None), (2, None, None)]


def test_nearest_is_exact_when_far(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0)], "id int, x double, y double")
    sites = spark.createDataFrame([(7, 9.0, 9.0), (8, 5000.0, 0.0), (9, 0.0, 12.0)], "site int, sx double, sy double")
    assert [tuple(r) for r in spatial.nearest(points, sites, "id", ["site"], 1.0).orderBy("id").collect()] == [(1, 144.0, 9), (2, None, None)]


def crowds(n):
    """Targets in two far corners, dense ones and repeated places among them."""
    rng = np.random.default_rng(5)
    places = np.concatenate([rng.integers(0, 40, (n, 2)) + 9000, rng.normal(0, 300, (n, 2)) + [-4000, 7000], np.full((n, 2), 9020)])
    return [(i, float(x), float(y)) for i, (x, y) in enumerate(places.tolist())]


def far_points(spark):
    rng = np.random.default_rng(6)
    places = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-10000, 10000, (300, 2)).round().tolist())]
    return places, spark.createDataFrame(places, "id int, x double, y double")


@pytest.mark.parametrize("widest", [-1, spatial.WIDEST])
def test_nearest_of_crowded_sites_far_away(spark, monkeypatch, widest):
    monkeypatch.setattr(spatial, "WIDEST", widest)
    places, points = far_points(spark)
    rows = crowds(400)
    got = spatial.nearest(points, spark.createDataFrame(rows, "site int, sx double, sy double"), "id", ["site", "sx"], 2.0)
    want = {i: min(((x - a) ** 2 + (y - b) ** 2, s, a) for s, a, b in rows) for i, x, y in places}
    assert {r.id: (r.d2, r.site, r.sx) for r in got.collect()} == want


@pytest.mark.parametrize("widest", [-1, spatial.WIDEST])
def test_nearest_segment_of_crowded_ones_far_away(spark, monkeypatch, widest):
    monkeypatch.setattr(spatial, "WIDEST", widest)
    places, points = far_points(spark)
    rows = [(s, x, y, x + 37 * (s % 5), y - 900.0 * (s % 3)) for s, x, y in crowds(60)]
    got = spatial.nearest_segment(points, spark.createDataFrame(rows, "line int, x1 double, y1 double, x2 double, y2 double"), "id", ["line"], 2.0)

    def d2(x, y, x1, y1, x2, y2):
        dx, dy = x2 - x1, y2 - y1
        t = min(1.0, max(0.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
        return (x - x1 - t * dx) ** 2 + (y - y1 - t * dy) ** 2

    want = {i: min(d2(x, y, *r[1:]) for r in rows) for i, x, y in places}
    assert {r.id: r.d2 for r in got.collect()} == pytest.approx(want)


def test_overlapping_pieces_are_capped(spark):
    square = ring((0, 0), (2, 0), (2, 2), (0, 2))
    cells = spark.range(1).select(F.lit("c").alias("cell_id"), square.alias("ring"))
    polygons = spark.createDataFrame([(1, "b", 2), (2, "a", 1)], "poly_id int, name string, code int").withColumn("outer", square)
    got = spatial.overlay(cells, polygons, "cell_id", "name", "code", 1.0).first()
    assert (got.share, got.code) == (1.0, 1)


def test_chained_clusters(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(20)], "a int, b int")
    nodes = spark.createDataFrame([(i,) for i in range(25)], "id int")
    got = {r.id: r.cluster for r in dedupe.clusters(nodes, pairs, "id").collect()}
    assert got == {i: 0 if i <= 20 else i for i in range(25)}


def test_average_precision_is_stepwise(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0)], "score double, label int")
    assert model.average_precision(df).first()[0] == pytest.approx(0.5 + 0.5 * 2 / 3)
    assert model.precision_at_recall(df, 0.6).first()["precision"] == pytest.approx(2 / 3)
    assert model.roc_auc(df).first()["auc"] == pytest.approx(0.75)


def test_focal_sum_at_edges(spark):
    pixels = spark.createDataFrame([(r, c, 1) for r in range(5) for c in range(5)], "row int, col int, value int")
    points = spark.createDataFrame([(1, 0, 0), (2, 2, 2), (3, 20, 20)], "id int, row int, col int")
    assert [r.total for r in raster.focal_disk_sum(points, pixels, "id", 1, 5).orderBy("id").collect()] == [3, 5, 0]


def test_reasons(spark):
    base = {"viability": ".7", "dist_nearest_ixp_km": "50", "elec_price_mwh": "55", "cooling_favorable": "0", "high_ej_burden": "0"} | {c: "cast(null as int)" for c, _ in scoring.FLAG_REASONS} | {c: "cast(null as double)" for c in ("dist_transmission_km", "dist_substation_km", "annual_cdd", "pop_within_25mi", "mean_slope_deg")}
    assert value(spark, scoring.reasons(), **base) == ["Strong backbone connectivity (50 km to IXP)", "Low industrial electricity cost ($55/MWh)"]
    weak = base | {"viability": ".1", "dist_nearest_ixp_km": "cast(null as double)"}
    assert value(spark, scoring.reasons(), **weak) == ["Low combined infrastructure and market accessibility score"]


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,name,other\n01, x ,1\n02,,2\n", encoding="utf-8")
    assert readers.read_some(spark, str(tmp_path / "a.csv"), ["name", "id", "gone"]).columns == ["name", "id"]
    assert readers.flattened(spark.createDataFrame([(1, 2)], "a int, b int"), [["Top", "Top"], ["One", "Two (MW)"]]).columns == ["top_one", "top_two_mw"]
    df = spark.createDataFrame([("a", 0.01), ("b", 0.03), ("c", 0.9)], "id string, score double")
    assert writers.write_basemap(df, str(tmp_path / "m"), ["id", "score"], "score", max_bytes=8) == 0.05
    assert spark.read.csv(str(tmp_path / "m"), header=True).count() == 1
    writers.append_results(spark.createDataFrame([("k", 1, 5.0)], "key string, seq int, v double"), str(tmp_path / "r"))
    writers.append_results(spark.createDataFrame([("k", 2, 6.0)], "key string, seq int, v double"), str(tmp_path / "r"))
    assert [(r.key, r.v) for r in readers.read_json_lines(spark, str(tmp_path / "r"), "key string, seq int, v double", "key", "seq").collect()] == [("k", 6.0)]
    assert readers.choose_layer(["x", "Y_Combined"]) == "Y_Combined"
    with pytest.raises(ValueError):
        readers.choose_layer(["x"], "y")


def test_exchange_sites(spark):
    links = spark.createDataFrame([(1, 10, " ", "Town", "US"), (1, 10, "n", None, None), (2, 11, "m", "c", "US")], "ix_id long, fac_id long, name string, city string, country string")
    fac = spark.createDataFrame([(10, "f", "fc", "US", 40.0, -100.0), (11, "g", "gc", "US", 0.0, 0.0)], "id long, name string, city string, country string, latitude double, longitude double")
    assert [(r.ix_id, r.name, r.city) for r in readers.exchange_sites(links, fac, "US").collect()] == [(1, "f", "Town")]
