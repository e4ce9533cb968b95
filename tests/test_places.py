"""Named places, guards and records on small frames."""

import pytest
from pyspark.sql import functions as F

from hexfield.functions import clean, geo
from hexfield.operators import grid, model, places, scoring, tables
from hexfield.plans import features


def ring(x0, y0, x1, y1):
    return [(float(x0), float(y0)), (float(x1), float(y0)), (float(x1), float(y1)), (float(x0), float(y1))]


RINGS = "rings array<array<struct<x:double,y:double>>>"


def counties(spark):
    rows = [("48", "1", "Kent County", [ring(0, 0, 10, 10)]), ("48", "2", "Kent city", [ring(10, 0, 20, 10)]), ("72", "3", "Far Municipio", [ring(20, 0, 30, 10)]), ("6", "4", "Lee Parish", [ring(5, 5, 9, 9)])]
    return spark.createDataFrame(rows, f"STATEFP string, COUNTYFP string, NAME string, {RINGS}")


def test_counties(spark):
    layer = {r.county_fips: (r.state, r.county) for r in places.county_layer(counties(spark)).collect()}
    assert layer == {"48001": ("TX", "kent"), "48002": ("TX", "kent"), "06004": ("CA", "lee")}
    kept = {r.county for r in places.county_layer(counties(spark), clean.COUNTY_ENDINGS_KEEP_CITY).collect()}
    assert kept == {"kent", "kent city", "lee"}
    cells = spark.createDataFrame([("in", 2.0, 2.0, "old"), ("both", 6.0, 6.0, "old"), ("edge", 10.0, 5.0, "old"), ("far", 25.0, 5.0, "old"), ("none", None, 5.0, "old")], "cell_id string, x double, y double, state string")
    got = {r.cell_id: (r.county_fips, r.state) for r in places.with_county(cells, places.county_layer(counties(spark)), size=10.0).collect()}
    assert got == {"in": ("48001", "TX"), "both": ("06004", "CA"), "edge": (None, None), "far": (None, None), "none": (None, None)}
    named = places.by_name(spark.createDataFrame([(" tx ", "KENT COUNTY"), ("", None)], "state string, county string")).collect()
    assert [tuple(r) for r in named] == [("TX", "kent"), (None, None)]


def test_cities(spark):
    names = spark.createDataFrame([("Salem",), ("Carson City",), (None,), (" ",)], "name string")
    assert {r[0] for r in places.spelled(names).collect()} == {"Salem", "Salem city", "Carson City", "Carson"}
    told = ["Salem", "Salem city", "Salem (old part)", "Salem Town", "salem", "Carson", "Carson City town", None]
    layer = spark.createDataFrame([(n, [ring(0, 0, 2, 2), ring(4, 0, 6, 2)]) for n in told], f"NAME string, {RINGS}")
    got = places.cities(layer, names).collect()
    assert sorted(r.name for r in got) == sorted(["Salem", "Salem city", "Salem (old part)", "Salem Town", "Carson", "Carson City town"])
    assert {(r.sx, r.sy) for r in got} == {(3.0, 1.0)}
    assert [r[0] for r in spark.createDataFrame([("A town city",), ("B city town",), ("City",)], "n string").select(clean.place_name(F.col("n"))).collect()] == ["A", "B city", "City"]


def test_centroid_of_holes(spark):
    hole = ring(1, 1, 3, 3)[::-1]
    df = spark.createDataFrame([([ring(0, 0, 8, 4), hole],), ([ring(0, 0, 0, 0)],), ([],)], RINGS)
    one, flat, none = (r[0] for r in df.select(geo.rings_centroid(F.col("rings"))).collect())
    assert one.x == pytest.approx((4 * 32 - 2 * 4) / 28) and one.y == pytest.approx(2.0) and flat.x is None and none.x is None


def test_states(spark):
    df = spark.createDataFrame([(33.0, -87.0), (31.33, -114.82), (0.0, 0.0), (None, -87.0)], "lat double, lon double")
    assert [r[0] for r in df.select(places.state_at(F.col("lat"), F.col("lon"))).collect()] == ["AL", "AZ", None, None]
    assert places.cloud_regions(spark).count() == 24


def test_grid_guard(spark):
    staged = spark.createDataFrame([("b", 40.0, -96.0), ("a", 0.0, 0.0), ("c", None, 1.0)], "__index_level_0__ string, lat double, lon double")
    got = {r.cell_id: r for r in grid.center_points(staged, albers_too=True).collect()}
    assert got["a"].x == 0.0 and abs(got["a"].y) < 1e-6 and abs(got["b"].ax) < 1e-6 and got["b"].ay > 1e6 and got["c"].y is None
    assert {r.cell_id for r in grid.center_points(staged, first=2).collect()} == {"a", "b"}
    with pytest.raises(ValueError, match="lon"):
        grid.center_points(staged.drop("lon"))
    with pytest.raises(ValueError, match="cell_id"):
        grid.center_points(staged.drop("__index_level_0__"))


def test_merge_guard(spark):
    flags = {c: F.lit(0) for c in scoring.HARD_EXCLUSIONS}
    master = spark.createDataFrame([("a", 1), ("b", None), ("c", None)], "cell_id string, has_dc int").withColumns(flags)
    scores = spark.createDataFrame([("a", 0.5, 0, 1), ("b", 0.25, 1, None)], "cell_id string, viability double, has_dc int, is_soft int")
    got = {r.cell_id: (r.viability, r.has_dc, r.is_soft) for r in scoring.merged(master, scores).collect()}
    assert got == {"a": (0.5, 1, 1), "b": (0.25, 1, 0), "c": (0.0, 0, 0)}
    assert {r.has_dc for r in scoring.merged(master.drop("has_dc"), scores.drop("has_dc", "is_soft")).withColumn("has_dc", F.col("is_soft")).collect()} == {0}
    with pytest.raises(ValueError, match="in_wetland"):
        scoring.merged(master.drop("in_wetland"), scores)
    with pytest.raises(ValueError, match="viability"):
        scoring.merged(master, scores.drop("viability"))


def test_order(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "extra int, f2 int, has_dc int, cell_id int, f1 int")
    assert tables.ordered(df, ["cell_id"], ["f1", "f2", "f3"], ["has_dc"]).columns == ["cell_id", "f1", "f2", "has_dc", "extra"]
    with pytest.raises(ValueError, match="lat"):
        tables.ordered(df, ["cell_id", "lat"], [], [])
    cells = spark.createDataFrame([("a", 40.0, -100.0)], "cell_id string, lat double, lon double")
    f = spark.createDataFrame([("a", 3.0, 9)], "cell_id string, dist_tx_line_km double, pct_wetland int")
    labels = spark.createDataFrame([("a", 1, 2)], "cell_id string, facility_count int, has_dc int")
    out = features.assemble(cells, [f], labels, ["pct_wetland", "dist_transmission_km"])
    assert out.columns == ["cell_id", "lat", "lon", "is_conus", "pct_wetland", "dist_transmission_km", "has_dc", "facility_count"]


def test_record_without_a_class(spark):
    rows = [(1, 0, 1, 0, 0.9), (2, 0, 0, 1, 0.1), (3, 1, 0, 0, 0.5)]
    df = spark.createDataFrame(rows, "id int, is_test int, has_dc int, is_soft int, score double")
    got = model.evaluation_record(df, "id", {"model": "m"}).first()
    assert (got.model, got.train_cells, got.test_cells, got.train_soft_positives, got.train_auc_roc, got.auc_roc, got.precision_at_r60, got.top_100_precision) == ("m", 2, 1, 1, 1.0, None, None, 0.0)
    empty = model.evaluation_record(df.filter("is_test = 0"), "id", {"model": "m"}).collect()
    assert len(empty) == 1 and empty[0].test_cells == 0 and empty[0].auc_pr is None


def test_facilities(spark):
    rows = [("1", 40.0, -75.0, " Site ", "Op", "building", 5), ("2", 40.0, -75.0, "site", None, "campus", None), ("3", 40.0, -75.0, "Other", None, None, 9), ("4", None, -75.0, "Lost", None, "point", 1)]
    raw = spark.createDataFrame(rows, "id string, lat double, lon double, name string, operator string, type string, sqft long").withColumns({c: F.lit("x") for c in ("state", "state_abb", "county")})
    out = features.ingest_facilities(raw, 2000.0, "told")
    assert out.columns == features.FACILITY_COLUMNS
    assert sorted((r.name, r.type, r.source) for r in out.collect()) == [("Other", None, "told"), ("site", "campus", "told")]
    states = spark.createDataFrame([("tx",), (" PR ",), (None,), ("PR",)], "state_abb string")
    assert [r[0] for r in places.unknown_states(states).collect()] == ["PR"]
