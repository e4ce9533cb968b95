"""Queries that write layers to the shared folder and read them again with the library's readers and
writers, each with its SQL.  A run writes to a folder of its own."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import spatial
from ..sources import readers, writers
from ..sources.shared import materialized, shared_folder
from ..streaming import incremental
from . import layers as L

Q: dict = {}


def query(sql: str):
    def add(f):
        Q[f.__name__] = (f, sql)
        return f

    return add


def folder(spark, name):
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/sources/{name}-{uuid.uuid4().hex}"


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS segment, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey * 0.5e0 END AS measure FROM customer")
def csv_typed(spark, d):
    """Typed CSV: ids stay text, text is trimmed, NaN is null."""
    path = folder(spark, "csv")
    t = L.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("segment"), F.when(F.col("c_custkey") % 9 == 0, float("nan")).otherwise(F.col("c_custkey") * 0.5).alias("measure"))
    writers.write_csv(t, path, ["id", "segment", "measure"])
    return readers.read_csv(spark, path, "id string, segment string, measure double")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS site, s_name AS site_name FROM supplier")
def csv_some_columns(spark, d):
    """Wanted columns that a CSV file has; its header begins with a byte-order mark."""
    path = folder(spark, "some")
    t = L.sites(spark, d).select(F.col("site").alias("\ufeffsite"), "mw", "site_name")
    writers.write_csv(t, path, t.columns)
    return readers.read_some(spark, path, ["site", "absent", "site_name"])


@query("SELECT s_suppkey AS utility_number, CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_suppkey * 2 AS DOUBLE) END AS revenue FROM supplier WHERE s_suppkey % 7 <> 0")
def csv_sheet(spark, d):
    """A sheet under three header rows, its numbers as text, some keys and numbers missing."""
    path = folder(spark, "sheet")
    k = F.col("site")
    t = L.sites(spark, d).select(F.when(k % 7 != 0, k.cast("string")).alias("a"), F.when(k % 4 != 0, (k * 2).cast("string")).otherwise(".").alias("b"), "site_name")
    writers.write_csv(t, path, t.columns)
    levels = [["Utility Characteristics", "INDUSTRIAL", ""], ["", "Revenues", ""], ["Utility Number", "Thousand Dollars", "Name"]]
    sheet = readers.read_sheet(spark.read.csv(path, header=True), levels, keys=["utility_number"], numbers=["revenue"], names={"utility_characteristics_utility_number": "utility_number", "industrial_revenues_thousand_dollars": "revenue"})
    return sheet.select(F.col("utility_number").cast("long").alias("utility_number"), "revenue")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 2 = 1")
def parquet_columns(spark, d):
    """A Parquet table of pinned columns, some of them read again."""
    path = folder(spark, "parquet")
    writers.write_parquet(L.table(spark, d, "orders").filter("o_custkey % 2 = 1"), path, ["o_orderkey", "o_custkey", "o_orderstatus"])
    return readers.read_parquet(spark, path, ["o_orderkey", "o_custkey"])


@query("WITH t AS (SELECT month(o_orderdate) AS m, o_orderkey AS k FROM orders), b AS (SELECT m AS band, k FROM t UNION ALL SELECT 0, k FROM t) SELECT CAST(band AS INTEGER) AS band, count(*) AS n, CAST(sum(k) AS BIGINT) AS total FROM b GROUP BY 1")
def month_files(spark, d):
    """A file set by month and one for the year, months told by names; all thirteen must be there."""
    path = folder(spark, "months")
    t = L.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", "MM").alias("m"))
    t.withColumn("name", F.explode(F.array(F.lit("tmean_annual"), F.concat(F.lit("tmean_"), "m")))).drop("m").write.partitionBy("name").parquet(path)
    found = readers.require_bands(readers.read_months(spark, path, "*.parquet", "k bigint"), range(13))
    return found.groupBy("band").agg(F.count("*").alias("n"), F.sum("k").alias("total"))


@query(
    """WITH l AS (SELECT c_custkey % 40 AS ix_id, c_custkey % 97 AS fac_id, CASE WHEN c_custkey % 97 % 3 = 0 THEN ' ' ELSE 'link' || c_custkey % 97 END AS name, CASE WHEN c_custkey % 97 % 5 = 0 THEN 'CA' END AS country FROM customer),
f AS (SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 11 = 0 THEN 95e0 ELSE s_suppkey % 60 * 1e0 END AS lat, s_suppkey % 3 * -1e0 AS lon FROM supplier)
SELECT DISTINCT ix_id, fac_id, CASE WHEN fac_id % 3 = 0 THEN f.name ELSE l.name END AS name, lat, lon FROM l JOIN f ON fac_id = id WHERE coalesce(l.country, 'US') = 'US' AND lat BETWEEN -90 AND 90 AND NOT (lat = 0 AND lon = 0)"""
)
def exchange_links(spark, d):
    """Exchange points through their links to facilities, both as JSON."""
    links, facilities = folder(spark, "links"), folder(spark, "facilities")
    k = F.col("c_custkey") % 97
    L.table(spark, d, "customer").select((F.col("c_custkey") % 40).alias("ix_id"), k.alias("fac_id"), F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("link"), k.cast("string"))).alias("name"), F.lit("x").alias("city"), F.when(k % 5 == 0, "CA").alias("country")).write.json(links)
    s = F.col("s_suppkey")
    L.table(spark, d, "supplier").select(s.alias("id"), F.col("s_name").alias("name"), F.lit("y").alias("city"), F.lit("US").alias("country"), F.when(s % 11 == 0, 95.0).otherwise((s % 60).cast("double")).alias("latitude"), (s % 3 * -1).cast("double").alias("longitude")).write.json(facilities)
    read = lambda path, schema: spark.read.schema(schema).json(path)
    sites = readers.exchange_sites(read(links, "ix_id bigint, fac_id bigint, name string, city string, country string"), read(facilities, "id bigint, name string, city string, country string, latitude double, longitude double"), "US")
    return sites.select("ix_id", "fac_id", "name", "lat", "lon")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS seq, c_custkey * (CASE WHEN c_custkey % 3 = 0 THEN 10 ELSE 1 END) AS value FROM customer")
def result_store(spark, d):
    """Results by key appended as JSON lines in two runs; the later record of a key counts."""
    path = folder(spark, "store")
    t = L.table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    writers.append_results(t.select("id", F.lit(1).alias("seq"), F.col("id").alias("value")), path)
    writers.append_results(t.filter("id % 3 = 0").select("id", F.lit(2).alias("seq"), (F.col("id") * 10).alias("value")), path)
    return readers.read_json_lines(spark, path, "id bigint, seq int, value bigint", "id", "seq")


@query(f"WITH {L.POINTS}, {L.BOXES} SELECT id, CAST(EXISTS (SELECT 1 FROM boxes WHERE code IN (1, 3) AND x > x0 AND x < x1 AND y > y0 AND y < y1) AS INTEGER) AS inside FROM points")
def boundary_points(spark, d):
    """Points inside one boundary dissolved from the polygons of two regions."""
    b = L.boxes(spark, d).withColumn("region", F.col("code").cast("string"))
    whole = readers.dissolved(b, ["absent", "region"], ["1", "3"]).withColumn("name", F.lit(1))
    return spatial.in_polygon(L.points(spark, d), whole, "id", ["name"], 10_000.0).select("id", F.coalesce("name", F.lit(0)).alias("inside"))


@query("SELECT s_nationkey AS nation, count(*) AS n FROM supplier GROUP BY 1")
def chosen_layer(spark, d):
    """The layer whose name holds a part, among those written."""
    root = folder(spark, "layers")
    tables = {"base_nation": L.table(spark, d, "nation").select(F.col("n_nationkey").alias("nation")), "sites_Combined": L.table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"))}
    for name, t in tables.items():
        writers.write_parquet(t, f"{root}/{name}", ["nation"])
    return readers.read_parquet(spark, f"{root}/{readers.choose_layer(sorted(tables))}").groupBy("nation").agg(F.count("*").alias("n"))


@query(f"WITH {L.BOXES}, {L.POINTS}, k AS (SELECT poly_id, count(id) AS n FROM boxes LEFT JOIN points ON x > x0 AND x < x1 AND y > y0 AND y < y1 GROUP BY 1) SELECT poly_id, n, CAST(round(n / 7e0 * 100) AS BIGINT) AS share, 5 AS corners, x0 AS first_x, (SELECT count(*) FROM k) AS features FROM k JOIN boxes USING (poly_id)")
def geojson_written(spark, d):
    """Polygons with their points' numbers as GeoJSON lines with rounded properties, read back with the count."""
    path = folder(spark, "geojson")
    at = spatial.in_polygon(L.points(spark, d), L.boxes(spark, d), "id", ["poly_id"], 10_000.0).filter("poly_id is not null").groupBy("poly_id").agg(F.count("*").alias("n"))
    b = L.boxes(spark, d).join(at, "poly_id", "left").fillna(0, subset=["n"]).withColumn("share", F.col("n") / 7.0)
    written = writers.write_features(b, path, "outer", ["poly_id", "n", "share"], digits=2)
    back = F.from_json("value", "struct<type:string,geometry:struct<coordinates:array<array<array<double>>>>,properties:struct<poly_id:bigint,n:bigint,share:double>>")
    ring = F.col("f.geometry.coordinates")[0]
    lines = spark.read.text(path).select(back.alias("f")).select("f.properties.poly_id", "f.properties.n", F.round(F.col("f.properties.share") * 100).cast("long").alias("share"), F.size(ring).alias("corners"), ring[0][0].alias("first_x"))
    return lines.join(F.broadcast(written), how="inner", on=F.lit(True))  # one row of counts


@query("WITH t AS (SELECT c_custkey AS id, c_custkey * 7 % 100 AS score FROM customer), k AS (SELECT sum(length(CAST(id AS VARCHAR)) + length(CAST(score AS VARCHAR)) + 2) AS bytes FROM t WHERE score >= 2) SELECT id, score FROM t, k WHERE score >= CASE WHEN bytes <= 5000 THEN 2 ELSE 5 END")
def basemap_written(spark, d):
    """The base map under a budget of bytes, read back."""
    path = folder(spark, "basemap")
    t = L.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 7 % 100).alias("score"))
    writers.write_basemap(t, path, ["id", "score"], "score", (2, 5), 5000)
    return spark.read.csv(path, header=True, schema="id bigint, score bigint")


@query("SELECT CAST(c_custkey AS VARCHAR) AS cell_id, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN 'two; three' WHEN c_custkey % 2 = 0 THEN 'two' WHEN c_custkey % 3 = 0 THEN 'three' ELSE '' END AS reasons FROM customer")
def reasons_written(spark, d):
    """Cells with their lists of reasons as JSON lines, read back."""
    path = folder(spark, "reasons")
    k = F.col("c_custkey")
    t = L.table(spark, d, "customer").select(k.cast("string").alias("cell_id"), F.array_compact(F.array(F.when(k % 2 == 0, "two"), F.when(k % 3 == 0, "three"))).alias("reasons"))
    writers.write_reasons(t, path)
    return spark.read.schema("cell_id string, reasons array<string>").json(path).select("cell_id", F.array_join("reasons", "; ").alias("reasons"))


@query(f"WITH {L.POINTS}, {L.BOXES} SELECT id, poly_id, k AS stored FROM points LEFT JOIN boxes ON x > x0 AND x < x1 AND y > y0 AND y < y1 CROSS JOIN (VALUES (1), (2)) v(k)")
def crosswalk_cache(spark, d):
    """A crosswalk that is reused while it has a row for every point, and built anew from fewer."""
    p = L.points(spark, d)
    build = lambda: spatial.in_polygon(p, L.boxes(spark, d), "id", ["poly_id"], 10_000.0)
    stored = materialized(build().withColumn("stored", F.lit(1)))
    again = lambda: build().withColumn("stored", F.lit(2))
    return incremental.reuse_or_build(stored, p, again).unionByName(incremental.reuse_or_build(stored.limit(5), p, again))
