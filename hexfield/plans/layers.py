"""Layers that queries derive from the supplied tables by integer arithmetic, each with its SQL.

Spark and SQL compute the same integers, so results can be compared bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.grid import with_cells

EDGE = 2000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers on a square of 100 km."""
    return table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "cast((c_custkey * 7919) % 100000 AS double) AS x", "cast((c_custkey * 104729) % 100000 AS double) AS y", "c_name AS name", "c_nationkey AS nation", "c_acctbal AS balance", "c_mktsegment AS segment")


POINTS = "points AS (SELECT c_custkey AS id, CAST((c_custkey * 7919) % 100000 AS DOUBLE) AS x, CAST((c_custkey * 104729) % 100000 AS DOUBLE) AS y, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer)"


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers on the same square; `mw` is a whole number of megawatts."""
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS site", "cast((s_suppkey * 6151 + 17) % 100000 AS double) AS sx", "cast((s_suppkey * 35713 + 29) % 100000 AS double) AS sy", "s_name AS site_name", "s_nationkey AS site_nation", "(s_suppkey * 37) % 500 AS mw")


SITES = "sites AS (SELECT s_suppkey AS site, CAST((s_suppkey * 6151 + 17) % 100000 AS DOUBLE) AS sx, CAST((s_suppkey * 35713 + 29) % 100000 AS DOUBLE) AS sy, s_name AS site_name, s_nationkey AS site_nation, (s_suppkey * 37) % 500 AS mw FROM supplier)"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as rectangles on a 5 x 5 lattice, with their ring and rings."""
    df = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS poly_id", "n_name AS poly_name", "n_regionkey AS code", "cast((n_nationkey % 5) * 20000 + 1000 AS double) AS x0", "cast((n_nationkey % 5) * 20000 + 18000 AS double) AS x1", "cast((n_nationkey div 5) * 20000 + 1000 AS double) AS y0", "cast((n_nationkey div 5) * 20000 + 17000 AS double) AS y1")
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"))
    return df.withColumn("outer", ring).withColumn("rings", F.array(ring))


BOXES = "boxes AS (SELECT n_nationkey AS poly_id, n_name AS poly_name, n_regionkey AS code, CAST((n_nationkey % 5) * 20000 + 1000 AS DOUBLE) AS x0, CAST((n_nationkey % 5) * 20000 + 18000 AS DOUBLE) AS x1, CAST((n_nationkey // 5) * 20000 + 1000 AS DOUBLE) AS y0, CAST((n_nationkey // 5) * 20000 + 17000 AS DOUBLE) AS y1 FROM nation)"


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short segment for every order."""
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey AS line_id", "cast((o_orderkey * 7919) % 100000 AS double) AS x1", "cast((o_orderkey * 104729) % 100000 AS double) AS y1", "cast((o_orderkey * 7919) % 100000 + (o_orderkey % 7) * 300 AS double) AS x2", "cast((o_orderkey * 104729) % 100000 + (o_orderkey % 5) * 400 AS double) AS y2", "o_custkey % 4 AS kind")


SEGMENTS = "segments AS (SELECT o_orderkey AS line_id, CAST((o_orderkey * 7919) % 100000 AS DOUBLE) AS x1, CAST((o_orderkey * 104729) % 100000 AS DOUBLE) AS y1, CAST((o_orderkey * 7919) % 100000 + (o_orderkey % 7) * 300 AS DOUBLE) AS x2, CAST((o_orderkey * 104729) % 100000 + (o_orderkey % 5) * 400 AS DOUBLE) AS y2, o_custkey % 4 AS kind FROM orders)"


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster of 300 x 300 from line items: the mean quantity in whole hundredths, with a class."""
    q = table(spark, sf_dir, "lineitem").selectExpr("cast(l_orderkey % 300 AS int) AS row", "cast(l_partkey % 300 AS int) AS col", "cast(l_quantity AS bigint) AS q")
    v = q.groupBy("row", "col").agg((F.sum("q") * 100).alias("s"), F.count("*").alias("n")).selectExpr("row", "col", "s div n AS value")
    return v.selectExpr("row", "col", "value", "element_at(array(11, 21, 22, 23, 24, 31, 41, 42, 43, 52, 71, 81, 82, 90, 95, 12), cast(value % 16 AS int) + 1) AS class", "cast(row div 30 * 10 + col div 30 AS int) AS zone")


PIXELS = "pixels AS (SELECT row, col, v AS value, list_extract([11, 21, 22, 23, 24, 31, 41, 42, 43, 52, 71, 81, 82, 90, 95, 12], CAST(v % 16 AS INTEGER) + 1) AS class, CAST(row // 30 * 10 + col // 30 AS INTEGER) AS zone FROM (SELECT CAST(l_orderkey % 300 AS INTEGER) AS row, CAST(l_partkey % 300 AS INTEGER) AS col, CAST((sum(CAST(l_quantity AS BIGINT)) * 100) // count(*) AS BIGINT) AS v FROM lineitem GROUP BY 1, 2))"


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as facilities that lie close together in fours, some attributes null."""
    df = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "cast(((c_custkey div 4) * 7919) % 100000 + (c_custkey % 4) * 120 AS double) AS x", "cast(((c_custkey div 4) * 104729) % 100000 + (c_custkey % 3) * 40 AS double) AS y",
        "c_mktsegment AS name", "CASE WHEN c_nationkey % 5 = 4 THEN NULL ELSE element_at(array('Google LLC', 'Acme', 'AWS East', 'Local'), cast(c_nationkey % 5 AS int) + 1) END AS operator",
        "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE cast((c_custkey * 31) % 1000 AS bigint) END AS sqft", "element_at(array('campus', 'building', 'point'), cast(c_custkey % 3 AS int) + 1) AS type",
        "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE element_at(array('NJ', 'CO', 'WA', 'TX'), cast(c_custkey % 4 AS int) + 1) END AS state_abb",
    )
    return with_cells(df, EDGE)


FACILITIES = """fac AS (SELECT c_custkey AS id, CAST(((c_custkey // 4) * 7919) % 100000 + (c_custkey % 4) * 120 AS DOUBLE) AS x, CAST(((c_custkey // 4) * 104729) % 100000 + (c_custkey % 3) * 40 AS DOUBLE) AS y,
  c_mktsegment AS name, CASE WHEN c_nationkey % 5 = 4 THEN NULL ELSE list_extract(['Google LLC', 'Acme', 'AWS East', 'Local'], CAST(c_nationkey % 5 AS INTEGER) + 1) END AS operator,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST((c_custkey * 31) % 1000 AS BIGINT) END AS sqft, list_extract(['campus', 'building', 'point'], CAST(c_custkey % 3 AS INTEGER) + 1) AS type,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE list_extract(['NJ', 'CO', 'WA', 'TX'], CAST(c_custkey % 4 AS INTEGER) + 1) END AS state_abb FROM customer)"""


def cells_sql(source: str, name: str, columns: str = "*", edge: float = EDGE) -> str:
    """CTEs that add q, r and cell_id to a source with x and y."""
    return f"""{name}_a AS (SELECT {columns}, (5.773502691896257e-1 * x - y / 3) / {edge}e0 AS fq, (y * 2 / 3) / {edge}e0 AS fr FROM {source}),
{name}_b AS (SELECT *, -fq - fr AS fs, floor(fq + 0.5e0) AS rq, floor(fr + 0.5e0) AS rr, floor(-fq - fr + 0.5e0) AS rs FROM {name}_a),
{name}_c AS (SELECT *, abs(rq - fq) > abs(rr - fr) AND abs(rq - fq) > abs(rs - fs) AS q_off, abs(rr - fr) > abs(rs - fs) AS r_big FROM {name}_b),
{name} AS (SELECT * EXCLUDE (fq, fr, fs, rq, rr, rs, q_off, r_big), CAST(CASE WHEN q_off THEN -rr - rs ELSE rq END AS BIGINT) AS q, CAST(CASE WHEN NOT q_off AND r_big THEN -rq - rs ELSE rr END AS BIGINT) AS r,
  'h_' || CAST(CASE WHEN q_off THEN -rr - rs ELSE rq END AS BIGINT) || '_' || CAST(CASE WHEN NOT q_off AND r_big THEN -rq - rs ELSE rr END AS BIGINT) AS cell_id FROM {name}_c)"""
