"""Queries over relational and raster operators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import raster, tables
from ..operators.dedupe import first_of_each
from ..streaming import incremental
from . import layers as L

Q: dict = {}


def query(sql: str | None):
    def add(f):
        Q[f.__name__] = (f, sql)
        return f

    return add


def milli(c):
    """Thousandths, rounded half up."""
    return F.floor(c * 1000 + 0.5).cast("long")


FAC = f"{L.FACILITIES}, {L.cells_sql('fac', 'fc')}"
LABELS = f"""{FAC}, mode_ AS (SELECT cell_id, state_abb, row_number() OVER (PARTITION BY cell_id ORDER BY count(*) DESC, state_abb) AS k FROM fc WHERE state_abb IS NOT NULL GROUP BY 1, 2),
lab AS (SELECT cell_id, 1 AS has_dc, count(*) AS facility_count, max(sqft) AS max_sqft, sum(sqft) AS total_sqft,
  max(CASE WHEN regexp_matches(lower(trim(operator)), 'google|amazon|microsoft|meta|apple|aws|facebook') THEN 1 ELSE 0 END) AS has_hyperscaler,
  CASE max(CASE type WHEN 'campus' THEN 2 WHEN 'building' THEN 1 ELSE 0 END) WHEN 2 THEN 'campus' WHEN 1 THEN 'building' ELSE 'point' END AS dominant_type,
  coalesce(string_agg(DISTINCT operator, ', ' ORDER BY operator), '') AS operators FROM fc GROUP BY 1)"""


def labels(spark, d):
    return tables.cell_labels(L.facilities(spark, d))


@query(f"WITH {LABELS} SELECT l.cell_id, has_dc, facility_count, coalesce(max_sqft, -1) AS max_sqft, CAST(coalesce(total_sqft, -1) AS BIGINT) AS total_sqft, has_hyperscaler, dominant_type, operators, m.state_abb FROM lab l LEFT JOIN mode_ m ON l.cell_id = m.cell_id AND m.k = 1")
def cell_labels(spark, d):
    """One row per cell with facilities."""
    return labels(spark, d).fillna(-1, subset=["max_sqft", "total_sqft"])


@query(f"WITH {LABELS} SELECT 'unique_key' AS name, count(*) = count(DISTINCT cell_id) AS passed FROM lab UNION ALL SELECT 'all_flagged', min(has_dc) = 1 FROM lab UNION ALL SELECT 'counts_positive', min(facility_count) >= 1 FROM lab")
def label_checks(spark, d):
    """Sanity of the labels."""
    return tables.label_checks(labels(spark, d))


OPQ = "op AS (SELECT s_nationkey AS state, sum((s_suppkey * 37) % 500) AS operating FROM supplier WHERE s_nationkey % 3 <> 0 GROUP BY 1), qu AS (SELECT c_nationkey AS state, sum(c_custkey % 90) AS queued FROM customer WHERE c_nationkey % 4 <> 1 GROUP BY 1)"


@query(f"WITH {OPQ} SELECT coalesce(op.state, qu.state) AS state, CAST(coalesce(operating, 0) AS BIGINT) AS operating, CAST(coalesce(queued, 0) AS BIGINT) AS queued, CAST(floor(coalesce(queued, 0) / greatest(coalesce(operating, 0), 1e0) * 1000 + 0.5e0) AS BIGINT) AS ratio FROM op FULL JOIN qu ON op.state = qu.state")
def outer_zero_fill(spark, d):
    """Operating against queued by state; what a side lacks is 0, ratios have a floor."""
    op = L.table(spark, d, "supplier").filter("s_nationkey % 3 <> 0").groupBy(F.col("s_nationkey").alias("state")).agg(F.sum(F.expr("(s_suppkey * 37) % 500")).alias("operating"))
    qu = L.table(spark, d, "customer").filter("c_nationkey % 4 <> 1").groupBy(F.col("c_nationkey").alias("state")).agg(F.sum(F.expr("c_custkey % 90")).alias("queued"))
    return tables.outer_with_zeros(op, qu, ["state"], ["operating", "queued"]).withColumn("ratio", milli(tables.floored_ratio(F.col("queued").cast("double"), F.col("operating").cast("double"))))


@query("SELECT o_custkey, o_orderpriority, n FROM (SELECT o_custkey, o_orderpriority, count(*) AS n, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS k FROM orders GROUP BY 1, 2) WHERE k = 1")
def mode_lookup(spark, d):
    """The most common priority of each customer."""
    return tables.most_common(L.table(spark, d, "orders"), ["o_custkey"], ["o_orderpriority"])


@query("SELECT l_suppkey, l_shipmode_, CAST(total AS BIGINT) AS total FROM (SELECT l_suppkey, l_returnflag AS l_shipmode_, sum(CAST(l_quantity AS BIGINT)) AS total, row_number() OVER (PARTITION BY l_suppkey ORDER BY sum(CAST(l_quantity AS BIGINT)) DESC, l_returnflag) AS k FROM lineitem GROUP BY 1, 2) WHERE k = 1")
def dominant_by_sum(spark, d):
    """The flag with the greatest volume of each supplier."""
    t = L.table(spark, d, "lineitem").select("l_suppkey", F.col("l_returnflag").alias("l_shipmode_"), F.col("l_quantity").cast("long").alias("q"))
    return tables.greatest_sum(t, ["l_suppkey"], "l_shipmode_", "q")


@query(
    """WITH tot AS (SELECT s_suppkey AS u, CAST(s_suppkey % 50 * 1000 AS DOUBLE) AS revenue, CAST(s_suppkey % 20 * 100 AS DOUBLE) AS volume FROM supplier),
mem AS (SELECT DISTINCT l_suppkey AS u, l_partkey % 40 AS place FROM lineitem), sz AS (SELECT u, count(*) AS places FROM mem GROUP BY 1),
e AS (SELECT place, sum(revenue / places) AS revenue, sum(volume / places) AS volume, count(DISTINCT mem.u) AS members FROM mem JOIN sz ON mem.u = sz.u JOIN tot ON mem.u = tot.u WHERE volume >= 1000 GROUP BY 1)
SELECT place, members, CAST(floor(revenue / greatest(volume, 1e-6) * 1000 + 0.5e0) AS BIGINT) AS price FROM e"""
)
def equal_share_alloc(spark, d):
    """Suppliers' totals dealt evenly over their places, and the places' prices."""
    tot = L.table(spark, d, "supplier").selectExpr("s_suppkey AS u", "cast(s_suppkey % 50 * 1000 AS double) AS revenue", "cast(s_suppkey % 20 * 100 AS double) AS volume")
    mem = L.table(spark, d, "lineitem").selectExpr("l_suppkey AS u", "l_partkey % 40 AS place")
    return tables.equal_shares(tot, mem, "u", "place", "revenue", "volume", 1000.0).select("place", "members", milli(F.col("price")).alias("price"))


MIX = "mix AS (SELECT l_suppkey AS id, sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) END) AS a, sum(CASE WHEN l_returnflag = 'N' AND l_suppkey % 5 > 0 THEN CAST(l_quantity AS BIGINT) END) AS n, sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) END) AS r FROM lineitem GROUP BY 1)"


@query(f"WITH {MIX} SELECT id, CAST(floor(100e0 * (coalesce(a, 0) + coalesce(n, 0)) / (coalesce(a, 0) + coalesce(n, 0) + coalesce(r, 0)) * 1000 + 0.5e0) AS BIGINT) AS pct FROM mix WHERE coalesce(a, 0) + coalesce(n, 0) + coalesce(r, 0) > 0")
def row_percent_mix(spark, d):
    """Percent of two columns in three, nulls as 0."""
    q = F.col("l_quantity").cast("long")
    flag = F.col("l_returnflag")
    mix = L.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.sum(F.when(flag == "A", q)).cast("double").alias("a"), F.sum(F.when((flag == "N") & (F.col("l_suppkey") % 5 > 0), q)).cast("double").alias("n"), F.sum(F.when(flag == "R", q)).cast("double").alias("r"))
    return mix.select("id", milli(tables.row_percent(["a", "n"], ["a", "n", "r"])).alias("pct")).filter("pct is not null")


HAZ = "c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE cast(c_custkey % 97 AS double) END AS c_score, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE cast(c_custkey % 89 AS double) END AS i_score, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE cast(c_custkey AS double) END AS c_loss, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE cast(c_custkey * 2 AS double) END AS i_loss, 'C' || c_custkey % 4 AS c_rating, 'I' || c_custkey % 3 AS i_rating"


@query(f"WITH t AS (SELECT {HAZ} FROM customer) SELECT id, coalesce(greatest(c_score, i_score), -1) AS flood_score, CASE WHEN c_loss IS NOT NULL OR i_loss IS NOT NULL THEN coalesce(c_loss, 0) + coalesce(i_loss, 0) ELSE -1 END AS flood_loss, CASE WHEN coalesce(c_score, -1) >= coalesce(i_score, -1) THEN c_rating ELSE i_rating END AS flood_rating FROM t")
def hazard_merge(spark, d):
    """Two flood hazards as one."""
    t = L.table(spark, d, "customer").selectExpr(*(x.strip() for x in HAZ.replace(", CASE", "\nCASE").replace(", 'C'", "\n'C'").replace(", 'I'", "\n'I'").split("\n")))
    return t.select("id", *tables.merged_hazard("c", "i")).fillna(-1, subset=["flood_score", "flood_loss"])


@query("SELECT seg, count(*) AS n, CAST(floor(count(*) * 1e0 / (SELECT count(*) FROM customer) * 1000 + 0.5e0) AS BIGINT) AS share FROM (SELECT CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer) GROUP BY 1")
def value_shares(spark, d):
    """Values with their shares, null among them."""
    t = L.table(spark, d, "customer").selectExpr("CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS seg")
    return tables.value_shares(t, "seg").withColumn("share", milli(F.col("share")))


@query("WITH t AS (SELECT CAST(l_quantity AS DOUBLE) AS v FROM lineitem) SELECT count(v) AS n, count(DISTINCT v) AS n_distinct, min(v) AS least, CAST(floor(avg(v) * 1000 + 0.5e0) AS BIGINT) AS mean, max(v) AS most, CAST(floor(quantile_cont(v, 0.25) * 1000 + 0.5e0) AS BIGINT) AS p25, CAST(floor(quantile_cont(v, 0.5) * 1000 + 0.5e0) AS BIGINT) AS p50, CAST(floor(quantile_cont(v, 0.75) * 1000 + 0.5e0) AS BIGINT) AS p75, CAST(floor(quantile_cont(v, 0.9) * 1000 + 0.5e0) AS BIGINT) AS p90, CAST(floor(quantile_cont(v, 0.95) * 1000 + 0.5e0) AS BIGINT) AS p95, CAST(floor(quantile_cont(v, 0.99) * 1000 + 0.5e0) AS BIGINT) AS p99 FROM t")
def describe_exact(spark, d):
    """Exact description of a measure."""
    t = L.table(spark, d, "lineitem").select(F.col("l_quantity").cast("double").alias("v"))
    out = tables.described(t, "v")
    return out.select("n", "n_distinct", "least", milli(F.col("mean")).alias("mean"), "most", *(milli(F.col(c)).alias(c) for c in ("p25", "p50", "p75", "p90", "p95", "p99")))


@query(
    """WITH t AS (SELECT CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS a, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS b, p_type AS c FROM part), n AS (SELECT count(*) AS k FROM t)
SELECT 'a' AS "column", 'size' AS "group", 1 AS present, k - (SELECT count(a) FROM t) AS nulls FROM n UNION ALL SELECT 'b', 'text', 1, k - (SELECT count(b) FROM t) FROM n UNION ALL SELECT 'c', 'text', 1, k - (SELECT count(c) FROM t) FROM n UNION ALL SELECT 'gone', 'text', 0, k FROM n"""
)
def coverage_report(spark, d):
    """Nulls by column, a missing one among them."""
    t = L.table(spark, d, "part").selectExpr("CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS a", "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS b", "p_type AS c")
    return tables.null_rates(t, ["a", "b", "c", "gone"], {"a": "size", "b": "text", "c": "text", "gone": "text"}).drop("rate")


@query("WITH t AS (SELECT CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS a, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS b, p_type AS c FROM part) SELECT 'size' AS \"group\", 1 AS columns, CAST(1 AS BIGINT) AS present, CAST(floor(count(a) * 1e0 / count(*) * 1000 + 0.5e0) AS BIGINT) AS coverage FROM t UNION ALL SELECT 'text', 3, 2, CAST(floor((count(b) + count(c)) * 1e0 / (3 * count(*)) * 1000 + 0.5e0) AS BIGINT) FROM t")
def coverage_groups(spark, d):
    """Coverage by group of columns."""
    t = L.table(spark, d, "part").selectExpr("CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS a", "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS b", "p_type AS c")
    return tables.group_coverage(tables.null_rates(t, ["a", "b", "c", "gone"], {"a": "size", "b": "text", "c": "text", "gone": "text"})).withColumn("coverage", milli(F.col("coverage"))).withColumn("columns", F.col("columns").cast("int"))


@query("SELECT o_custkey, CAST(floor(avg(CAST(floor(o_totalprice) AS BIGINT)) + 0.5e0) AS BIGINT) AS mean, count(*) AS rows FROM orders GROUP BY 1 ORDER BY avg(CAST(floor(o_totalprice) AS BIGINT)) DESC, o_custkey LIMIT 10")
def top_groups_mean(spark, d):
    """The ten customers with the greatest mean order."""
    t = L.table(spark, d, "orders").select("o_custkey", F.floor("o_totalprice").cast("long").alias("v"))
    return tables.top_groups(t, "o_custkey", "v", 10).withColumn("mean", F.floor(F.col("mean") + 0.5).cast("long"))


@query("SELECT c_custkey, CAST(c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS INTEGER) AS has_closed FROM customer")
def semi_flag(spark, d):
    """Whether a customer has a closed order."""
    o = L.table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return tables.flag_in(L.table(spark, d, "customer").select("c_custkey"), o, "c_custkey", "has_closed")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 3)")
def anti_pending(spark, d):
    """Orders without a third line."""
    done = L.table(spark, d, "lineitem").filter("l_linenumber = 3").select(F.col("l_orderkey").alias("o_orderkey"))
    return tables.pending(L.table(spark, d, "orders").select("o_orderkey"), done, "o_orderkey")


@query("SELECT l_orderkey AS id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1")
def resume_pending(spark, d):
    """Totals of all orders: those of a third are there, the others are added."""
    items = L.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_quantity").cast("long").alias("q"))
    work = lambda keys: items.join(keys, "id", "left_semi").groupBy("id").agg(F.sum("q").alias("total"))
    keys = items.select("id").distinct()
    return incremental.resume(keys, work(keys.filter("id % 3 = 0")), "id", work)


@query("SELECT count(*) AS rows, count(v) AS matched, min(v) AS least, median(v) AS median, CAST(floor(avg(v) * 1000 + 0.5e0) AS BIGINT) AS mean, max(v) AS most, CAST(sum(big) AS BIGINT) AS n_big, CAST(floor(100e0 * avg(big) * 1000 + 0.5e0) AS BIGINT) AS pct_big FROM (SELECT CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS v, CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS big FROM part)")
def job_summary(spark, d):
    """A job's summary row."""
    t = L.table(spark, d, "part").selectExpr("CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE cast(p_size AS double) END AS v", "CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS big")
    return tables.summary(t, "v", ["big"]).withColumn("mean", milli(F.col("mean"))).withColumn("pct_big", milli(F.col("pct_big")))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem) WHERE k = 1")
def rank1_dedupe(spark, d):
    """The largest line of each order."""
    return first_of_each(L.table(spark, d, "lineitem"), ["l_orderkey"], [F.desc("l_quantity"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("WITH t AS (SELECT p_brand AS feature, sum(p_size) AS v FROM part GROUP BY 1), w AS (SELECT feature, v * 1e0 / sum(v) OVER () AS share, sum(v) OVER (ORDER BY v DESC, feature) * 1e0 / sum(v) OVER () AS running FROM t) SELECT feature, CAST(floor(share * 1000000 + 0.5e0) AS BIGINT) AS share, CAST(floor(running * 1000000 + 0.5e0) AS BIGINT) AS running FROM w")
def cumulative_share(spark, d):
    """Shares and running shares of brands."""
    t = L.table(spark, d, "part").groupBy(F.col("p_brand").alias("feature")).agg(F.sum("p_size").alias("v"))
    out = tables.cumulative_share(t, "v", [F.desc("v"), F.col("feature")])
    return out.select("feature", *(F.floor(F.col(c) * 1000000 + 0.5).cast("long").alias(c) for c in ("share", "running")))


@query("WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') SELECT 'union' AS op, count(*) AS n FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'difference', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'intersection', count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)")
def set_ops(spark, d):
    """Sizes of set operations over customers."""
    o = L.table(spark, d, "orders")
    a, b = (o.filter(F.col("o_orderstatus") == s).select("o_custkey") for s in "OF")
    parts = {"union": a.union(b).distinct(), "difference": a.subtract(b), "intersection": a.intersect(b)}
    frames = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("op"), "n") for k, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(f"WITH {FAC} SELECT 0 AS step, 'loaded' AS name, count(*) AS rows FROM fac UNION ALL SELECT 1, 'sized', count(sqft) FROM fac UNION ALL SELECT 2, 'named', count(*) FROM fac WHERE sqft IS NOT NULL AND operator IS NOT NULL")
def row_lineage(spark, d):
    """Rows left after each step."""
    f = L.facilities(spark, d)
    sized = f.filter("sqft is not null")
    return tables.lineage([("loaded", f), ("sized", sized), ("named", sized.filter("operator is not null"))])


@query(f"WITH {LABELS}, {L.POINTS}, {L.cells_sql('points', 'cells')}, spine AS (SELECT cell_id, count(*) AS points FROM cells GROUP BY 1), f1 AS (SELECT cell_id, max(nation) AS nation FROM cells WHERE balance > 0 GROUP BY 1) SELECT s.cell_id, s.points, coalesce(f1.nation, -1) AS nation, coalesce(l.has_dc, 0) AS has_dc, coalesce(l.facility_count, 0) AS facility_count FROM spine s LEFT JOIN f1 ON s.cell_id = f1.cell_id LEFT JOIN lab l ON s.cell_id = l.cell_id")
def assemble_master(spark, d):
    """Features and labels joined to the cells."""
    from ..operators.grid import with_cells

    cells = with_cells(L.points(spark, d), L.EDGE)
    spine = cells.groupBy("cell_id").agg(F.count("*").alias("points"))
    f1 = cells.filter("balance > 0").groupBy("cell_id").agg(F.max("nation").alias("nation"), F.lit(0).alias("points"))
    lab = labels(spark, d).select("cell_id", "has_dc", "facility_count")
    return tables.wide_join(spine, [f1, lab], "cell_id").fillna(-1, subset=["nation"]).fillna(0, subset=["has_dc", "facility_count"])


ZONES = "zones AS (SELECT unnest(range(0, 110)) AS zone)"


def zones(spark):
    return spark.range(110).select(F.col("id").cast("int").alias("zone"))


@query(
    f"""WITH {L.PIXELS}, {ZONES}, k AS (SELECT zone, class, count(*) AS n FROM pixels GROUP BY 1, 2), t AS (SELECT zone, sum(n) AS total, sum(CASE WHEN class IN (21, 22, 23, 24) THEN n ELSE 0 END) AS dev, sum(CASE WHEN class IN (41, 42, 43) THEN n ELSE 0 END) AS forest FROM k GROUP BY 1),
m AS (SELECT zone, class, row_number() OVER (PARTITION BY zone ORDER BY n DESC, class) AS rn FROM k)
SELECT CAST(z.zone AS INTEGER) AS zone, CAST(coalesce(total, 0) AS BIGINT) AS total_pixels, coalesce(m.class, -1) AS dominant_class, coalesce(CAST(floor(dev * 1e0 / total * 1000 + 0.5e0) AS BIGINT), -1) AS pct_developed, coalesce(CAST(floor(forest * 1e0 / total * 1000 + 0.5e0) AS BIGINT), -1) AS pct_forest FROM zones z LEFT JOIN t ON z.zone = t.zone LEFT JOIN m ON z.zone = m.zone AND rn = 1"""
)
def zonal_classes(spark, d):
    """Land-cover shares by zone."""
    out = raster.zonal_classes(zones(spark), L.pixels(spark, d), "zone")
    return out.select("zone", "total_pixels", F.coalesce("dominant_class", F.lit(-1)).alias("dominant_class"), *(F.coalesce(milli(F.col(c)), F.lit(-1)).alias(c) for c in ("pct_developed", "pct_forest")))


@query(f"WITH {L.PIXELS}, {ZONES}, s AS (SELECT zone, avg(value) AS m, max(value) AS x, count(*) AS n, avg(CASE WHEN value >= 2500 THEN 1e0 ELSE 0e0 END) AS f FROM pixels GROUP BY 1) SELECT CAST(z.zone AS INTEGER) AS zone, coalesce(CAST(floor(m * 1000 + 0.5e0) AS BIGINT), -1) AS mean, coalesce(x, -1) AS most, coalesce(n, 0) AS pixels, coalesce(CAST(floor(f * 1000 + 0.5e0) AS BIGINT), -1) AS half FROM zones z LEFT JOIN s ON z.zone = s.zone")
def zonal_stats(spark, d):
    """Mean, greatest and share of high values by zone."""
    out = raster.zonal_stats(zones(spark), L.pixels(spark, d), "zone", more=[F.avg(F.when(F.col("value") >= 2500, 1.0).otherwise(0.0)).alias("half")])
    return out.select("zone", F.coalesce(milli(F.col("mean")), F.lit(-1)).alias("mean"), F.coalesce("most", F.lit(-1)).alias("most"), "pixels", F.coalesce(milli(F.col("half")), F.lit(-1)).alias("half"))


@query(f"WITH {L.PIXELS} SELECT zone, CAST(floor(stddev_pop(value) * 10 + 0.5e0) AS BIGINT) AS tenths FROM pixels GROUP BY 1")
def zonal_std(spark, d):
    """Population deviation by zone."""
    out = raster.zonal_stats(zones(spark), L.pixels(spark, d), "zone").filter("pixels > 0")
    return out.select("zone", F.floor(F.col("deviation") * 10 + 0.5).cast("long").alias("tenths"))


SAMPLES = "samples AS (SELECT c_custkey AS id, CAST((c_custkey * 13) % 310 AS INTEGER) AS row, CAST((c_custkey * 29) % 310 AS INTEGER) AS col FROM customer)"


def samples(spark, d):
    return L.table(spark, d, "customer").selectExpr("c_custkey AS id", "cast((c_custkey * 13) % 310 AS int) AS row", "cast((c_custkey * 29) % 310 AS int) AS col")


@query(f"WITH {L.PIXELS}, {SAMPLES} SELECT id, coalesce(p.value, -1) AS value FROM samples s LEFT JOIN pixels p ON s.row = p.row AND s.col = p.col")
def point_sample(spark, d):
    """The pixel under each sample; outside and missing as -1."""
    return raster.sample_points(samples(spark, d), L.pixels(spark, d), "id").fillna(-1)


@query(f"WITH {L.PIXELS}, {SAMPLES} SELECT s.id, CAST(coalesce(sum(p.value), 0) AS BIGINT) AS total FROM samples s LEFT JOIN pixels p ON p.row BETWEEN s.row - 5 AND s.row + 5 AND (p.row - s.row) * (p.row - s.row) + (p.col - s.col) * (p.col - s.col) <= 25 GROUP BY 1")
def focal_disk_sum(spark, d):
    """Sum within five pixels of each sample."""
    return raster.focal_disk_sum(samples(spark, d), L.pixels(spark, d), "id", 5, 300).select("id", F.col("total").cast("long").alias("total"))


@query(f"WITH {L.PIXELS} SELECT CAST((col * 90 + 45) // 1000 AS BIGINT) AS gx, CAST((row * 90 + 45) // 1000 AS BIGINT) AS gy, CAST(floor(avg(value) * 1000 + 0.5e0) AS BIGINT) AS value, count(*) AS pixels FROM pixels GROUP BY 1, 2")
def regrid_mean(spark, d):
    """Pixels of 90 m averaged to a grid of 1 km."""
    out = raster.regridded(L.pixels(spark, d), F.col("col") * 90 + 45.0, F.col("row") * 90 + 45.0, 1000.0)
    return out.withColumn("value", milli(F.col("value")))


@query(f"WITH {L.PIXELS} SELECT row, col, CASE WHEN value % 5 = 0 THEN -1 ELSE value * 3 END AS count FROM pixels")
def density_count(spark, d):
    """Density times area, without a valid density none."""
    p = L.pixels(spark, d).withColumn("density", F.when(F.col("value") % 5 == 0, -1).otherwise(F.col("value")))
    return p.select("row", "col", F.coalesce(raster.density_count(F.col("density"), 3), F.lit(-1)).alias("count"))


@query(f"WITH {L.PIXELS}, s AS (SELECT zone, sum(CASE WHEN class IN (90, 95) THEN 1 ELSE 0 END) * 4e0 / count(*) AS f FROM pixels GROUP BY 1) SELECT zone, CASE WHEN f > 0 THEN 1 ELSE 0 END AS cover_0, CASE WHEN f >= 0.25 THEN 1 ELSE 0 END AS cover_25, CASE WHEN f >= 0.5 THEN 1 ELSE 0 END AS cover_50 FROM s")
def wetland_tiers(spark, d):
    """Tiers of (quadrupled) wetland cover by zone."""
    s = L.pixels(spark, d).groupBy("zone").agg((F.sum(F.when(F.col("class").isin(90, 95), 1).otherwise(0)) * 4.0 / F.count("*")).alias("f"))
    return s.select("zone", *raster.cover_tiers(F.col("f")))


@query(f"WITH {L.PIXELS}, k AS (SELECT zone, class, count(*) AS n FROM pixels GROUP BY 1, 2), m AS (SELECT zone, class, row_number() OVER (PARTITION BY zone ORDER BY n DESC, class) AS rn FROM k) SELECT k.zone, CAST(sum(n) AS BIGINT) AS total_pixels, count(*) AS classes, max(m.class) AS dominant_class FROM k JOIN m ON k.zone = m.zone AND m.rn = 1 GROUP BY 1")
def stats_cache(spark, d):
    """Features finished from partial counts of two halves of the raster."""
    p = L.pixels(spark, d)
    halves = [incremental.partial_counts(p.filter(c), "zone") for c in ("row % 2 = 0", "row % 2 = 1")]
    return incremental.finished_counts(halves[0].unionByName(halves[1]), "zone")


@query("WITH a AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer), b AS (SELECT o_custkey AS id, min(o_orderpriority) AS seg FROM orders GROUP BY 1) SELECT a.id, coalesce(a.seg, b.seg) AS seg FROM a LEFT JOIN b ON a.id = b.id")
def coalesce_join(spark, d):
    """Nulls filled from another table."""
    a = L.table(spark, d, "customer").selectExpr("c_custkey AS id", "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_mktsegment END AS seg")
    b = L.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderpriority").alias("seg"))
    return tables.coalesced(a, b, ["id"], ["seg"])


@query("SELECT count(*) AS rows, count(*) BETWEEN 100 AND 100000 AS passed FROM customer")
def row_band(spark, d):
    """Whether a table has a plausible number of rows."""
    return tables.row_band(L.table(spark, d, "customer"), 100, 100000)


@query(
    """WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey * 2e0 END AS balance, c_mktsegment FROM customer)
SELECT 'c_custkey' AS column_name, count(*) - count(c_custkey) AS nulls, min(c_custkey) * 1e0 AS least, max(c_custkey) * 1e0 AS most FROM t UNION ALL SELECT 'balance', count(*) - count(balance), min(balance), max(balance) FROM t UNION ALL SELECT 'c_mktsegment', count(*) - count(c_mktsegment), NULL, NULL FROM t"""
)
def inspect_columns(spark, d):
    """Nulls of each column once a sentinel is masked, and the range of the numeric ones."""
    t = L.table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, -9999.0).otherwise(F.col("c_custkey") * 2.0).alias("balance"), "c_mktsegment")
    return tables.inspect(t, [-9999]).select("column_name", "nulls", "least", "most")


@query("SELECT CAST(c_custkey AS VARCHAR) AS cell_id FROM customer ORDER BY 1 LIMIT 100")
def prefix_cells(spark, d):
    """The hundred cells of least id, on which a job is tried."""
    return tables.prefix_sample(L.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("cell_id")), 100)
