"""Queries over the cleaning rules, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean
from ..operators import tables
from . import layers as L

Q: dict = {}


def query(sql: str):
    def add(f):
        Q[f.__name__] = (f, sql)
        return f

    return add


NAMES_SQL = "names AS (SELECT p_partkey AS id, CASE p_partkey % 8 WHEN 0 THEN ' ' || p_brand || ' County ' WHEN 1 THEN p_brand || ' Parish' WHEN 2 THEN 'Carson City' WHEN 3 THEN p_brand || ' City and Borough' WHEN 4 THEN p_brand || ' Census Area' WHEN 5 THEN ' ' WHEN 6 THEN NULL ELSE p_brand || ' Borough' END AS name FROM part)"


def names(spark, d):
    """Part brands dressed as county names."""
    return L.table(spark, d, "part").selectExpr("p_partkey AS id", "CASE p_partkey % 8 WHEN 0 THEN ' ' || p_brand || ' County ' WHEN 1 THEN p_brand || ' Parish' WHEN 2 THEN 'Carson City' WHEN 3 THEN p_brand || ' City and Borough' WHEN 4 THEN p_brand || ' Census Area' WHEN 5 THEN ' ' WHEN 6 THEN NULL ELSE p_brand || ' Borough' END AS name")


def _chain_sql(endings: list[str]) -> str:
    steps, last = [], "s0 AS (SELECT id, lower(trim(name)) AS name FROM names)"
    steps.append(last)
    for i, e in enumerate(endings):
        steps.append(f"s{i + 1} AS (SELECT id, CASE WHEN ends_with(name, '{e}') THEN substring(name, 1, length(name) - {len(e)}) ELSE name END AS name FROM s{i})")
    return ", ".join(steps)


@query(f"WITH {NAMES_SQL}, {_chain_sql(clean.COUNTY_ENDINGS)} SELECT id, nullif(trim(name), '') AS norm FROM s{len(clean.COUNTY_ENDINGS)}")
def normalize_names(spark, d):
    """County names without their endings, taken off in order."""
    return names(spark, d).select("id", clean.strip_endings(F.col("name")).alias("norm"))


@query(f"WITH {NAMES_SQL}, {_chain_sql(clean.COUNTY_ENDINGS_KEEP_CITY)} SELECT id, nullif(trim(name), '') AS norm FROM s{len(clean.COUNTY_ENDINGS_KEEP_CITY)}")
def normalize_names_keep_city(spark, d):
    """The same with independent cities kept."""
    return names(spark, d).select("id", clean.strip_endings(F.col("name"), clean.COUNTY_ENDINGS_KEEP_CITY).alias("norm"))


@query(
    """WITH places AS (SELECT s_suppkey AS id, s_nationkey AS k, CASE s_suppkey % 3 WHEN 0 THEN s_name || ' city' WHEN 1 THEN s_name || ' (East) Town' ELSE s_name || ' (West City)' END AS place FROM supplier),
n AS (SELECT id, k, place, trim(regexp_replace(trim(split_part(place, '(', 1)), '(?i) +(city|town)$', '')) AS norm FROM places),
w AS (SELECT s_name AS wanted FROM supplier WHERE s_nationkey % 2 = 0)
SELECT id, norm, CAST(norm IN (SELECT wanted FROM w) AS INTEGER) AS hit FROM n"""
)
def place_match(spark, d):
    """Normalised place names, and whether they are on a list."""
    s = L.table(spark, d, "supplier")
    places = s.selectExpr("s_suppkey AS id", "CASE s_suppkey % 3 WHEN 0 THEN s_name || ' city' WHEN 1 THEN s_name || ' (East) Town' ELSE s_name || ' (West City)' END AS place").select("id", clean.place_name(F.col("place")).alias("norm"))
    wanted = s.filter("s_nationkey % 2 = 0").select(F.col("s_name").alias("norm"))
    return tables.flag_in(places, wanted, "norm", "hit").select("id", "norm", "hit")


@query("WITH t AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN 'none' ELSE p_size || ' %ile (' || p_partkey || '.5 ug)' END AS txt FROM part) SELECT id, CAST(floor(CAST(nullif(regexp_extract(txt, '([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE) * 10) AS DOUBLE) AS tenths FROM t")
def first_number(spark, d):
    """The first number in a text, in tenths."""
    t = L.table(spark, d, "part").selectExpr("p_partkey AS id", "CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN 'none' ELSE p_size || ' %ile (' || p_partkey || '.5 ug)' END AS txt")
    return t.select("id", F.floor(clean.first_number(F.col("txt")) * 10).cast("double").alias("tenths"))


@query("SELECT c_custkey AS id, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 3 THEN CAST(c_custkey AS VARCHAR) ELSE lpad(CAST(c_custkey AS VARCHAR), 3, '0') END AS fips FROM customer")
def fips_pad(spark, d):
    """Zero-padded codes joined; longer ones stay whole."""
    c = L.table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.concat(clean.padded(F.col("c_nationkey").cast("string"), 2), clean.padded(F.col("c_custkey").cast("string"), 3)).alias("fips"))


RULES = [("American Indian Reservation", "reservation", "statistical"), ("Off-Reservation Trust Land", "trust", "joint"), ("Hawaiian Home Land", "hawaiian", None), ("Joint Use Area", "joint", None)]
TRIBES = "CASE c_custkey % 6 WHEN 0 THEN 'X Reservation' WHEN 1 THEN 'Y Reservation Statistical Area' WHEN 2 THEN 'Z Trust Land' WHEN 3 THEN 'Joint Use Trust Land' WHEN 4 THEN 'Hawaiian Home Land' ELSE 'Other' END"


@query(
    f"""WITH t AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN '83' WHEN c_custkey % 4 = 1 THEN 'OT' ELSE 'zz' END AS code, lower({TRIBES}) AS n FROM customer)
SELECT id, CASE WHEN code = '83' THEN 'Joint Use Area' WHEN code = 'OT' THEN 'Off-Reservation Trust Land' WHEN n LIKE '%joint%' THEN 'Joint Use Area' WHEN n LIKE '%hawaiian%' THEN 'Hawaiian Home Land'
  WHEN n LIKE '%trust%' AND n NOT LIKE '%joint%' THEN 'Off-Reservation Trust Land' WHEN n LIKE '%reservation%' AND n NOT LIKE '%statistical%' THEN 'American Indian Reservation' END AS kind FROM t"""
)
def code_cascade(spark, d):
    """Kinds by code, else by the last rule that a name meets."""
    t = L.table(spark, d, "customer").selectExpr("c_custkey AS id", "CASE WHEN c_custkey % 4 = 0 THEN '83' WHEN c_custkey % 4 = 1 THEN 'OT' ELSE 'zz' END AS code", f"{TRIBES} AS n")
    return t.select("id", clean.cascade(F.col("code"), clean.TRIBAL_KINDS, F.col("n"), RULES).alias("kind"))


WATER = "SELECT p_partkey AS id, CAST(CASE WHEN p_partkey % 9 = 0 THEN -9999 WHEN p_partkey % 9 = 1 THEN 9999 WHEN p_partkey % 9 = 2 THEN -1 ELSE p_size END AS DOUBLE) AS score, p_brand AS brand FROM part"


@query(f"SELECT id, CASE WHEN score NOT IN (-9999, 9999) THEN score END AS score, brand FROM ({WATER})")
def sentinel_mask(spark, d):
    """Sentinels of numeric columns as null; -1 survives."""
    t = L.table(spark, d, "part").selectExpr("cast(p_partkey AS string) AS id", "cast(CASE WHEN p_partkey % 9 = 0 THEN -9999 WHEN p_partkey % 9 = 1 THEN 9999 WHEN p_partkey % 9 = 2 THEN -1 ELSE p_size END AS double) AS score", "p_brand AS brand")
    return clean.mask_sentinels(t).withColumn("id", F.col("id").cast("long"))


@query("WITH t AS (SELECT l_suppkey AS id, sum(CAST(l_quantity AS BIGINT)) AS v FROM lineitem GROUP BY 1), m AS (SELECT min(v) AS a, max(v) AS b FROM t) SELECT id, CAST(floor((CASE WHEN (a < 0 OR b > 100) AND b > a THEN 0e0 + (v - a) / CAST(b - a AS DOUBLE) * 100e0 ELSE v END) * 1000 + 0.5e0) AS BIGINT) AS scaled FROM t, m")
def minmax_if_outside(spark, d):
    """Supplier volumes brought to 0-100, since some lie beyond."""
    t = L.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.sum(F.col("l_quantity").cast("bigint")).cast("double").alias("v"))
    return tables.minmax_if_outside(t, "v").select("id", F.floor(F.col("v") * 1000 + 0.5).cast("long").alias("scaled"))


SIZES_SQL = "SELECT p_partkey AS id, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS v FROM part"


def sizes(spark, d):
    return L.table(spark, d, "part").selectExpr("p_partkey AS id", "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE cast(p_size AS double) END AS v")


@query(f"SELECT id, CASE WHEN v >= 30 THEN 1 ELSE 0 END AS high, CASE WHEN v < 12 THEN 1 ELSE 0 END AS low, CASE WHEN v IS NULL THEN 'unknown' WHEN v < 20 THEN 'yes' ELSE 'no' END AS isolated FROM ({SIZES_SQL})")
def threshold_flags(spark, d):
    """Flags whose nulls are 0, and one whose null stays."""
    v = F.col("v")
    isolated = clean.flag_below(v, 20, null_is_zero=False)
    return sizes(spark, d).select("id", clean.flag_at_least(v, 30).alias("high"), clean.flag_below(v, 12).alias("low"), F.when(isolated.isNull(), "unknown").when(isolated == 1, "yes").otherwise("no").alias("isolated"))


@query(f"SELECT id, CASE WHEN v IS NULL THEN 'No Data' WHEN v < 1 THEN 'Unpopulated' WHEN v < 10 THEN 'Very Rural' WHEN v < 20 THEN 'Rural' WHEN v < 35 THEN 'Suburban' ELSE 'Urban' END AS label FROM ({SIZES_SQL})")
def bin_labels(spark, d):
    """Ordered bins."""
    return sizes(spark, d).select("id", clean.bins(F.col("v"), [(1, "Unpopulated"), (10, "Very Rural"), (20, "Rural"), (35, "Suburban")], "Urban", "No Data").alias("label"))


@query(
    """WITH m AS (SELECT o_custkey AS id, month(o_orderdate) AS mo, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) % 40 - 5 AS DOUBLE) AS t FROM orders GROUP BY 1, 2)
SELECT id, CAST(CASE WHEN count(*) = 12 THEN floor(sum(greatest(t - 18.3e0, 0e0) * list_extract([31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31], CAST(mo AS INTEGER))) * 10 + 0.5e0) ELSE -1 END AS BIGINT) AS tenths FROM m GROUP BY id"""
)
def degree_days(spark, d):
    """Cooling degree-days from twelve monthly values; customers without all months have none."""
    m = L.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id"), F.month("o_orderdate").alias("mo")).agg((F.sum(F.floor("o_totalprice").cast("bigint")) % 40 - 5).cast("double").alias("t"))
    wide = m.groupBy("id").pivot("mo", list(range(1, 13))).agg(F.first("t"))
    cdd = clean.cooling_degree_days(F.array(*(F.col(str(i)) for i in range(1, 13))))
    return wide.select("id", F.coalesce(F.floor(cdd * 10 + 0.5).cast("long"), F.lit(-1)).alias("tenths"))


RATING = "CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Relatively High' WHEN 2 THEN ' Very High ' WHEN 3 THEN 'Relatively Moderate' WHEN 4 THEN 'No Rating' ELSE 'Very Low' END"


@query(f"SELECT o_orderkey AS id, CAST(coalesce(trim({RATING}) IN ('Relatively High', 'Very High'), FALSE) AS INTEGER) AS high, CAST(coalesce(trim({RATING}) IN ('Relatively Moderate', 'Relatively High', 'Very High'), FALSE) AS INTEGER) AS moderate FROM orders")
def rating_flags(spark, d):
    """Flags from ratings."""
    t = L.table(spark, d, "orders").selectExpr("o_orderkey AS id", f"{RATING} AS rating")
    return t.select("id", clean.rating_flag(F.col("rating"), ["Relatively High", "Very High"]).alias("high"), clean.rating_flag(F.col("rating"), ["Relatively Moderate", "Relatively High", "Very High"]).alias("moderate"))


@query("WITH t AS (SELECT l_orderkey AS id, l_linenumber AS line, CASE WHEN l_partkey % 3 = 0 THEN 'x' WHEN l_partkey % 3 = 1 THEN '0' ELSE CAST(l_partkey AS VARCHAR) END AS a, CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS b FROM lineitem), n AS (SELECT id, line, try_cast(a AS DOUBLE) AS a, try_cast(nullif(b, '') AS DOUBLE) AS b FROM t) SELECT id, line, CASE WHEN (CASE WHEN a > 0 THEN a ELSE b END) > 0 THEN CASE WHEN a > 0 THEN a ELSE b END END AS mw FROM n")
def fallback_measure(spark, d):
    """The first positive measure of two texts."""
    t = L.table(spark, d, "lineitem").selectExpr("l_orderkey AS id", "l_linenumber AS line", "CASE WHEN l_partkey % 3 = 0 THEN 'x' WHEN l_partkey % 3 = 1 THEN '0' ELSE cast(l_partkey AS string) END AS a", "CASE WHEN l_suppkey % 4 = 0 THEN '' ELSE cast(l_suppkey AS string) END AS b")
    return t.select("id", "line", clean.fallback_measure(clean.number(F.col("a")), clean.number(F.col("b"))).alias("mw"))


@query("WITH t AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN 0 WHEN c_custkey % 10 = 1 THEN 91 WHEN c_custkey % 10 = 2 THEN NULL ELSE c_nationkey END AS lat, CASE WHEN c_custkey % 10 = 0 THEN 0 WHEN c_custkey % 10 = 3 THEN -181 ELSE c_custkey % 180 END AS lon FROM customer) SELECT id FROM t WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND NOT (lat = 0 AND lon = 0)")
def coord_sanity(spark, d):
    """Rows with usable coordinates."""
    from ..sources.readers import usable

    t = L.table(spark, d, "customer").selectExpr("c_custkey AS id", "CASE WHEN c_custkey % 10 = 0 THEN 0 WHEN c_custkey % 10 = 1 THEN 91 WHEN c_custkey % 10 = 2 THEN NULL ELSE c_nationkey END AS lat", "CASE WHEN c_custkey % 10 = 0 THEN 0 WHEN c_custkey % 10 = 3 THEN -181 ELSE c_custkey % 180 END AS lon")
    return t.filter(usable(F.col("lat"), F.col("lon"))).select("id")


@query("SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('click', 'view')")
def unknown_values(spark, d):
    """Categories beyond the known ones."""
    return clean.unknown(L.table(spark, d, "events"), "event_type", ["click", "view"])


@query("SELECT p_partkey AS cell_id, p_size AS dist_km, p_retailprice AS price, 'parts' AS source FROM part")
def alias_select(spark, d):
    """Columns renamed by a map, the canonical ones kept, a provenance column added."""
    renamed = L.table(spark, d, "part").withColumnsRenamed({"p_partkey": "cell_id", "p_size": "dist_km", "p_retailprice": "price"})
    return renamed.select(*(c for c in ("cell_id", "dist_km", "price", "not_there") if c in renamed.columns), F.lit("parts").alias("source"))


@query("SELECT o_orderkey AS id, CAST(NOT (o_orderpriority LIKE 'NA%' OR o_orderpriority = 'nan') AS INTEGER) AS kept, upper(trim(o_orderstatus)) = 'O' AS open FROM orders")
def text_filters(spark, d):
    """Prefix, sentinel and case-insensitive conditions on text."""
    return L.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), clean.coded(F.col("o_orderpriority")).cast("int").alias("kept"), clean.same_word(F.col("o_orderstatus"), "O").alias("open"))
