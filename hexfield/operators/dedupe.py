"""Entity resolution: linked records, their clusters, and one record of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import distance2
from ..sources.shared import materialized
from .spatial import bucketed, close_pairs, dealt


def duplicate_pairs(df: DataFrame, key: str, radius: float, same: Sequence[str]) -> DataFrame:
    """(a, b) of records within a radius whose folded, non-empty text agrees in one of the columns."""
    folded = df.select(key, "x", "y", *(F.nullif(F.lower(F.trim(c)), F.lit("")).alias(c) for c in same))
    agree = F.lit(False)
    for c in same:
        agree |= F.coalesce(F.col(f"a_{c}") == F.col(f"b_{c}"), F.lit(False))
    return close_pairs(folded, key, radius).filter(agree).select("a", "b")


def duplicate_links(df: DataFrame, key: str, radius: float, same: Sequence[str]) -> DataFrame:
    """(a, b) of records that connect the same records as duplicate_pairs does, without all of its pairs: records
    of one place and text hang on the least of them, and only those least ones are paired with others."""
    placed = df.select(key, "x", "y", *same).filter((F.abs("x") < 1e300) & (F.abs("y") < 1e300))
    links = None
    for c in same:
        folded = placed.select(F.col(key).alias("a"), "x", "y", F.lower(F.trim(c)).alias("text")).filter("text <> ''")
        least = materialized(folded.groupBy("x", "y", "text").agg(F.min("a").alias("b")))
        hung = folded.join(least, ["x", "y", "text"]).filter("a <> b").select("a", "b")
        near = bucketed(least, "x", "y", radius).withColumnRenamed("b", "a")
        far = dealt(least, F.col("x") - radius, F.col("y") - radius, F.col("x") + radius, F.col("y") + radius, radius).withColumnsRenamed({"x": "sx", "y": "sy"})
        met = near.join(far.hint("merge"), ["bx", "by", "text"]).filter("a < b").filter(distance2(F.col("x"), F.col("y"), F.col("sx"), F.col("sy")) <= radius * radius)
        found = hung.unionByName(met.select("a", "b"))
        links = found if links is None else links.unionByName(found)
    return links


#: A hub has more neighbours than a 1 / HUBS share of all edges, and HEAVY at least; so there are 2 * HUBS at most.
HUBS, HEAVY = 10_000, 1_000


def _with_least(both: DataFrame, least: DataFrame, edges: int) -> DataFrame:
    """Edges (u, v, m) with the least neighbour of u.  Edges of hubs meet a broadcast list of hubs, which has
    a bounded length, so that no key gathers a hub's edges in one task."""
    many = max(HEAVY, edges // HUBS)
    hubs = F.broadcast(least.filter(F.col("n") > many).select("u", "m"))
    light = both.join(F.broadcast(least.filter(F.col("n") > many).select("u")), "u", "left_anti")
    return light.join(least.filter(F.col("n") <= many).select("u", "m"), "u").unionByName(both.join(hubs, "u"))


def clusters(nodes: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """Each node with the least node that pairs connect it to.

    Larger neighbours of a node are hung on the least of its neighbours and itself, then smaller ones in the
    same way, until nothing changes; the rounds follow the logarithm of a cluster's size.
    """
    edges = materialized(pairs.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    state = mark(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialized(both.groupBy("u").agg(F.min("v").alias("v"), F.count("*").alias("n")).select("u", F.least("u", "v").alias("m"), "n"))
        large = materialized(_with_least(both.filter("v > u"), least, 2 * state[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        least = materialized(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        small = _with_least(large, least, state[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges, before = materialized(small.union(least.select("u", "m")).distinct()), state
        state = mark(edges)
        if state == before:
            break
    found = edges.select(F.col("u").alias(key), F.col("v").alias("_least"))
    return nodes.select(key).join(found, key, "left").select(key, F.coalesce("_least", key).alias("cluster"))


def first_of_each(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group in a total order."""
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def representatives(df: DataFrame, key: str, radius: float, same: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One record of each cluster of duplicates, with the cluster and its size."""
    found = clusters(df, duplicate_links(df, key, radius, same), key)
    joined = df.join(found, key)
    sizes = found.groupBy("cluster").agg(F.count("*").alias("members"))
    return first_of_each(joined, ["cluster"], order).join(sizes, "cluster")
