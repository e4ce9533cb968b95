"""Relational operators of the feature jobs: aggregates, lookups, shares, reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import HYPERSCALERS, any_of


def cell_labels(facilities: DataFrame, key: str = "cell_id") -> DataFrame:
    """One row per cell with facilities: counts, sizes (null if all are null), hyperscale flag, dominant
    type, operators in order and the most common state (the least of equals)."""
    kind = F.max(F.when(F.col("type") == "campus", 2).when(F.col("type") == "building", 1).otherwise(0))
    states = facilities.filter("state_abb is not null").groupBy(key, "state_abb").agg(F.count("*").alias("n"))
    mode = states.groupBy(key).agg(F.min_by("state_abb", F.struct(-F.col("n"), F.col("state_abb"))).alias("state_abb"))
    out = facilities.groupBy(key).agg(
        F.lit(1).alias("has_dc"),
        F.count("*").alias("facility_count"),
        F.max("sqft").alias("max_sqft"),
        F.sum("sqft").alias("total_sqft"),
        F.max(any_of(F.col("operator"), HYPERSCALERS)).alias("has_hyperscaler"),
        F.element_at(F.array(F.lit("point"), F.lit("building"), F.lit("campus")), kind + 1).alias("dominant_type"),
        F.array_join(F.array_sort(F.collect_set("operator")), ", ").alias("operators"),
    )
    return out.join(mode, key, "left")


def outer_with_zeros(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Full outer join; measures that a side lacks are 0."""
    return left.join(right, list(keys), "full_outer").fillna(0, subset=list(measures))


def floored_ratio(above: Column, below: Column, floor: float = 1.0) -> Column:
    """above / max(below, floor), nulls as 0."""
    return F.coalesce(above, F.lit(0.0)) / F.greatest(F.coalesce(below, F.lit(0.0)), F.lit(floor))


def most_common(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The most frequent combination of values for each key; of equals the least."""
    counts = df.dropna(subset=[*keys, *values]).groupBy(*keys, *values).agg(F.count("*").alias("n"))
    best = counts.groupBy(*keys).agg(F.min_by(F.struct(*values, "n"), F.struct(-F.col("n"), *values)).alias("b"))
    return best.select(*keys, "b.*")


def greatest_sum(df: DataFrame, keys: Sequence[str], value: str, measure: str) -> DataFrame:
    """The value with the greatest sum of a measure for each key; of equals the least."""
    sums = df.groupBy(*keys, value).agg(F.sum(measure).alias("total"))
    best = sums.groupBy(*keys).agg(F.min_by(F.struct(value, "total"), F.struct(-F.col("total"), value)).alias("b"))
    return best.select(*keys, "b.*")


def equal_shares(totals: DataFrame, members: DataFrame, key: str, place: str, revenue: str, volume: str, least_volume: float = 0.0) -> DataFrame:
    """Totals of each key dealt out evenly over its places, then summed by place with the price
    revenue / volume (null without volume).  Keys below the least volume are left out."""
    big = totals.filter(F.col(volume) >= least_volume)
    sizes = members.select(key, place).distinct().groupBy(key).agg(F.count("*").alias("places"))
    each = members.select(key, place).distinct().join(sizes, key).join(big, key)
    out = each.groupBy(place).agg(F.sum(F.col(revenue) / F.col("places")).alias(revenue), F.sum(F.col(volume) / F.col("places")).alias(volume), F.count_distinct(key).alias("members"))
    return out.withColumn("price", F.when(F.col(volume) > 0, F.col(revenue) / F.greatest(F.col(volume), F.lit(1e-6))))


def row_total(columns: Sequence[str]) -> Column:
    """Sum over columns, nulls as 0."""
    return reduce(lambda a, b: a + b, (F.coalesce(F.col(c), F.lit(0.0)) for c in columns))


def row_percent(part: Sequence[str], whole: Sequence[str]) -> Column:
    """Percent of some columns in the sum of others; null where that is 0."""
    return 100 * row_total(part) / F.nullif(row_total(whole), F.lit(0.0))


def merged_hazard(coastal: str, inland: str) -> list[Column]:
    """Flood score (greater), loss (sum, null if both are) and rating (of the greater; ties and nulls: coastal)."""
    c, i = F.col(f"{coastal}_score"), F.col(f"{inland}_score")
    ce, ie = F.col(f"{coastal}_loss"), F.col(f"{inland}_loss")
    loss = F.when(ce.isNotNull() | ie.isNotNull(), F.coalesce(ce, F.lit(0.0)) + F.coalesce(ie, F.lit(0.0)))
    rating = F.when(F.coalesce(c, F.lit(-1.0)) >= F.coalesce(i, F.lit(-1.0)), F.col(f"{coastal}_rating")).otherwise(F.col(f"{inland}_rating"))
    return [F.greatest(c, i).alias("flood_score"), loss.alias("flood_loss"), rating.alias("flood_rating")]


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows by value, null among them, with their share of all rows."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))  # one row
    return counts.join(F.broadcast(total), how="inner", on=F.lit(True)).select(column, "n", (F.col("n") / F.col("total")).alias("share"))


#: Buckets into which each round of the rank search cuts the range that still holds a rank.
BUCKETS = 256


def percentiles(df: DataFrame, column: str, points: Sequence[float]) -> list[float | None]:
    """Exact interpolated percentiles of the column's numbers; null without any.

    Ranks are looked for in rounds: the range that holds one is cut into buckets, their rows, least and
    greatest values are counted, and the bucket with the rank is the next round's range, until it holds one
    value.  A round returns `BUCKETS` rows for each range; no task ever holds the values.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v is not null and not isnan(v)")
    n, low, high = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return [None] * len(points)
    wanted = {r for p in points for r in (int((n - 1) * p), min(n - 1, int((n - 1) * p) + 1))}
    at = {r: (low, high, 0) for r in wanted}  # range and the number of values before it
    while open_ := sorted({(a, b, before) for a, b, before in at.values() if a < b}):
        v = F.col("v")
        place = F.lit(None).cast("struct<range:int,bucket:int>")
        for i, (a, b, _) in enumerate(open_):
            bucket = F.least(F.lit(BUCKETS - 1), F.greatest(F.lit(0), F.floor((v / 2 - a / 2) / (b / 2 - a / 2) * BUCKETS).cast("int")))
            place = F.when(v.between(a, b), F.struct(F.lit(i).alias("range"), bucket.alias("bucket"))).otherwise(place)
        rows = values.select("v", place.alias("p")).filter("p is not null").groupBy("p.range", "p.bucket").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
        for r, (a, b, before) in list(at.items()):
            if a < b:
                for row in sorted((x for x in rows if open_[x["range"]] == (a, b, before)), key=lambda x: x["bucket"]):
                    if r < before + row["n"]:
                        at[r] = row["low"], row["high"], before
                        break
                    before += row["n"]
    out: list[float | None] = []
    for p in points:
        spot = (n - 1) * p
        lower = int(spot)
        one, two = at[lower][0], at[min(n - 1, lower + 1)][0]
        out.append(one if spot == lower or one == two else (lower + 1 - spot) * one + (spot - lower) * two)
    return out


def described(df: DataFrame, column: str, points: Sequence[float] = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    """Count, distinct count, least, mean, greatest and exact interpolated percentiles of a column."""
    found = percentiles(df, column, points)
    out = df.agg(F.count(column).alias("n"), F.count_distinct(column).alias("n_distinct"), F.min(column).alias("least"), F.avg(column).alias("mean"), F.max(column).alias("most"))
    return out.withColumns({f"p{round(p * 100)}": F.lit(v).cast("double") for p, v in zip(points, found, strict=True)})


def null_rates(df: DataFrame, columns: Sequence[str], groups: dict[str, str] | None = None) -> DataFrame:
    """(column, group, present, nulls, rate) in one pass over the data; columns that are missing count as
    absent throughout."""
    groups = groups or {}
    have = [c for c in columns if c in df.columns]
    counts = df.agg(F.count("*").alias("rows"), *(F.count(c).alias(c) for c in have))
    lists = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(groups.get(c)).alias("group"), F.lit(int(c in have)).alias("present"), (F.col("rows") - (F.col(c) if c in have else F.lit(0))).alias("nulls"), F.col("rows").alias("rows")) for c in columns))
    return counts.select(F.explode(lists).alias("r")).select("r.column", "r.group", "r.present", "r.nulls", (F.col("r.nulls") / F.col("r.rows")).alias("rate"))


def group_coverage(rates: DataFrame) -> DataFrame:
    """Mean share of filled values by group of columns."""
    return rates.groupBy("group").agg(F.count("*").alias("columns"), F.sum("present").alias("present"), (1 - F.avg("rate")).alias("coverage"))


def top_groups(df: DataFrame, group: str, measure: str, n: int) -> DataFrame:
    """The n groups with the greatest mean of a measure."""
    return df.groupBy(group).agg(F.avg(measure).alias("mean"), F.count("*").alias("rows")).orderBy(F.desc("mean"), group).limit(n)


def flag_in(df: DataFrame, others: DataFrame, key: str, name: str) -> DataFrame:
    """1 where the key occurs among the others, else 0."""
    keys = others.select(key).distinct().withColumn("_hit", F.lit(1))
    return df.join(keys, key, "left").withColumn(name, F.coalesce("_hit", F.lit(0))).drop("_hit")


def pending(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no result yet."""
    return df.join(done.select(key), key, "left_anti")


def coalesced(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join in which the right side fills the left side's nulls."""
    renamed = right.select(*keys, *(F.col(c).alias(f"_{c}") for c in columns))
    joined = left.join(renamed, list(keys), "left")
    return joined.withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*(f"_{c}" for c in columns))


def wide_join(spine: DataFrame, features: Sequence[DataFrame], key: str) -> DataFrame:
    """Feature tables joined to the spine one after another; columns already there are skipped.  All are
    partitioned by the same key, so the spine is shuffled once."""
    out = spine
    for f in features:
        new = [c for c in f.columns if c == key or c not in out.columns]
        if len(new) > 1:
            out = out.join(f.select(*new), key, "left")
    return out


def ordered(df: DataFrame, ids: Sequence[str], features: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Columns in a pinned order: ids (all of them needed), those features and labels that the frame has, then
    the rest as it stands."""
    if missing := [c for c in ids if c not in df.columns]:
        raise ValueError(f"missing ids: {missing}")
    pinned = list(dict.fromkeys([*ids, *(c for c in (*features, *labels) if c in df.columns)]))
    return df.select(*pinned, *(c for c in df.columns if c not in pinned))


def cumulative_share(df: DataFrame, measure: str, order: Sequence[Column]) -> DataFrame:
    """Share of the total and running share in the given order.  For short lists, such as importances:
    the running sum takes them through one task."""
    w = Window.orderBy(*order)
    whole = F.sum(measure).over(Window.partitionBy())
    return df.withColumn("share", F.col(measure) / whole).withColumn("running", F.sum(measure).over(w.rowsBetween(Window.unboundedPreceding, 0)) / whole)


def minmax_if_outside(df: DataFrame, column: str, low: float = 0.0, high: float = 100.0) -> DataFrame:
    """Rescales a column to [low, high] if any value lies outside; a column without spread stays."""
    ends = df.agg(F.min(column).alias("_a"), F.max(column).alias("_b"))  # one row
    c, a, b = F.col(column), F.col("_a"), F.col("_b")
    scaled = F.when(((a < low) | (b > high)) & (b > a), low + (c - a) / (b - a) * (high - low)).otherwise(c)
    return df.join(F.broadcast(ends), how="inner", on=F.lit(True)).withColumn(column, scaled).drop("_a", "_b")


def label_checks(df: DataFrame, key: str = "cell_id") -> DataFrame:
    """Checks of a label table: (name, passed)."""
    one = df.agg((F.count("*") == F.count_distinct(key)).alias("unique_key"), F.coalesce(F.min("has_dc") == 1, F.lit(True)).alias("all_flagged"), F.coalesce(F.min("facility_count") >= 1, F.lit(True)).alias("counts_positive"))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("passed")) for c in ("unique_key", "all_flagged", "counts_positive")))).alias("r")).select("r.*")


def lineage(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(step, name, rows) of successive frames."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(i).alias("step"), F.lit(name).alias("name"), "rows") for i, (name, df) in enumerate(stages)]
    return reduce(DataFrame.unionByName, parts)


def row_band(df: DataFrame, least: int, most: int) -> DataFrame:
    """Whether a table's row count lies in a band."""
    return df.agg(F.count("*").alias("rows")).withColumn("passed", F.col("rows").between(least, most))


def summary(df: DataFrame, measure: str, flags: Sequence[str]) -> DataFrame:
    """Rows, matched rows, exact centre and spread of a measure, and the flags' counts and percentages."""
    median = percentiles(df, measure, [0.5])[0]
    return df.agg(F.count("*").alias("rows"), F.count(measure).alias("matched"), F.min(measure).alias("least"), F.lit(median).cast("double").alias("median"), F.avg(measure).alias("mean"), F.max(measure).alias("most"), *(F.sum(f).alias(f"n_{f}") for f in flags), *((100 * F.avg(f)).alias(f"pct_{f}") for f in flags))


def inspect(df: DataFrame, sentinels: Sequence[float] = (-9999, 9999)) -> DataFrame:
    """A row for each column: its type, nulls once sentinels are masked, and of numeric ones the least,
    mean and greatest value; one pass over the table."""
    from ..functions.clean import mask_sentinels

    masked = mask_sentinels(df, sentinels)
    numeric = {n for n, t in df.dtypes if t.split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")}
    aggs = []
    for i, n in enumerate(df.columns):
        c = masked[n]
        value = c.cast("double") if n in numeric else F.lit(None).cast("double")
        aggs += [F.sum(c.isNull().cast("long")).alias(f"nulls_{i}"), F.min(value).alias(f"least_{i}"), F.avg(value).alias(f"mean_{i}"), F.max(value).alias(f"most_{i}")]
    one = masked.agg(*aggs)
    rows = F.array(*(F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("type"), F.coalesce(F.col(f"nulls_{i}"), F.lit(0)).alias("nulls"), *(F.col(f"{k}_{i}").alias(k) for k in ("least", "mean", "most"))) for i, (n, t) in enumerate(df.dtypes)))
    return one.select(F.explode(rows).alias("r")).select("r.*")


def prefix_sample(df: DataFrame, n: int, key: str = "cell_id") -> DataFrame:
    """The n rows of least key: the same ones whenever a job is tried on a part of its cells."""
    return df.orderBy(key).limit(n)
