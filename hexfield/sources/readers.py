"""Readers for staged inputs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.clean import nan_to_null, number
from .shared import materialized


def trimmed(df: DataFrame) -> DataFrame:
    """All text columns without outer spaces."""
    return df.select(*(F.trim(df[f.name]).alias(f.name) if isinstance(f.dataType, StringType) else df[f.name] for f in df.schema.fields))


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV file under a given schema, ids as text, text columns trimmed, NaN as null."""
    return nan_to_null(trimmed(spark.read.csv(path, schema=schema, header=True, enforceSchema=False, encoding="UTF-8")))


def read_some(spark: SparkSession, path: str, wanted: Sequence[str]) -> DataFrame:
    """Those of the wanted columns that a CSV file has, in the wanted order, as text; a byte-order mark
    before the header is ignored."""
    df = spark.read.csv(path, header=True)
    df = df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))
    return df.select(*(c for c in wanted if c in df.columns))


def flattened(df: DataFrame, levels: Sequence[Sequence[str]]) -> DataFrame:
    """Names from several header rows: A, B, C become A_B_C, in lower case with single underscores."""
    names = [re.sub(r"[^0-9a-z]+", "_", "_".join(x for x in parts if x).lower()).strip("_") for parts in zip(*levels, strict=True)]
    return df.toDF(*names)


def read_sheet(df: DataFrame, levels: Sequence[Sequence[str]], keys: Sequence[str], numbers: Sequence[str] = (), names: dict[str, str] | None = None) -> DataFrame:
    """A staged sheet of texts: names from its header rows, some of them changed, rows without a key left
    out, numbers read as such (what is none becomes null)."""
    t = trimmed(flattened(df, levels)).withColumnsRenamed(names or {})
    return t.withColumns({c: number(F.col(c)) for c in numbers}).dropna(subset=list(keys))


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet table, or some of its columns."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_months(spark: SparkSession, path: str, pattern: str, schema: StructType | str) -> DataFrame:
    """Files below a folder whose names tell a month: `band` is 1-12 from the name's ..._MM, 0 without.  A
    table that Spark wrote is a folder of part files, and counts by the folder's name.  Names are read once for
    each file; rows only look their file up."""
    df = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).parquet(path)
    month = F.regexp_extract(F.col("_name"), r"_(\d{2})(?:\D|$)", 1)
    of_folder = F.regexp_extract(F.col("_path"), r"_(\d{2})(?:\D[^/]*)?/part-[^/]*$", 1)
    files = df.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("_name")).distinct()
    files = materialized(files.select("_path", F.coalesce(month.try_cast("int"), of_folder.try_cast("int"), F.lit(0)).alias("band")))
    rows = df.withColumn("_file", F.col("_metadata.file_path"))
    return rows.join(F.broadcast(files), F.col("_file") == F.col("_path")).select(*df.columns, "band")  # a row for each file


def require_bands(df: DataFrame, bands: Sequence[int]) -> DataFrame:
    """The frame, if every band occurs; otherwise an error that names the missing ones."""
    found = {r["band"] for r in df.filter(F.col("band").isin(*bands)).select("band").distinct().collect()}
    if missing := sorted(set(bands) - found):
        raise ValueError(f"missing bands: {missing}")
    return df


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str, key: str, sequence: str) -> DataFrame:
    """JSON lines of results by key; of several records of a key the one with the greatest sequence counts."""
    df = spark.read.schema(schema).json(path)
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), sequence).alias("r")).select("r.*")


def exchange_sites(links: DataFrame, facilities: DataFrame, country: str) -> DataFrame:
    """Exchange points with coordinates through their links to facilities: the link's name, city and
    country count before the facility's; unusable coordinates go; one row for each pair of ids."""
    l, f = links.alias("l"), facilities.alias("f")
    joined = l.join(f, F.col("l.fac_id") == F.col("f.id"))
    pick = lambda c: F.coalesce(F.nullif(F.trim(F.col(f"l.{c}")), F.lit("")), F.col(f"f.{c}")).alias(c)
    lat, lon = F.col("f.latitude"), F.col("f.longitude")
    sites = joined.filter(usable(lat, lon)).select("l.ix_id", "l.fac_id", pick("name"), pick("city"), pick("country"), lat.alias("lat"), lon.alias("lon"))
    return sites.filter(F.col("country") == country).groupBy("ix_id", "fac_id").agg(F.min(F.struct("name", "city", "country", "lat", "lon")).alias("s")).select("ix_id", "fac_id", "s.*")


def usable(lat, lon):
    """Coordinates on the globe and not both zero."""
    return lat.between(-90, 90) & lon.between(-180, 180) & ~((lat == 0) & (lon == 0))


def choose_layer(names: Sequence[str], wanted: str | None = None, part: str = "combined") -> str:
    """A layer by its name, or the first whose name holds a part; an error lists what there is."""
    if wanted in names:
        return wanted
    if wanted is None and (found := [n for n in names if part in n.lower()]):
        return found[0]
    raise ValueError(f"no layer {wanted or part!r} among {sorted(names)}")


def dissolved(df: DataFrame, columns: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The outline of the rows selected by the first of the name columns that the layer has, as one polygon:
    overlaps count once, common sides vanish."""
    from ..operators.polygons import dissolve

    column = next((c for c in columns if c in df.columns), None)
    if column is None:
        raise ValueError(f"none of {list(columns)} among {df.columns}")
    chosen = df.filter(F.col(column).isin(*values)).select(F.lit(1).alias("one"), "rings")
    box = chosen.select(F.explode(F.flatten("rings")).alias("p")).agg(F.max("p.x") - F.min("p.x"), F.max("p.y") - F.min("p.y")).first()
    size = max(*(v or 0.0 for v in box), 1e-9) / 32
    return dissolve(chosen, "one", size).agg(F.collect_list("corners").alias("rings"))
