"""Writers for tables and for the documents that a map client reads."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def write_parquet(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Pinned columns, in order."""
    df.select(*columns).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Pinned columns with a header."""
    df.select(*columns).write.mode("overwrite").csv(path, header=True)


def feature(ring: Column, properties: Sequence[str | Column]) -> Column:
    """A GeoJSON feature as text: the ring closed, [x, y] corners."""
    corners = F.transform(ring, lambda p: F.array(p["x"], p["y"]))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(F.concat(corners, F.slice(corners, 1, 1))).alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties")))


def write_features(df: DataFrame, path: str, ring: str, properties: Sequence[str], digits: int | None = None) -> DataFrame:
    """GeoJSON features, one a line, fractions rounded to some digits, and the frame of their counts."""
    fractions = {f.name for f in df.schema.fields if digits is not None and isinstance(f.dataType, (DoubleType, FloatType))}
    lines = df.select(feature(F.col(ring), [F.round(c, digits).alias(c) if c in fractions else F.col(c) for c in properties]).alias("value"))
    lines.write.mode("overwrite").text(path)
    return df.agg(F.count("*").alias("features"))


def write_collection(df: DataFrame, path: str, key: str, ring: str, properties: Sequence[str], metadata: dict | None = None, digits: int | None = None) -> DataFrame:
    """One GeoJSON FeatureCollection in parts: the files of `path` in the order of their names, one after
    another, are the document, its features in order of the key.  Head, features and tail are written by one
    range-partitioned job, so no task has all of it.  Returns (part, bytes, offset): where each part begins,
    for putting them together side by side.  Keys are unique; rows without one are left out."""
    rows = df.filter(F.col(key).isNotNull())
    count, last = rows.agg(F.count("*"), F.max(key)).first()
    fractions = {f.name for f in df.schema.fields if digits is not None and isinstance(f.dataType, (DoubleType, FloatType))}
    text = feature(F.col(ring), [F.round(c, digits).alias(c) if c in fractions else F.col(c) for c in properties])
    lines = rows.select(F.lit(1).alias("at"), F.col(key).alias("key"), F.concat(text, F.when(F.col(key) == F.lit(last), "").otherwise(",")).alias("value"))
    head = json.dumps({"type": "FeatureCollection", "metadata": {"count": count} | (metadata or {})}, ensure_ascii=False)[:-1] + ', "features": ['
    ends = df.sparkSession.createDataFrame([(0, head), (2, "]}")], "at int, value string").select("at", F.lit(None).cast(rows.schema[key].dataType).alias("key"), "value")
    whole = lines.unionByName(ends)
    whole.repartitionByRange("at", "key").sortWithinPartitions("at", "key").select("value").write.mode("overwrite").text(path)
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = sorted((s.getPath().getName(), s.getLen()) for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder) if s.getPath().getName().startswith("part-"))
    sizes = [n for _, n in found]
    return spark.createDataFrame([(name, n, sum(sizes[:i])) for i, (name, n) in enumerate(found)], "part string, bytes bigint, offset bigint")


def basemap_lines(df: DataFrame, columns: Sequence[str]) -> Column:
    """A row as a CSV line, for estimating sizes."""
    return F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def write_basemap(df: DataFrame, path: str, columns: Sequence[str], score: str, thresholds: Sequence[float] = (0.02, 0.05), max_bytes: int = 20_000_000, digits: int | None = None) -> float:
    """The rows at or above the first threshold whose file stays within the size in bytes, header included; the
    last one otherwise.  Fractions are rounded to some digits first."""
    if digits is not None:
        df = df.withColumns({f.name: F.round(f.name, digits) for f in df.schema.fields if f.name in columns and f.name != score and isinstance(f.dataType, (DoubleType, FloatType))})
    size = F.octet_length(basemap_lines(df, columns)) + 1
    max_bytes -= len(",".join(columns).encode()) + 1
    sums = df.agg(*(F.sum(F.when(F.col(score) >= t, size)).alias(f"s{i}") for i, t in enumerate(thresholds))).first()
    chosen = next((t for i, t in enumerate(thresholds) if (sums[i] or 0) <= max_bytes), thresholds[-1])
    df.filter(F.col(score) >= chosen).select(*columns).write.mode("overwrite").csv(path, header=True)
    return chosen


def append_results(df: DataFrame, path: str) -> None:
    """Results by key added to a store of JSON lines."""
    df.write.mode("append").json(path)


def write_reasons(explained: DataFrame, path: str, key: str = "cell_id") -> None:
    """Cells with their lists of reasons as JSON lines."""
    explained.select(key, "reasons").write.mode("overwrite").json(path)
