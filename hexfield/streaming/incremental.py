"""Incremental work: only keys without a result are processed, and results are appended."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.tables import pending


def resume(keys: DataFrame, done: DataFrame, key: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Results so far with those of the keys that lacked one."""
    return done.unionByName(work(pending(keys, done, key)))


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def committed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all batches that were finished; without any an empty frame."""
    system, folder = _files(spark, f"{path}/batches")
    names = [s.getPath().toString() for s in system.listStatus(folder)] if system.exists(folder) else []
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)


def run_batches(keys: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], path: str, batches: int) -> DataFrame:
    """Results of all keys, worked off in batches that survive a stopped run.

    A batch is written to a place of its own and becomes visible by one rename of its folder, so it counts
    as a whole or not at all.  A run that starts anew deletes what was left unfinished and takes up the keys
    without a result; none is lost or doubled.  The file system must rename folders in one step, and one run
    works on a path at a time.
    """
    spark, schema = keys.sparkSession, work(keys.limit(0)).schema
    system, open_ = _files(spark, f"{path}/open")
    system.delete(open_, True)
    left = pending(keys, committed(spark, path, schema), key)
    for i in range(batches):
        part = left.filter(F.pmod(F.xxhash64(key), F.lit(batches)) == i)
        name = uuid.uuid4().hex
        work(part).write.parquet(f"{path}/open/{name}")
        system.mkdirs(_files(spark, f"{path}/batches")[1])
        if not system.rename(_files(spark, f"{path}/open/{name}")[1], _files(spark, f"{path}/batches/{name}")[1]):
            raise OSError(f"batch {name} could not be committed")
    return committed(spark, path, schema)


def partial_counts(pixels: DataFrame, key: str) -> DataFrame:
    """Statistics by cell and class that can be stored, added up and finished without another scan."""
    return pixels.groupBy(key, "class").agg(F.count("*").alias("n"))


def finished_counts(parts: DataFrame, key: str) -> DataFrame:
    """Stored statistics added up: total pixels, classes and the dominant class of each cell."""
    sums = parts.groupBy(key, "class").agg(F.sum("n").alias("n"))
    return sums.groupBy(key).agg(F.sum("n").alias("total_pixels"), F.count("*").alias("classes"), F.min_by("class", F.struct(-F.col("n"), F.col("class"))).alias("dominant_class"))


def reuse_or_build(cached: DataFrame | None, spine: DataFrame, build: Callable[[], DataFrame]) -> DataFrame:
    """A stored crosswalk if it has as many rows as the spine, else a new one."""
    if cached is not None and cached.count() == spine.count():
        return cached
    return build()
