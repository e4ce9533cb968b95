"""Tables between steps, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.  A session without one gets a folder of its own only where it
    runs on this machine alone (tests); on a cluster that is an error, since executors would not share it."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(base)
    return base.rstrip("/")


def materialized(df: DataFrame) -> DataFrame:
    """The frame's rows written to the shared folder and read again: lineage ends there, and a lost
    executor costs no recomputation beyond it."""
    path = f"{shared_folder(df.sparkSession)}/steps/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
