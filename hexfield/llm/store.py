"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid
import weakref

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.  Only a session without one that runs on this machine
    alone (tests) gets a folder of its own; on a cluster that would lose data, so it is an error."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not re.match(r"local($|\[)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(base)
    return base.rstrip("/")


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh place for one intermediate table."""
    return f"{shared_folder(spark)}/hexfield/{uuid.uuid4().hex}/{name}"


#: The folders of the tables that `written` made, as long as their frames live.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: a lost executor repeats nothing before it."""
    path = table_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of `written` once everything that reads them has been written itself."""
    for df in tables:
        if path := _FOLDERS.pop(df, None):
            spark = df.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder.getParent(), True)


def extended(df: DataFrame, added: str) -> StructType:
    """The frame's schema with further fields, given as DDL."""
    return StructType([*df.schema.fields, *StructType.fromDDL(added).fields])


def free(df: DataFrame, added: str) -> DataFrame:
    """The frame without columns that have a name of the further fields, whatever its case."""
    names = {f.name.lower() for f in StructType.fromDDL(added).fields}
    return df.drop(*(c for c in df.columns if c.lower() in names))


def packed(docs: DataFrame, *more: Column | str) -> DataFrame:
    """The documents' columns but `text` as one column `row`, beside those an operator works on.

    Whatever names the documents' columns have, they cannot clash with an operator's own.
    """
    return docs.select(F.struct(*(docs[c] for c in docs.columns if c != "text")).alias("row"), *more)


def unpacked(df: DataFrame, docs: DataFrame, **new: str) -> DataFrame:
    """The documents' columns from `row` and `text`; those named in `new` come from SQL expressions."""
    old = {c: F.col("text") if c == "text" else F.col("row").getField(c) for c in docs.columns}
    return df.select(*((F.expr(new[c]).cast(docs.schema[c].dataType) if c in new else old[c]).alias(c) for c in docs.columns))


#: Rows and bytes of an Arrow batch: texts may be long, and a worker holds whole batches.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def in_arrow(df: DataFrame, function, schema: StructType | str) -> DataFrame:
    """mapInArrow over batches of bounded size.

    Spark takes the bounds from the session when the plan runs, so they are set there, and only ever
    lowered.  After its task a worker gives unused Arrow memory back.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = re.match(r"-?\d+", conf.get(key))
        if not now or not 0 < int(now[0]) <= most:
            conf.set(key, str(most))

    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)
