"""Vectors as rows of bytes, and tasks that hold a block of them while query vectors stream past.

Taken as a vector: an array without nulls whose components are all finite, as long as most of the table's
(of equally frequent lengths the greatest).  Other rows, and those without an id, take no part.  Of rows
that repeat an id the one with the least array (then the least label) counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .store import in_arrow, written


def one_of_each_id(df: DataFrame) -> DataFrame:
    """Rows (vec_id, label, v) with one row for each id.  Only where ids repeat is anything but ids shuffled."""
    named = df.filter("vec_id is not null")
    again = written(named.groupBy("vec_id").agg(F.count("*").alias("times")).filter("times > 1").select("vec_id"), "again")
    if not again.take(1):
        return named
    single = named.join(again, "vec_id", "left_anti")
    first = named.join(again, "vec_id").groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("r")).select("vec_id", "r.label", "r.v")
    return single.unionByName(first.select(*single.columns))


def _packed(kind: str, change: Callable[[np.ndarray], np.ndarray] | None, zero: bool):
    def run(batches):
        for batch in batches:
            lists = batch.column("v").cast(pa.large_list(pa.float64()))
            offs = lists.offsets.to_numpy()
            x = lists.values.to_numpy(zero_copy_only=False)[offs[0] : offs[-1]] if len(lists) else np.zeros(0)
            size, offs = np.diff(offs), offs - (offs[0] if len(offs) else 0)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            fine = (bad[offs[1:]] == bad[offs[:-1]]) & (size > 0) & pc.is_valid(batch.column("v")).to_numpy(zero_copy_only=False)
            out = np.where(np.isfinite(x), x, 0.0)
            out = change(out) if change else out
            sums = np.concatenate([[0.0], np.cumsum(out * out)])
            long = np.zeros(len(size))
            for i in np.flatnonzero(fine).tolist():  # cumulated sums lose digits, so each length is its own sum
                long[i] = np.sqrt((out[offs[i] : offs[i + 1]] ** 2).sum()) if sums[-1] > 0 else 0.0
            if not zero:
                fine &= long > 0
            keep = np.flatnonzero(fine)
            raw = out.astype(kind)
            data = [raw[offs[i] : offs[i + 1]].tobytes() for i in keep.tolist()]
            take = pa.array(keep)
            yield pa.record_batch([batch.column("vec_id").take(take), batch.column("label").take(take), pa.array(data, pa.binary()), pa.array(long[keep]), pa.array(size[keep].astype(np.int32))], names=["id", "label", "vec", "long", "dim"])

    return run


def packed(df: DataFrame, column: str, change: Callable[[np.ndarray], np.ndarray] | None = None, kind: str | None = None, zero: bool = True) -> tuple[DataFrame, int, int, str]:
    """Rows (id, label, vec, long, dim) with bytes for vectors and their lengths, written; with them the
    dimension, the number of rows and the bytes' number type."""
    kind = kind or ("<f4" if isinstance(df.schema[column].dataType.elementType, FloatType) else "<f8")
    label = F.col("label").cast("bigint") if "label" in df.columns else F.lit(None).cast("bigint")
    rows = one_of_each_id(df.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), F.col(column).alias("v")))
    vectors = written(in_arrow(rows, _packed(kind, change, zero), "id bigint, label bigint, vec binary, long double, dim int"), "vectors")
    most = vectors.groupBy("dim").agg(F.count("*").alias("n")).agg(F.max(F.struct("n", "dim")).alias("m")).first()["m"]
    n, dim = (most["n"], most["dim"]) if most else (0, 0)
    return vectors.filter(F.col("dim") == dim).drop("dim"), dim, n, kind


def matrix(column: pa.Array | pa.ChunkedArray, kind: str, dim: int) -> np.ndarray:
    """The vectors of a column of bytes, a row each."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def met(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """Rows and queries (block, ...) by block, the rows of each first."""
    both = rows.withColumn("kind", F.lit(0)).unionByName(queries.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition("block").sortWithinPartitions("block", "kind")


def scanned(batches: Iterable[pa.RecordBatch], build: Callable[[pa.Table], object], search: Callable[[object, pa.RecordBatch], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Builds each block from its rows and searches it for its queries, a batch of them at a time."""
    block, held, built = None, [], None
    for batch in batches:
        if not len(batch):
            continue
        b, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
        cut = np.flatnonzero((b[1:] != b[:-1]) | (kind[1:] != kind[:-1])) + 1
        at = [0, *cut.tolist(), len(b)]
        for i, j in zip(at[:-1], at[1:], strict=True):
            part = batch.slice(i, j - i)
            if b[i] != block:
                block, held, built = b[i], [], None
            if kind[i] == 0:
                held.append(part)
                continue
            if held:
                built, held = build(pa.Table.from_batches(held)), []
            if built is not None:
                yield from search(built, part)
