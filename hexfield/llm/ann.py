"""Approximate nearest neighbours by inner product: probed lists, scanned a few dimensions at a time.

Index: k-means centroids of a sample (`SAMPLE` rows at most, chosen by a hash of their ids) make the lists,
`ROWS_PER_LIST` rows of the sample to each and `LISTS` at most; every row goes to its nearest centroid's.
A task holds a block of `BLOCK_ROWS` rows: several lists, or a part of a long one, so a third of all rows in
one list is no hot task.  A query is sent once to each block in which it probes lists.
A query probes the lists in order of its product with their centroids, as many as hold `COVERED` of the
nearest sample rows of sample queries, so unclustered data are probed wider.

Scan: a random rotation makes any few dimensions of a vector a random sample of it.  A list keeps its rotated
rows in blocks of `WIDTH` columns.  With s the product over the first d of D dimensions and t the score that
a candidate must reach (of the query's `NEAREST` best so far the least), the hypothesis that the whole product
is t or more is given up, and the candidate with it, when s lies `SURE` deviations below (d / D) * t; by then
most candidates have cost few columns.  Survivors of all columns are scored exactly on the original vectors,
in double precision.

Each query first meets the best of its lists, `FIRST_ROWS` rows and the list that passes that, and enters
the others with the least score found so far.  It probes as many lists as hold its number of rows at least.

Defined results: rows without id or vector, zero vectors, those with null or non-finite components and those
of another dimension than most take no part; of rows that repeat an id one counts (see `vectors`); fewer
candidates than asked for give all; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import discard, in_arrow, written
from .vectors import matrix, met, packed, scanned

NEAREST = 20
#: Bounds of what the driver fits on: rows and bytes of the sample; lists, and sample rows for each.
SAMPLE = 16_384
SAMPLE_BYTES = 32 << 20
ROWS_PER_LIST = 24
LISTS = 1024
#: Sample queries by which the number of probed lists is set, and the share of neighbours that they must hold.
TRIALS = 256
COVERED = 0.98
ROUNDS = 8
BLOCK_ROWS = 4096
WIDTH = 16
SURE = 2.5
FIRST_ROWS = 1000
#: Queries and rows compared at once; the first rows, which meet no threshold yet, are fewer.
QUERIES, ROWS, FEW = 128, 2048, 256


class Index:
    """Centroids and a rotation, fitted on the sample; of bounded size, so it travels with the tasks."""

    def __init__(self, sample: np.ndarray, dim: int, kind: str):
        rng = np.random.default_rng(1)
        self.dim, self.kind = dim, kind
        x = sample.astype(np.float32)
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0].astype(np.float32)
        lists = max(1, min(LISTS, len(x) // ROWS_PER_LIST))
        centers = x[rng.choice(len(x), lists, replace=False)] if len(x) else np.zeros((1, dim), np.float32)
        self.centers = centers
        for _ in range(ROUNDS if lists > 1 else 0):
            own = self.lists(x)
            sums = np.zeros_like(self.centers)
            np.add.at(sums, own, x)
            count = np.bincount(own, minlength=lists)
            self.centers = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], self.centers)
        self.probes = self._probes(x, rng)

    def lists(self, x: np.ndarray) -> np.ndarray:
        """The list of each row: its nearest centroid's."""
        x = x.astype(np.float32)
        return np.argmax(x @ self.centers.T - (self.centers**2).sum(1) / 2, axis=1)

    def order(self, q: np.ndarray) -> np.ndarray:
        """The lists in the order in which each query probes them."""
        return np.argsort(-(q.astype(np.float32) @ self.centers.T), axis=1, kind="stable")

    def _probes(self, x: np.ndarray, rng: np.random.Generator) -> int:
        if len(x) <= NEAREST + 1:
            return len(self.centers)
        trial = rng.choice(len(x), min(TRIALS, len(x)), replace=False)
        score = x[trial] @ x.T
        score[np.arange(len(trial)), trial] = -np.inf
        near = np.argpartition(-score, NEAREST, axis=1)[:, :NEAREST]
        own, place = self.lists(x), np.argsort(self.order(x[trial]), axis=1)
        ranks = np.sort(place[np.arange(len(trial))[:, None], own[near]].ravel())
        return int(ranks[min(len(ranks) - 1, int(np.ceil(COVERED * len(ranks))))]) + 1


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Places of each query's n best, greatest score first, then smallest id."""
    order = np.lexsort((ids, -score, query))
    new = np.flatnonzero(np.diff(query[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
    return order[rank < n]


def _scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Products row by row in double precision; the same two vectors always give the same number."""
    return (x.astype(np.float64) * q.astype(np.float64)).sum(1)


class Block:
    """Rows of several lists, rotated, in blocks of columns."""

    def __init__(self, table: pa.Table, index: Index):
        order = np.argsort(table["list"].to_numpy(), kind="stable")
        self.lists, self.own = np.unique(table["list"].to_numpy()[order], return_inverse=True)
        self.ids, self.x = table["id"].to_numpy()[order], matrix(table["vec"], index.kind, index.dim)[order]
        turned = self.x.astype(np.float32) @ index.rotation
        self.columns = [np.ascontiguousarray(turned[:, i : i + WIDTH]) for i in range(0, index.dim, WIDTH)]
        self.long = float(table["long"].to_numpy().max())

    def search(self, q: np.ndarray, ids: np.ndarray, probed: np.ndarray, least: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of rows of the probed lists (a row of flags for each query) that may be among
        each query's nearest, given the least score to reach."""
        dim, turned = index.dim, q.astype(np.float32) @ index.rotation
        long = np.sqrt((q.astype(np.float64) ** 2).sum(1))
        least = least.copy()
        of, near, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for i in [0, *range(FEW, len(self.ids), ROWS)]:
            j = min(len(self.ids), i + ROWS if i else FEW)
            known = np.isfinite(least)
            goal = np.where(known, least, 0.0)
            spread = np.sqrt((long * self.long) ** 2 + goal**2)
            for k, block in enumerate(self.columns):
                d = min(dim, (k + 1) * WIDTH)
                share = d / dim
                # of dimensions drawn without replacement; nothing is left to chance once all are in
                limit = np.where(known, share * goal - SURE * np.sqrt(share * (1 - share) / (dim + 2)) * spread - 1e-5 * spread, -np.inf).astype(np.float32)
                if k == 0:
                    s = turned[:, :WIDTH] @ block[i:j].T
                    one, two = np.nonzero((s >= limit[:, None]) & probed[:, self.own[i:j]])
                    s = s[one, two]
                else:
                    s = s + np.einsum("ij,ij->i", turned[one, k * WIDTH : d], block[i + two])
                    stay = s >= limit[one]
                    one, two, s = one[stay], two[stay], s[stay]
            two = two + i
            other = self.ids[two] != ids[one]
            one, two = one[other], two[other]
            of, near, score = np.concatenate([of, one]), np.concatenate([near, self.ids[two]]), np.concatenate([score, _scores(self.x[two], q[one])])
            best = _best(of, near, score, NEAREST)
            of, near, score = of[best], near[best], score[best]
            low = np.full(len(q), np.inf)
            np.minimum.at(low, of, score)
            least = np.where(np.bincount(of, minlength=len(q)) == NEAREST, np.maximum(least, low), least)
        return of, near, score


FOUND = "query_id bigint, vec_id bigint, score double"


def _answer(query: np.ndarray, near: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(query, pa.int64()), pa.array(near, pa.int64()), pa.array(score, pa.float64())], names=[f.split()[0] for f in FOUND.split(", ")])


def _search(index: Index):
    def search(block: Block, queries: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, least = queries.column("id").to_numpy(), queries.column("least").to_numpy()
        q, lists = matrix(queries.column("vec"), index.kind, index.dim), queries.column("lists")
        probed = np.zeros((len(ids), len(block.lists)), bool)
        offs = lists.offsets.to_numpy()
        probed[np.repeat(np.arange(len(ids)), np.diff(offs)), np.searchsorted(block.lists, lists.flatten().to_numpy())] = True
        for i in range(0, len(ids), QUERIES):
            part = slice(i, i + QUERIES)
            of, near, score = block.search(q[part], ids[part], probed[part], least[part], index)
            yield _answer(ids[part][of], near, score)

    return lambda batches: scanned(batches, lambda t: Block(t, index), search)


def _listed(index: Index):
    def run(batches):
        for rows in batches:
            own = index.lists(matrix(rows.column("vec"), index.kind, index.dim)) if len(rows) else np.zeros(0, int)
            yield pa.record_batch([*(rows.column(c) for c in ("id", "vec", "long")), pa.array(own.astype(np.int32))], names=["id", "vec", "long", "list"])

    return run


def dealt(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first block of each list and its number of blocks, from the lists' numbers of rows."""
    first, parts = np.zeros(len(counts), np.int64), np.maximum(1, -(-counts // BLOCK_ROWS))
    block, room = 0, BLOCK_ROWS
    for c, n in enumerate(counts.tolist()):
        if n > room and room < BLOCK_ROWS:
            block, room = block + 1, BLOCK_ROWS
        first[c] = block
        if n > BLOCK_ROWS:
            block += int(parts[c])
        else:
            room -= n
    return first, parts


def _probed(index: Index, counts: np.ndarray, first: np.ndarray, parts: np.ndarray):
    """A row for every block that a query probes lists in, with these lists; the best lists come `early`."""

    def run(batches):
        for rows in batches:
            if not len(rows):
                continue
            order = index.order(matrix(rows.column("vec"), index.kind, index.dim))
            upto = np.cumsum(counts[order], axis=1)
            before = upto - counts[order]
            used = (np.arange(order.shape[1]) < index.probes) | (before < NEAREST + 1)
            one, rank = np.nonzero(used & (counts[order] > 0))
            own, late = order[one, rank], before[one, rank] >= FIRST_ROWS
            many = parts[own]
            block = np.repeat(first[own], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            one, late, own = np.repeat(one, many), np.repeat(late, many), np.repeat(own, many)
            sort = np.lexsort((own, block, late, one))
            one, late, block, own = one[sort], late[sort], block[sort], own[sort]
            head = np.flatnonzero((np.diff(one, prepend=-1) != 0) | (np.diff(late, prepend=False) != 0) | (np.diff(block, prepend=-1) != 0))
            ends = np.append(head, len(own)).astype(np.int32)
            take = pa.array(one[head])
            yield pa.record_batch([pa.array(block[head].astype(np.int32)), rows.column("id").take(take), rows.column("vec").take(take), pa.ListArray.from_arrays(pa.array(ends), pa.array(own.astype(np.int32))), pa.array(~late[head])], names=["block", "id", "vec", "lists", "early"])

    return run


def _top(found: DataFrame) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= NEAREST)


def sampled(rows: DataFrame, n: int, dim: int, kind: str) -> np.ndarray:
    """The vectors of `SAMPLE` rows at most, by a hash of their ids."""
    most = min(SAMPLE, SAMPLE_BYTES // (8 * max(dim, 1)))
    share = min(1.0, most / max(n, 1))
    mark = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30))
    got = rows.filter(mark <= int(share * (1 << 30))).select("id", "vec").limit(2 * most).toPandas().sort_values("id")[:most]
    return matrix(pa.array(got["vec"], pa.binary()), kind, max(dim, 1))


def nearest(vectors: DataFrame, query_every: int = 20, column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the nearest rows of each row whose vec_id is divisible by
    `query_every`, over a frame (vec_id, embedding)."""
    rows, dim, n, kind = packed(vectors, column, zero=False)
    index = Index(sampled(rows, n, dim, kind), max(dim, 1), kind)
    listed = written(in_arrow(rows, _listed(index), "id bigint, vec binary, long double, list int"), "listed")
    counts = np.zeros(len(index.centers), np.int64)
    for r in listed.groupBy("list").count().collect():  # a row for each list
        counts[r["list"]] = r["count"]
    first, parts = dealt(counts)
    places = F.array(*(F.struct(F.lit(int(a)).alias("first"), F.lit(int(b)).alias("parts")) for a, b in zip(first, parts, strict=True)))
    place = F.element_at(places, F.col("list") + 1)
    blocked = listed.select("id", "vec", "long", "list", (place["first"] + F.pmod(F.xxhash64("id"), place["parts"])).cast("int").alias("block"))

    queries = listed.filter(F.col("id") % query_every == 0).select("id", "vec")
    probed = written(in_arrow(queries, _probed(index, counts, first, parts), "block int, id bigint, vec binary, lists array<int>, early boolean"), "probed")
    begun = probed.filter("early").select("block", "id", "vec", "lists", F.lit(float("-inf")).alias("least"))
    best = written(_top(in_arrow(met(blocked, begun), _search(index), FOUND)), "best")
    least = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low")).filter(F.col("n") == NEAREST).select(F.col("query_id").alias("id"), F.col("low").alias("least"))
    later = probed.filter("not early").select("block", "id", "vec", "lists").join(least, "id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    far = in_arrow(met(blocked, later), _search(index), FOUND)
    out = written(_top(best.drop("rank").unionByName(far)), "nearest")
    discard(rows, listed, probed, best)
    return out.select("query_id", "rank", "vec_id", "score")


def op13_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """Every twentieth row against all others."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
