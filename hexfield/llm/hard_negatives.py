"""Hard negatives by coordinate pruning in length buckets.

Rows are cut into buckets of like length (each `RATIO` times the one below), and these into blocks of
bounded size by a hash of their ids.  A block holds, for every coordinate, its rows sorted by that
coordinate of their directions.  An anchor with direction q that looks for scores of at least t in a
block of greatest length b needs a cosine of at least c = t / (|anchor| * b): without one the block is
skipped.  Else, for each of its `FOCUS` largest coordinates q_f, a row's p_f must lie where
q_f * p_f + sqrt(1 - q_f**2) * sqrt(1 - p_f**2) >= c: two bounds, found in the sorted list.  Rows inside
all ranges are candidates; a bound on all focus coordinates together thins them, and what is left is scored
exactly.  Where ranges exclude nothing every row of the block is scored, so results are exact always.

1. Positives: in each block the first `POSITIVES` of an anchor's label, whose last score raises t as it
   goes; the blocks' findings are ranked.
2. Negatives: t is 80 % of the least positive score; in each block the first `NEGATIVES` for each positive.

Scores are integers: components count as floor(256 * x), limited to 2**26 either way, so that sums stay
within 64 bits.  Every anchor meets every block it may have a hit in, a third of all rows in one bucket or
under one label among them; a task holds one block, and anchors stream past it.

Defined results: rows without id, label or vector, with a null or non-finite component or another
dimension than most rows take no part; of rows that repeat an id one counts (see `vectors`); zero vectors
score 0; an empty table, or anchors without positives or negatives, give no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import discard, in_arrow, written
from .vectors import matrix, met, packed, scanned

POSITIVES = 5
NEGATIVES = 5
LEAST_PERCENT = 80
SCALE = 256
MOST = 1 << 26
RATIO = 1.25
FOCUS = 6
#: Bytes of a block's vectors at most, rows of one at least, and blocks that a table has at least where it can.
BLOCK_BYTES = 16 << 20
BLOCK_ROWS = 2048
BLOCKS = 64
#: Rows scored before the rest, for a first threshold.
SEEDS = 64
#: Room for rounding in the bounds, which are computed in floating point.
SLACK = 1e-5


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(256 * x), limited."""
    return np.clip(np.floor(SCALE * x), -MOST, MOST)


class Block:
    """Rows of like length with their sorted coordinate lists."""

    def __init__(self, table: pa.Table, dim: int):
        ids = table["id"].to_numpy()
        label = table["label"].to_numpy()
        order = np.lexsort((ids, label))
        self.ids, self.label = ids[order], label[order]
        self.ints = matrix(table["vec"], "<i4", dim)[order]
        self.most = int(np.abs(self.ints).max(initial=0))
        self.single, self.double = self.ints.astype(np.float32), None
        self.long = table["long"].to_numpy()[order]
        self.top = float(self.long.max())
        self.unit = self.ints / np.maximum(self.long, 1e-300)[:, None]
        self.by = np.argsort(self.unit, axis=0)
        self.sorted = np.ascontiguousarray(np.take_along_axis(self.unit, self.by, 0).T)

    def scores(self, at: np.ndarray | slice, q: np.ndarray) -> np.ndarray:
        """Exact integer inner products of the rows with a query."""
        room = self.most * int(np.abs(q).max(initial=0)) * len(q)
        if room < 1 << 24:
            return (self.single[at] @ q.astype(np.float32)).astype(np.int64)
        if room < 1 << 53:
            if self.double is None:
                self.double = self.ints.astype(np.float64)
            return (self.double[at] @ q.astype(np.float64)).astype(np.int64)
        return (self.ints[at].astype(np.int64) * q.astype(np.int64)).sum(1)

    def candidates(self, q: np.ndarray, long: float, least: float) -> np.ndarray | None:
        """Rows that may score `least` or more with a query; None for all of them."""
        if least <= 0:
            return None
        cosine = least / (long * self.top) if long * self.top > 0 else np.inf
        if cosine > 1 + SLACK:
            return np.zeros(0, np.int64)
        cosine = min(1.0, cosine)
        unit = q / long
        focus = np.argsort(-np.abs(unit))[:FOCUS]
        wide = np.arccos(cosine)
        hits, used = np.zeros(len(self.ids), np.int8), 0
        for f in focus.tolist():
            angle = np.arccos(np.clip(unit[f], -1, 1))
            low = np.cos(min(np.pi, angle + wide)) - SLACK
            high = np.cos(max(0.0, angle - wide)) + SLACK
            i, j = np.searchsorted(self.sorted[f], [low, high])
            if j - i < len(hits):
                hits[self.by[i:j, f]] += 1
                used += 1
        found = np.flatnonzero(hits == used) if used else np.arange(len(hits))
        part, rest = self.unit[found][:, focus], max(0.0, 1 - float((unit[focus] ** 2).sum()))
        bound = part @ unit[focus] + np.sqrt(rest * np.maximum(0.0, 1 - (part * part).sum(1)))
        return found[bound * self.long[found] * long >= least - SLACK * self.top * long - SLACK]


def _first(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, smaller ids first among equals."""
    if len(score) > 4 * n:
        cut = np.partition(score, len(score) - n)[len(score) - n]
        some = np.flatnonzero(score >= cut)
        return some[np.lexsort((ids[some], -score[some]))[:n]]
    return np.lexsort((ids, -score))[:n]


def _positives(dim: int):
    def search(block: Block, anchors: pa.RecordBatch):
        out: list[tuple] = []
        vectors = matrix(anchors.column("vec"), "<i4", dim)
        for own, label, long, q in zip(anchors.column("id").to_pylist(), anchors.column("label").to_pylist(), anchors.column("long").to_pylist(), vectors, strict=True):
            a, b = np.searchsorted(block.label, [label, label + 1]).tolist()
            if a == b:
                continue
            at = np.arange(a, min(b, a + SEEDS))
            if b - a > SEEDS:
                seeds = block.scores(at, q)[block.ids[at] != own]
                least = float(np.sort(seeds)[-POSITIVES]) if len(seeds) >= POSITIVES else -np.inf
                found = block.candidates(q, long, least)
                at = np.arange(a, b) if found is None else found[(found >= a) & (found < b)]
            at = at[block.ids[at] != own]
            score = block.scores(at, q)
            best = _first(score, block.ids[at], POSITIVES)
            out += zip([own] * len(best), block.ids[at[best]].tolist(), score[best].tolist(), strict=True)
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "positive_id", "positive_score"])

    return lambda batches: scanned(batches, lambda t: Block(t, dim), search)


def _negatives(dim: int):
    def search(block: Block, anchors: pa.RecordBatch):
        out: list[tuple] = []
        vectors = matrix(anchors.column("vec"), "<i4", dim)
        for own, label, long, positives, q in zip(anchors.column("id").to_pylist(), anchors.column("label").to_pylist(), anchors.column("long").to_pylist(), anchors.column("positives").to_pylist(), vectors, strict=True):
            least = -(-LEAST_PERCENT * min(p["positive_score"] for p in positives) // 100)
            found = block.candidates(q, long, least)
            at = np.arange(len(block.ids)) if found is None else found
            at = at[block.label[at] != label]
            score = block.scores(at, q)
            some = score >= least
            at, score = at[some], score[some]
            order = np.lexsort((block.ids[at], -score))
            at, score = at[order], score[order]
            for p in positives:
                i = int(np.searchsorted(-score, -p["positive_score"]))
                for k in range(i, min(i + NEGATIVES, len(at))):
                    if LEAST_PERCENT * p["positive_score"] > 100 * int(score[k]):
                        break
                    out.append((own, p["positive_id"], p["positive_score"], int(block.ids[at[k]]), int(score[k])))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return lambda batches: scanned(batches, lambda t: Block(t, dim), search)


def _ranked(df: DataFrame, by: list[str], score: str, key: str, n: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), key)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(vectors: DataFrame, anchor_every: int = 100, column: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score, for the anchors whose
    vec_id is divisible by `anchor_every`, over a frame (vec_id, label, embedding)."""
    rows, dim, n, _ = packed(vectors.filter("label is not null"), column, scaled, "<i4")
    bucket = F.when(F.col("long") < 1, -1).otherwise(F.floor(F.log("long") / float(np.log(RATIO)))).cast("int")
    rows = rows.withColumn("bucket", bucket)
    size = max(BLOCK_ROWS, min(BLOCK_BYTES // (4 * max(dim, 1)), -(-n // BLOCKS)))
    # lengths lie between 1 and 2**26 * sqrt(dimension), so there are some hundred buckets at most
    counts = sorted((r.bucket, r["count"], r.top) for r in rows.groupBy("bucket").agg(F.count("*").alias("count"), F.max("long").alias("top")).collect())
    first, parts, at = {}, {}, 0
    for b, count, _top in counts:
        first[b], parts[b] = at, -(-count // size)
        at += parts[b]
    of = lambda table: F.element_at(F.create_map(*(F.lit(x) for kv in (table or {-1: 1}).items() for x in kv)), F.col("bucket"))
    blocked = rows.select("id", "label", "vec", "long", (of(first) + F.pmod(F.xxhash64("id"), of(parts))).cast("int").alias("block"))
    anchors = rows.filter(F.col("id") % anchor_every == 0).select("id", "label", "vec", "long")

    everywhere = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(at - 1, 0)))))
    near = in_arrow(met(blocked, everywhere), _positives(dim), "anchor_id bigint, positive_id bigint, positive_score bigint")
    positives = written(_ranked(near, ["anchor_id"], "positive_score", "positive_id", POSITIVES), "positives")

    lists = positives.filter("positive_score >= 0").groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"), F.min("positive_score").alias("least"))
    asking = anchors.join(lists, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    # blocks whose longest row can't reach the threshold are left out before anything is sent
    tops = F.array(*(F.struct(F.lit(first[b]).alias("first"), F.lit(parts[b]).alias("parts"), F.lit(float(top)).alias("top")) for b, _, top in counts)) if counts else F.array().cast("array<struct<first:int,parts:int,top:double>>")
    reach = F.filter(tops, lambda t: F.col("long") * t["top"] * (1 + SLACK) + SLACK >= LEAST_PERCENT / 100 * F.col("least"))
    spread = asking.withColumn("block", F.explode(F.flatten(F.transform(reach, lambda t: F.sequence(t["first"], t["first"] + t["parts"] - 1))))).drop("least")
    found = in_arrow(met(blocked, spread), _negatives(dim), "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    out = written(_ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", NEGATIVES), "negatives")
    discard(positives, rows)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Every hundredth row against the whole table; every seventh label is shifted by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", shifted))


OP11_SQL = """WITH r AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score FROM r a JOIN r b ON a.id % 100 = 0 AND a.id <> b.id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""
