"""Toxicity by a subword bag: character n-gram embeddings averaged into a linear softmax.

Words (punctuation and white space end them) give their character n-grams of 3 to 5 bytes, the word's
edges included, so an unseen misspelling shares most vectors with the word it misspells.  n-grams
share hashed vectors; a text's vector is the mean of its n-grams' vectors, and a softmax over two
classes reads it.  Vectors and softmax are trained jointly, in numpy, on a bounded sample of labelled
rows.  Scoring runs over all texts inside Arrow tasks: the model's logit is a mean over n-grams of one
number per vector, so a task needs nothing but that table.

Defined results: null and empty texts have no n-grams and get the score of the bias alone; without
labelled rows of both classes every score is the share of toxic labels (0 without labels); repeated
rows are each answered; an id that is labelled twice is toxic if any of its labels says so, one that has
several texts is learnt by the least of them; a null doc_id is never used for learning; extra columns are
carried by `score`, which replaces one of that name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import extended, free, in_arrow
from .text import BYTE, chunks, per_row, prefix, span_hash, table

SIZES = (3, 4, 5)
BUCKET_BITS = 17
WIDTH = 8
#: Labelled rows of each class that training reads at most (those least by a hash of doc_id), and the
#: bytes that their texts have at most together.
SAMPLE_PER_CLASS = 1500
SAMPLE_BYTES = 16 << 20
STEPS = 120
RATE = 0.1
DECAY = 1e-6
#: Buckets met in fewer training rows say nothing reliable; their vectors stay zero.
MIN_ROWS = 4

LETTER = table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
FOLD = np.where(LETTER, np.arange(256), 0x20).astype(np.uint8)
FOLD[65:91] += 32


def subwords(buf: np.ndarray, offs: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For each n-gram size the n-grams' places and buckets, and the rows' bounds of places."""
    rows = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    padded = np.full(len(buf) + len(offs), 0x20, np.uint8)  # a space before, between and after the texts
    padded[np.arange(len(buf)) + rows + 1] = FOLD[buf]
    bounds = offs + np.arange(len(offs))
    sums, inner = prefix(BYTE[padded]), padded != 0x20
    found = []
    middle = inner[1:-1]
    for n in SIZES:
        if len(padded) < n:
            continue
        ok = middle[: len(padded) - n + 1].copy()
        for k in range(2, n - 1):
            ok &= inner[k : len(padded) - n + 1 + k]
        at = np.flatnonzero(ok)
        found.append((at, (span_hash(sums, at, at + n) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)))
    return found, bounds


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and share of the row's n-grams, for training."""
    out = []
    base = 0
    for rows, buf, offs in chunks([pa.record_batch({"text": pa.array(texts, pa.string())})], limit=1 << 20):
        found, bounds = subwords(buf, offs)
        row = np.concatenate([np.searchsorted(bounds, at, "right") - 1 for at, _ in found])
        key, count = np.unique((row << BUCKET_BITS) | np.concatenate([b for _, b in found]), return_counts=True)
        row = key >> BUCKET_BITS
        total = np.bincount(row, count, len(rows))
        out.append(((row + base).astype(np.int32), (key & ((1 << BUCKET_BITS) - 1)).astype(np.int32), (count / total[row]).astype(np.float32)))
        base += len(rows)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32))


def train(texts: list[str | None], labels: np.ndarray, weights: np.ndarray, steps: int = STEPS, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, softmax weights and biases; Adam over all rows at once.

    Of a softmax over two classes only the difference matters to the loss, so the gradient of a
    vector is the softmax's difference times one number per bucket: no row's vector is ever formed.
    """
    row, bucket, share = features(texts)
    rng = np.random.default_rng(seed)
    known = np.bincount(bucket, minlength=1 << BUCKET_BITS) >= MIN_ROWS
    vectors = rng.normal(0, 0.1, (1 << BUCKET_BITS, WIDTH)).astype(np.float32) * known[:, None]
    softmax = rng.normal(0, 1, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, softmax, bias)]
    weights = weights / weights.sum()
    for step in range(1, steps + 1):
        way = softmax[:, 1] - softmax[:, 0]
        logit = np.bincount(row, share * (vectors @ way)[bucket], len(texts)) + (bias[1] - bias[0])
        off = (weights * (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - labels)).astype(np.float32)
        pull = (np.bincount(bucket, share * off[row], 1 << BUCKET_BITS) * known).astype(np.float32)
        side = vectors.T @ pull
        slopes = (np.outer(pull, way) + DECAY * vectors, np.stack([-side, side], 1), np.array([-off.sum(), off.sum()], np.float32))
        for p, g, m in zip((vectors, softmax, bias), slopes, moments, strict=True):
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.01 * (g * g - m[1])
            p -= RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-9)
    return vectors, softmax, bias


def _score(model):
    def run(batches):
        values, bias = model.value
        for rows, buf, offs in chunks(batches, limit=1 << 20):
            found, bounds = subwords(buf, offs)
            total, count = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
            for at, bucket in found:
                first = np.searchsorted(at, bounds)
                sums = np.concatenate([[0.0], np.cumsum(values[bucket])])
                total += sums[first[1:]] - sums[first[:-1]]
                count += np.diff(first)
            logit = total / np.maximum(count, 1) + bias
            yield pa.record_batch([*(rows.column(c) for c in rows.schema.names), pa.array(1 / (1 + np.exp(-np.clip(logit, -60, 60))))], names=[*rows.schema.names, "score"])

    return run


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, most_bytes: int = SAMPLE_BYTES):
    """(one number per bucket, bias), learnt from at most `per_class` labelled rows of each class whose
    texts have at most `most_bytes` in all: what the driver gathers is bounded by these two."""
    named = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in named.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        p = min(max(counts.get(1, 0) / max(1, total), 1e-9), 1 - 1e-9)
        return np.zeros(1 << BUCKET_BITS), float(np.log(p / (1 - p)))
    order = F.xxhash64("doc_id")
    chosen = [named.filter(F.col("toxic") == c).orderBy(order, "doc_id").limit(per_class) for c in (0, 1)]
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
    texts = texts.groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    size = F.sum(F.octet_length("text")).over(Window.partitionBy("toxic").orderBy(order, "doc_id"))  # over the sample alone
    rows = texts.withColumn("size", size).filter(F.col("size") <= most_bytes // 2).select("text", "toxic").collect()
    y = np.array([r["toxic"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        p = counts[1] / total
        return np.zeros(1 << BUCKET_BITS), float(np.log(p / (1 - p)))
    weights = np.where(y == 1, counts[1] / y.sum(), counts[0] / (1 - y).sum())
    vectors, softmax, bias = train([r["text"] for r in rows], y, weights)
    return vectors.astype(float) @ (softmax[:, 1] - softmax[:, 0]).astype(float), float(bias[1] - bias[0])


def score(docs: DataFrame, model) -> DataFrame:
    """The frame's columns (`text` among them) with the score."""
    docs = free(docs, "score double")
    return in_arrow(docs, _score(docs.sparkSession.sparkContext.broadcast(model)), extended(docs, "score double"))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document; learnt from the labelled rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5) == 0
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out))
    return score(docs.withColumn("held_out", F.coalesce(held_out, F.lit(False))), model).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
