"""Token counts through a digest cache.

A text is known by the SHA-256 of its normalised content (null counts as empty; nothing else may be
normalised, since the counts are those of the whole text) together with a digest of the tokenizer's
file.  Counts already stored under both digests are joined; each distinct text that is missing is
encoded once, and its count is appended to the cache.

The cache may hold an entry twice (two runs that add to it at once, a task that ran again): readers see
one count for each pair of digests, which are all alike, so no document is multiplied.  Files are added
by Spark's commit, whole or not at all.

Defined results: null and empty texts have 0 bytes and 0 tokens and share one cache entry; repeated
rows and copies of a text are encoded once and each answered; an empty table gives an empty result;
extra columns are not read.  `doc_id` may be null.
"""

from __future__ import annotations

import hashlib
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import in_arrow, table_path, written
from .text import chunks

CACHE_SCHEMA = "version string, digest string, n_tokens bigint"
MAX_TOKENS = 4096


@cache
def _counter(model: str):
    """A function from texts to token counts; each Python worker loads a tokenizer once."""
    if model.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(model)
        t.no_truncation()
        t.no_padding()
        return lambda texts: [len(t.encode(x, add_special_tokens=False)) for x in texts]
    from sentencepiece import SentencePieceProcessor

    s = SentencePieceProcessor(model_file=model)
    return lambda texts: [len(x) for x in s.encode(texts, num_threads=1)]


def version_of(model: str) -> str:
    """Digest of the tokenizer file."""
    return hashlib.sha256(Path(model).read_bytes()).hexdigest()


def _encode(model: str, version: str):
    def run(batches):
        done: set[str] = set()  # rows that repeat both id and text mostly meet in one task
        for rows, _, _ in chunks(batches):
            new = {d: t or "" for d, t in zip(rows.column("digest").to_pylist(), rows.column("text").to_pylist(), strict=True) if d not in done}
            done |= new.keys()
            yield pa.record_batch([pa.array([version] * len(new), pa.string()), pa.array(list(new), pa.string()), pa.array(_counter(model)(list(new.values())) if new else [], pa.int64())], names=["version", "digest", "n_tokens"])

    return run


def stored_counts(spark: SparkSession, path: str, version: str) -> DataFrame:
    """digest and n_tokens of a tokenizer version, each digest once."""
    stored = spark.read.schema(CACHE_SCHEMA).parquet(path).filter(F.col("version") == version)
    return stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, model: str, cache_path: str | None = None) -> DataFrame:
    """doc_id, digest, n_bytes and n_tokens of every row; distinct texts that miss join the cache.

    `cache_path` names the stored counts (created when absent); without one the cache starts empty
    in the shared folder.  The texts move once, keyed by document, so copies spread over all tasks.
    """
    spark = docs.sparkSession
    path = cache_path or table_path(spark, "token_counts")
    version = version_of(model)
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    first = keyed.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    misses = first.join(stored_counts(spark, path, version), "digest", "left_anti").hint("shuffle_hash")
    texts = docs.select("doc_id", text.alias("text"), F.sha2(text, 256).alias("key"))
    missing = texts.join(misses, (F.col("key") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("first_id")))
    in_arrow(missing.select("digest", "text"), _encode(model, version), CACHE_SCHEMA).write.mode("append").parquet(path)
    # written first: a join right above the aggregation could not split a digest that many rows share
    return keyed.join(written(stored_counts(spark, path, version), "counts"), "digest")


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    """Every document under the 32k piece vocabulary."""
    import public_tokenizers

    counts = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"))
