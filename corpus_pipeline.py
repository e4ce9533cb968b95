"""A training-corpus pipeline: quality rules, near duplicates, repeats, benchmark leaks, tokens.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; `run` writes every
stage's result as Parquet to the shared folder and reads it again as the next one's documents.  All
but the last stage return the columns of `documents`.  Every stage works on whatever documents its
predecessor kept; those it leaves alone pass unchanged.

* quality: documents that the quality rules reject go.
* near_duplicates: of each group of linked documents the one of least doc_id stays; rows without a
  doc_id stay.
* repeats: passages that occur anywhere else too (runs of repeated 240-byte strings with 45 words or
  more, so every repeated passage of over 50 words of usual length) are cut from the text, wherever
  they stand; rows stay, even if their text becomes empty, and n_chars is brought up to date.
* decontamination: benchmark spans are cut from the text; a document of whose words more than half
  are hit goes as a whole.
* tokens: doc_id with n_tokens, ids_sha256 and decoded_sha256 of every document left.

An empty table passes through all stages; nulls and repeated rows are treated as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hexfield.llm import bpe, decontaminate, near_duplicates, quality, repeats
from hexfield.llm.store import written

#: SQL cannot express the stages (tokenisers, shingle components); tests hold them against brute force.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules."""
    return quality.keep_good(docs, public_tokenizers.path("piece_bpe_32k.model"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join."""
    return near_duplicates.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup."""
    return repeats.without_passages(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding."""
    return bpe.digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", keep_good), ("near_duplicates", one_of_each), ("repeats", without_repeats), ("decontamination", without_leaks), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
