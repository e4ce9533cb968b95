"""Quality rules by tokeniser fertility.

Every document gets word statistics and, from a public vocabulary applied to its words, characters
per token, the share of byte-fallback tokens and the entropy of its tokens (as a share of the most
that so many tokens can have).  A document is rejected when its words fail the base rule or when a
measure leaves the band of its language.

Defined results: null and empty texts have no words and fail the base rule; languages without bands
of their own, null included, use the default bands; repeated rows are each answered; extra columns
are carried by `keep_good` and cannot clash.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import extended, free, in_arrow, packed, unpacked
from .text import BYTE, SPACE, chunks, grams, mix, per_row, prefix, ragged, runs, span_hash, table

SYMBOL = table(b"#*$%&|<>")
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Words kept with their tokens by one Python worker; a full store is emptied.
MAX_STORED_WORDS = 100_000

#: Bands by language: the usual characters per token with the tolerances below and above it, the most
#: byte-fallback share, the least relative entropy.  The lower limits lie under the test tables' invented
#: prose (1.9 to 2.3 under the 32k piece vocabulary) and so under real prose (2.7 to 4.7).  The upper
#: limit is what the vocabulary allows on prose: a word takes one token at least, so characters per
#: token never exceed the mean word length, 5 to 6 in prose of these languages, and 7.6 were measured on
#: English of 12 letters a word.  Pass other bands for other corpora or vocabularies.
DEFAULT_BAND = {"usual": 3.0, "below": 2.2, "above": 5.0, "byte_share": 0.25, "entropy": 0.2}
BANDS = {
    "en": DEFAULT_BAND | {"usual": 2.21, "below": 0.06, "above": 5.79},
    "de": DEFAULT_BAND | {"usual": 2.235, "below": 0.06, "above": 5.765},
    "es": DEFAULT_BAND | {"usual": 1.94, "below": 0.06, "above": 6.06},
    "fr": DEFAULT_BAND | {"usual": 1.99, "below": 0.06, "above": 6.01},
}
#: A text's own mean strays from its language's by about 1 / sqrt(tokens); so much of it is allowed.
STRAY = 4.0

MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_tokens bigint, chars_per_token double, byte_share double, entropy double"


class Pieces:
    """The vocabulary's tokens of words, stored once for each word that a worker meets."""

    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.clear()

    def clear(self) -> None:
        self.index: dict[int, int] = {}
        self.length = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def of(self, hashes: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Store places of distinct words, given by hash and by a span of the raw bytes."""
        if len(self.index) > MAX_STORED_WORDS:
            self.clear()
        keys = hashes.tolist()
        new = [i for i, h in enumerate(keys) if h not in self.index]
        if new:
            ids = self.model.encode([raw[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)], num_threads=1)
            length = np.array([len(x) for x in ids], np.int64)
            for n, i in enumerate(new, len(self.index)):
                self.index[keys[i]] = n
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(length) - length])
            self.length = np.concatenate([self.length, length])
            self.ids = np.concatenate([self.ids, np.fromiter((t for x in ids for t in x), np.int32, int(length.sum()))])
        return np.array([self.index[h] for h in keys], np.int64)


@cache
def _pieces(model: str) -> Pieces:
    return Pieces(model)


def _dup_lines(buf: np.ndarray, offs: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    rows = len(offs) - 1
    nl = np.flatnonzero(buf == 10)
    start, end = np.sort(np.concatenate([offs[:-1], nl + 1])), np.sort(np.concatenate([nl, offs[1:]]))
    row = np.repeat(np.arange(rows), np.diff(np.searchsorted(nl, offs)) + 1)
    marks = np.concatenate([[0], np.cumsum(filled)])
    used = marks[end] > marks[start]
    start, end, row = start[used], end[used], row[used]
    key = mix(span_hash(prefix(BYTE[buf]), start, end) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(key, return_index=True)
    return np.bincount(row, minlength=rows) - np.bincount(row[at], minlength=rows)


def _repeat_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words of each row in windows that the row has twice or more."""
    key, at = grams(hashes, first, REPEAT_WINDOW)
    row = np.searchsorted(first, at, "right") - 1
    _, inverse, count = np.unique(mix(key + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    twice = at[count[inverse] > 1]
    cover = np.bincount(twice, minlength=len(hashes) + 1) - np.bincount(twice + REPEAT_WINDOW, minlength=len(hashes) + 1)
    return per_row((np.cumsum(cover[: len(hashes)]) > 0).astype(np.int64), first)


def _tokens(store: Pieces, buf: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, byte-fallback tokens and entropy in bits of each row."""
    rows = len(first) - 1
    _, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    place = store.of(hashes[at], buf.tobytes(), start[at], end[at])
    row = np.repeat(np.arange(rows), np.diff(first))
    pair, times = np.unique(row * max(1, len(at)) + inverse, return_counts=True)
    row, word = pair // max(1, len(at)), place[pair % max(1, len(at))]
    size = store.length[word]
    ids = store.ids[ragged(store.start[word], size)]
    row, times = np.repeat(row, size), np.repeat(times, size)
    vocabulary = len(store.is_byte)
    key = row * vocabulary + ids
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    cut = np.flatnonzero(np.diff(key, prepend=-1))
    count = np.add.reduceat(times, cut) if len(cut) else np.zeros(0, np.int64)
    row, ids = key[cut] // vocabulary, key[cut] % vocabulary
    total = np.bincount(row, count, rows)
    spread = np.bincount(row, count * np.log2(np.maximum(count, 1)), rows)
    entropy = np.where(total > 0, np.log2(np.maximum(total, 1)) - spread / np.maximum(total, 1), 0.0)
    return total.astype(np.int64), np.bincount(row, count * store.is_byte[ids], rows), entropy


def _measure(model: str):
    def run(batches):
        for rows, buf, offs in chunks(batches):
            filled = ~SPACE[buf]
            start, end = runs(filled, offs)
            first = np.searchsorted(start, offs)
            hashes = span_hash(prefix(BYTE[buf]), start, end)
            chars = per_row((filled & ((buf & 0xC0) != 0x80)).astype(np.int64), offs)
            total, raw, entropy = _tokens(_pieces(model), buf, start, end, hashes, first)
            some = np.maximum(total, 1)
            columns = [np.diff(first), chars, per_row(SYMBOL[buf].astype(np.int64), offs), _dup_lines(buf, offs, filled), _repeat_words(hashes, first), total, chars / some, raw / some, np.where(total > 1, entropy / np.log2(np.maximum(total, 2)), 1.0)]
            types = [pa.int64()] * 6 + [pa.float64()] * 3
            yield pa.record_batch([*(rows.column(c) for c in rows.schema.names), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=[*rows.schema.names, *(f.split()[0] for f in MEASURES.split(", "))])

    return run


def measure(docs: DataFrame, model: str) -> DataFrame:
    """The frame's columns (`text` among them; those named as a measure are replaced) with the measures; no shuffle."""
    docs = free(docs, MEASURES)
    return in_arrow(docs, _measure(model), extended(docs, MEASURES))


def verdict(measures: DataFrame, bands: dict[str, dict] = BANDS, default: dict = DEFAULT_BAND) -> DataFrame:
    """Adds base_failed and kept to measures that carry `lang`."""

    def of(name: str) -> Column:
        out = F.lit(float(default[name]))
        for lang, band in bands.items():
            out = F.when(F.col("lang") == lang, F.lit(float(band[name]))).otherwise(out)
        return out

    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    stray = STRAY / F.sqrt(F.greatest("n_tokens", F.lit(1)))
    fertile = F.col("chars_per_token").between(of("usual") - of("below") - stray, of("usual") + of("above") + stray)
    inside = fertile & (F.col("byte_share") <= of("byte_share")) & (F.col("entropy") >= of("entropy"))
    return measures.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & inside)


def keep_good(docs: DataFrame, model: str) -> DataFrame:
    """The documents that pass, with their own columns."""
    return unpacked(verdict(measure(packed(docs, "lang", "text"), model)).filter("kept"), docs)


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document under the 32k piece vocabulary."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    found = verdict(measure(docs, public_tokenizers.path("piece_bpe_32k.model")))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_tokens", "chars_per_token", "byte_share", "entropy")
