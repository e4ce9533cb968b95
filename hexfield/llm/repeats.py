"""Suffix-array dedup by prefix-free parsing.

Rolling-hash triggers cut every text into overlapping phrases: each window of `length` bytes belongs
to the trigger that is the (leftmost) least `TRIGGER`-byte hash inside it, and the windows that
follow one another under the same trigger make one phrase.  The cut depends on nothing but a
window's own bytes, so equal windows lie at the same distance from triggers with the same bytes.

* The parse is the table of phrase occurrences; the dictionary holds each distinct phrase once.
* A phrase that occurs twice repeats all its windows: the parse alone decides that.
* Of the other phrases, only those whose trigger is shared go on.  Their suffixes are the windows,
  told apart by their distance to the trigger; what is wanted of the corpus order is which of them
  stand beside one with a common prefix of `length` bytes.  The order is refined from above, for
  ranges of 64, of 8 and of 1 neighbouring suffixes.  The bytes that all suffixes of a range have in
  common are its core, those that they cover together its whole.  Ranges with equal wholes hold equal
  suffixes and are settled; a range whose core stands alone holds none that occurs elsewhere; only
  ranges that share their core with a different whole are cut into finer ones, one representative
  for each whole.  Counts of the parse go with them.

A phrase makes a few rows at each step, however many phrases share its trigger, and every grouping
is one that is combined before the shuffle: there is no block that a task must hold.  Suffixes are
never written out one by one, and no order beyond `length` bytes is made.

Names are 64-bit fingerprints: phrases are compared under the same 64-bit trigger, wholes under the
same 64-bit core; bytes are not compared again.

Defined results: null counts as an empty text; texts below `length` bytes have no windows; rows that
repeat both id and text are copies of each other; `doc_id` may be null; a window covers its bytes
even where its occurrences overlap.  Extra columns are carried and cannot clash.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, extended, in_arrow, packed, unpacked, written
from .text import BYTE, SPACE, chunks, mix, prefix, ragged, runs, span_hash, window_hash

LENGTH = 400
TRIGGER = 32
#: A passage: a run of repeated windows of so many bytes with so many words at least.  Passages of more
#: than 50 words are meant; a few words at their edges may differ.
PASSAGE_BYTES = 240
PASSAGE_WORDS = 45
#: Suffixes that a range holds, step by step.
STEPS = (64, 8, 1)

KEY = ["doc_id", "tag", "base"]
PHRASES = "trigger bigint, phrase bigint, doc_id bigint, tag bigint, base int, start int, o int, n int, times int"
HIGH = np.uint64(0xFFFFFFFF00000000)


def _names(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


def _triggers(buf: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The rolling hashes, and for each window of the buffer the place of its trigger."""
    rolling = window_hash(BYTE[buf], TRIGGER.bit_length() - 1)
    least = (rolling & HIGH) | np.arange(len(rolling), dtype=np.uint64)
    width, step = length - TRIGGER + 1, 1
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
    return rolling, (least & ~HIGH).astype(np.int64)


def _parse(length: int):
    def run(batches):
        for rows, buf, offs in chunks(batches):
            if len(buf) < length:
                continue
            sums = prefix(BYTE[buf])
            rolling, trigger = _triggers(buf, length)
            inside = np.zeros(len(buf) + 1, np.int8)
            long = np.diff(offs) >= length
            np.add.at(inside, offs[:-1][long], 1)
            np.add.at(inside, offs[1:][long] - length + 1, -1)
            trigger = np.where(np.cumsum(inside[: len(trigger)]) > 0, trigger, -1)
            first = np.flatnonzero(np.diff(trigger, prepend=-2) != 0)
            last = np.append(first[1:], len(trigger))
            row = np.searchsorted(offs, first, "right") - 1
            used = trigger[first] >= 0
            first, last, row = first[used], last[used], row[used]
            name, phrase = rolling[trigger[first]].view(np.int64), span_hash(sums, first, last - 1 + length).view(np.int64)
            # in periodic text the same phrase follows itself: one row tells how often
            new = np.ones(len(first), bool)
            new[1:] = (name[1:] != name[:-1]) | (phrase[1:] != phrase[:-1]) | (row[1:] != row[:-1]) | (first[1:] != last[:-1])
            head = np.flatnonzero(new)
            times = np.diff(np.append(head, len(first)))
            first, last, row, name, phrase = (x[head] for x in (first, last, row, name, phrase))
            key = [rows.column(c).take(pa.array(row)) for c in KEY]
            start = first - offs[row] + key[2].to_numpy()
            numbers = [pa.array(x.astype(np.int32)) for x in (start, trigger[first] - first, last - first, times)]
            yield pa.record_batch([pa.array(name), pa.array(phrase), *key, *numbers], names=_names(PHRASES))

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows known by id and a hash of the text: ids alone may repeat."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tag"), F.lit(0).alias("base"), "text")


DICTIONARY = "doc_id bigint, tag bigint, trigger bigint, phrase bigint, occurs bigint, at int, o int, n int, data binary"


def _slices(length: int):
    """The bytes of dictionary phrases, from the texts where each one first occurs."""

    def run(batches):
        for rows, buf, offs in chunks(batches):
            places = rows.column("places")
            flat = places.flatten()
            row = np.repeat(np.arange(len(rows)), np.diff(places.offsets.to_numpy()))
            start, n = flat.field("start").to_numpy(), flat.field("n").to_numpy()
            begin = offs[row] + start - rows.column("base").to_numpy()[row]
            raw = buf.tobytes()
            data = [raw[a:b] for a, b in zip(begin.tolist(), (begin + n - 1 + length).tolist(), strict=True)]
            take = pa.array(row)
            at = pa.array((start + flat.field("o").to_numpy()).astype(np.int32))
            yield pa.record_batch([rows.column("doc_id").take(take), rows.column("tag").take(take), *(flat.field(c) for c in ("trigger", "phrase", "occurs")), at, flat.field("o"), flat.field("n"), pa.array(data, pa.binary())], names=_names(DICTIONARY))

    return run


RANGES = "core bigint, whole bigint, trigger bigint, phrase bigint, k int, l int, h int, occurs bigint, doc_id bigint, tag bigint, at int"


def _ranges(length: int, step: int, parent: int | None):
    """The ranges of `step` suffixes of each phrase, or those inside the open ranges of `parent` ones.

    A suffix is known by the distance from its first byte to the trigger; range k holds the distances
    from k * step on.  A phrase has those from o down to o - n + 1.
    """

    def run(batches):
        for rows, buf, offs in chunks(batches, column="data"):
            high = rows.column("o").to_numpy().astype(np.int64)
            low = high - rows.column("n").to_numpy() + 1
            if parent is None:
                first, last = low // step, high // step
                row, occurs = np.arange(len(rows)), rows.column("occurs").to_numpy()
            else:
                open_ = rows.column("open")
                row = np.repeat(np.arange(len(rows)), np.diff(open_.offsets.to_numpy()))
                above, occurs = open_.flatten().field("k").to_numpy().astype(np.int64), open_.flatten().field("total").to_numpy()
                first = np.maximum(above * (parent // step), low[row] // step)
                last = np.minimum((above + 1) * (parent // step) - 1, high[row] // step)
            count = last - first + 1
            k = ragged(first, count)
            row, occurs = np.repeat(row, count), np.repeat(occurs, count)
            least, most = np.maximum(k * step, low[row]), np.minimum(k * step + step - 1, high[row])
            sums, origin = prefix(BYTE[buf]), offs[row] + high[row]
            under = mix(rows.column("trigger").to_numpy().view(np.uint64)[row] + k.astype(np.uint64))
            core = mix(span_hash(sums, origin - k * step, origin - k * step - step + 1 + length) ^ under)
            whole = mix(span_hash(sums, origin - most, origin - least + length) + (most * 1024 + least).astype(np.uint64))
            take = pa.array(row)
            col = {c: rows.column(c).take(take) for c in ("trigger", "phrase", "doc_id", "tag", "at")}
            k, least, most = (pa.array(x.astype(np.int32)) for x in (k, least, most))
            yield pa.record_batch([pa.array(core.view(np.int64)), pa.array(whole.view(np.int64)), col["trigger"], col["phrase"], k, least, most, pa.array(occurs), col["doc_id"], col["tag"], col["at"]], names=_names(RANGES))

    return run


def _refined(dictionary: DataFrame, length: int) -> list[DataFrame]:
    """Spans of the suffixes of once-occurring phrases that stand beside an equal one."""
    found: list[DataFrame] = []
    todo, parent = dictionary, None
    for step in STEPS:
        ranges = written(in_arrow(todo, _ranges(length, step, parent), RANGES), "ranges")
        wholes = ranges.groupBy("core", "whole").agg(F.sum("occurs").alias("total"), *(F.min(c).alias(c) for c in ("trigger", "phrase", "k")))
        wholes = written(wholes, "wholes")
        again = ranges.filter("occurs = 1").join(wholes.filter("total > 1").select("core", "whole"), ["core", "whole"])
        found.append(written(again.select("doc_id", "tag", (F.col("at") - F.col("h")).alias("start"), (F.col("at") - F.col("l") + length).alias("end")), "again"))
        if step > 1:
            cores = wholes.groupBy("core").agg(F.count("*").alias("wholes"), F.min("total").alias("least")).filter("wholes > 1 and least = 1")
            shared = wholes.join(cores.select("core"), "core")
            open_ = written(shared.groupBy("trigger", "phrase").agg(F.collect_list(F.struct("k", "total")).alias("open")), "open")
            todo, parent = dictionary.join(open_.hint("shuffle_hash"), ["trigger", "phrase"]), step
        discard(ranges, wholes)
    return found


def repeated_spans(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """s_id, s_tag and `found`, the spans [start, end) of a document's bytes under repeated windows;
    they may overlap.  Documents without any are absent; copies of a row have the same ones.

    `keyed` has doc_id, tag, base and text; a text may be a part of a document from byte `base` on,
    and the spans count from the document's start.
    """
    occurrences = in_arrow(keyed, _parse(length), PHRASES)
    shared = written(occurrences.groupBy("trigger").agg(F.sum("times").alias("of"), F.min("phrase").alias("low"), F.max("phrase").alias("high")).filter("of > 1"), "triggers")
    met = written(occurrences.join(shared, "trigger").select(*occurrences.columns, (F.col("low") == F.col("high")).alias("alike")), "parse")
    span = ["doc_id", "tag", "start", (F.col("start") + F.col("n") * F.col("times") - 1 + length).alias("end")]
    whole = met.filter("alike").select(*span)

    mixed = met.filter("not alike")
    entries = written(mixed.groupBy("trigger", "phrase").agg(F.sum("times").alias("occurs"), F.min(F.struct(*KEY, "start", "o", "n")).alias("at")), "entries")
    twice = mixed.join(entries.filter("occurs > 1").select("trigger", "phrase"), ["trigger", "phrase"]).select(*span)

    entry = F.struct("trigger", "phrase", "occurs", F.col("at.start").alias("start"), F.col("at.o").alias("o"), F.col("at.n").alias("n"))
    places = entries.groupBy(*(F.col(f"at.{c}").alias(f"p_{c}") for c in KEY)).agg(F.collect_list(entry).alias("places"))
    here = keyed["doc_id"].eqNullSafe(F.col("p_doc_id")) & (keyed["tag"] == F.col("p_tag")) & (keyed["base"] == F.col("p_base"))
    held = keyed.join(places.hint("shuffle_hash"), here).select(*KEY, "text", "places")
    dictionary = written(in_arrow(held, _slices(length), DICTIONARY), "dictionary")
    refined = _refined(dictionary, length)
    spans = reduce(DataFrame.unionByName, [whole, twice, *refined])
    lists = spans.groupBy(F.col("doc_id").alias("s_id"), F.col("tag").alias("s_tag")).agg(F.collect_set(F.struct("start", "end")).alias("found"))
    lists = written(lists, "spans")
    discard(shared, met, entries, dictionary, *refined)
    return lists


def _with_spans(base: DataFrame, lists: DataFrame, name: str = "spans") -> DataFrame:
    """`base` (with doc_id, tag) and the list of its spans, empty where it has none."""
    joined = base.join(lists.hint("shuffle_hash"), base["doc_id"].eqNullSafe(F.col("s_id")) & (base["tag"] == F.col("s_tag")), "left")
    return joined.select(*base.columns, F.coalesce("found", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias(name))


def _covered(rows: pa.RecordBatch, size: int, offs: np.ndarray) -> np.ndarray:
    """A mask over the bytes of a chunk: those under a span."""
    spans = rows.column("spans")
    flat = spans.flatten()
    row = np.repeat(np.arange(len(rows)), np.diff(spans.offsets.to_numpy()))
    cover = np.bincount(offs[row] + flat.field("start").to_numpy(), minlength=size + 1) - np.bincount(offs[row] + flat.field("end").to_numpy(), minlength=size + 1)
    return np.cumsum(cover[:size]) > 0


def _word_counts(buf: np.ndarray, offs: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The words, whole or in part, of the spans [start, end)."""
    first, last = runs(~SPACE[buf], offs)
    return np.searchsorted(first, end) - np.searchsorted(last, start, "right")


def _cut_runs(rows: pa.RecordBatch, buf: np.ndarray, offs: np.ndarray, min_words: int) -> np.ndarray:
    """The mask of the bytes that go: the runs under spans that hold `min_words` or more."""
    gone = _covered(rows, len(buf), offs)
    if min_words:
        start, end = runs(gone, offs)
        keep = _word_counts(buf, offs, start, end) >= min_words
        edges = np.bincount(start[keep], minlength=len(buf) + 1) - np.bincount(end[keep], minlength=len(buf) + 1)
        gone = np.cumsum(edges[: len(buf)]) > 0
    return gone


DIGEST = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"


def _cut(with_text: bool, min_words: int):
    def run(batches):
        for rows, buf, offs in chunks(batches):
            gone = _cut_runs(rows, buf, offs, min_words)
            left = np.concatenate([[0], np.cumsum(~gone)])[offs]
            kept = buf[~gone].tobytes()
            parts = [kept[a:b] for a, b in zip(left[:-1].tolist(), left[1:].tolist(), strict=True)]
            begins = runs(gone, offs)[0]
            of = np.diff(np.searchsorted(begins, offs))
            size = np.diff(offs)
            yield pa.record_batch([*(rows.column(c) for c in rows.schema.names), pa.array(size), pa.array(size - np.diff(left)), pa.array(of.astype(np.int64)), pa.array([hashlib.sha256(x).hexdigest() for x in parts]), pa.array([x.decode(errors="ignore") for x in parts] if with_text else [None] * len(rows), pa.string())], names=[*rows.schema.names, *_names(DIGEST)])

    return run


def drop_repeats(docs: DataFrame, length: int = LENGTH, min_words: int = 0, with_text: bool = True) -> DataFrame:
    """`row` (the document's own columns) with n_bytes, n_removed, n_spans, kept_sha256 and, on wish,
    the kept text (without bytes of a character that was cut in two).

    Bytes under a repeated window of `length` bytes go where they make runs of `min_words` words or more.
    """
    base = packed(docs, F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("tag"), "text")
    ready = _with_spans(base, repeated_spans(_keyed(docs), length)).drop("doc_id", "tag")
    return in_arrow(ready, _cut(with_text, min_words), extended(ready, DIGEST))


def without_passages(docs: DataFrame, length: int = PASSAGE_BYTES, min_words: int = PASSAGE_WORDS) -> DataFrame:
    """The documents' columns with every repeated passage cut from `text`, wherever it stands; bytes of
    a character that was cut in two go as well, and `n_chars` is brought up to date.  No row is removed;
    null stays null; texts without a passage stay as they are."""
    kept = "if(text is null or n_removed = 0, text, kept)"
    return unpacked(drop_repeats(docs, length, min_words), docs, text=kept, n_chars="if(text is null or n_removed = 0, row.n_chars, char_length(kept))")


COVERED = "doc_id bigint, tag bigint, n_bytes bigint, n_passages bigint, passage_words bigint, kept_sha256 string, parts array<struct<start:int,end:int>>, text string"


def _cover(length: int, min_words: int):
    """Each document's passages, and those of its runs that can hold a window of `length` bytes."""

    def run(batches):
        for rows, buf, offs in chunks(batches):
            start, end = runs(_covered(rows, len(buf), offs), offs)
            row = np.searchsorted(offs, start, "right") - 1
            words = _word_counts(buf, offs, start, end)
            passage = words >= min_words
            n_passages = np.bincount(row[passage], minlength=len(rows))
            passage_words = np.bincount(row[passage], words[passage], len(rows)).astype(np.int64)
            long = end - start >= length
            parts: list[list[tuple[int, int]]] = [[] for _ in range(len(rows))]
            for r, a, b in zip(row[long].tolist(), (start - offs[row])[long].tolist(), (end - offs[row])[long].tolist(), strict=True):
                parts[r].append((a, b))
            raw = buf.tobytes()
            sha = [None if p else hashlib.sha256(raw[a:b]).hexdigest() for p, a, b in zip(parts, offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
            yield pa.record_batch([rows.column("doc_id"), rows.column("tag"), pa.array(np.diff(offs)), pa.array(n_passages.astype(np.int64)), pa.array(passage_words), pa.array(sha, pa.string()), pa.array(parts, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), rows.column("text")], names=_names(COVERED))

    return run


def _fragments(batches):
    for rows, buf, offs in chunks(batches):
        raw = buf.tobytes()
        parts = rows.column("parts").to_pylist()
        row = np.repeat(np.arange(len(rows)), [len(p) for p in parts])
        data = [raw[offs[r] + x["start"] : offs[r] + x["end"]] for r, p in enumerate(parts) for x in p]
        base = pa.array([x["start"] for p in parts for x in p], pa.int32())
        yield pa.record_batch([rows.column("doc_id").take(pa.array(row)), rows.column("tag").take(pa.array(row)), base, pa.array(data, pa.binary())], names=[*KEY, "text"])


def repeat_digests(docs: DataFrame, length: int = LENGTH, passage_bytes: int = PASSAGE_BYTES, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """What `drop_repeats` counts of every row, and its repeated passages.

    Bytes under a repeated window of `length` bytes lie in runs of repeated windows of any lesser
    length.  So the whole texts are searched once for windows of `passage_bytes`, and the longer windows
    only inside the runs found.
    """
    keyed = _keyed(docs)
    lists = repeated_spans(keyed, passage_bytes)
    covered = in_arrow(_with_spans(keyed.drop("base"), lists), _cover(length, passage_words), COVERED)
    covered = written(covered.withColumn("text", F.when(F.size("parts") > 0, F.col("text"))), "covered")
    discard(lists)
    held = covered.filter(F.size("parts") > 0)
    fragments = written(in_arrow(held.select("doc_id", "tag", "text", "parts"), _fragments, "doc_id bigint, tag bigint, base int, text binary"), "fragments")
    lists = repeated_spans(fragments, length)
    discard(fragments)
    again = _with_spans(held.select("doc_id", "tag", "text", "n_passages", "passage_words"), lists)
    cut = in_arrow(again, _cut(False, 0), extended(again, DIGEST))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "passage_words"]
    plain = covered.filter(F.size("parts") == 0).withColumns({"n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long")})
    return plain.select(*columns).unionByName(cut.select(*columns))


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document against every other one and itself."""
    return repeat_digests(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
