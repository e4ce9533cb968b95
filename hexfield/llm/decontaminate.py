"""Benchmark decontamination with a generalised suffix automaton of normalised test items.

The test items become word sequences; one automaton over all of them recognises every run of words
that occurs in some item.  Documents stream through it word by word while the length of the longest
match that ends at the current word is tracked.  Wherever that length reaches a window (`window`
words, or the whole of a shorter item), the words under the window are hit.

Items are dealt to parts of bounded size.  Spark tasks build an automaton for each part and write it, as
flat arrays, to the shared folder; a pass over the documents takes up a bounded number of parts, and
further passes go on from the rows that the one before has written.  So neither the driver nor a task ever
holds more than one pass's arrays, however many items there are.

Before the automaton walks, a vectorised pass keeps only the stretches in which every two
neighbouring words are neighbours in some item too: no match can leave such a stretch.

Defined results: a null or empty text has no words and no hits; null or wordless items match
nothing; repeated documents are each answered; repeated items are each reported; extra columns of
the input are carried; in `hits` those named like an added one are replaced, in `decontaminate` none clash.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .store import extended, free, in_arrow, packed, unpacked, written
from .text import BYTE_LOWER, chunks, prefix, runs, span_hash, table

#: Bytes of a word: digits, ASCII letters and everything beyond ASCII.
WORD = table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
WINDOW = 10
#: Bytes of item text of a part, which makes one automaton, and of the parts that one pass takes up.
PART_BYTES = 1 << 20
PASS_BYTES = 8 << 20


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the lower-cased words, and each row's first word."""
    start, end = runs(WORD[buf], offs)
    return start, end, span_hash(prefix(BYTE_LOWER[buf]), start, end), np.searchsorted(start, offs)


class Automaton:
    """A generalised suffix automaton over word ids with the windows that end in each state."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.ids = [i for i, _ in items]
        texts = pa.record_batch({"text": pa.array([t for _, t in items], pa.string())})
        sequences: list[np.ndarray] = []
        for _, buf, offs in chunks([texts]):
            _, _, hashes, first = words(buf, offs)
            sequences += [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        seen = np.concatenate(sequences) if sequences else np.zeros(0, np.uint64)
        self.vocabulary = np.unique(seen)
        lengths = [len(s) for s in sequences if len(s)]
        self.shortest = min(window, *lengths) if len(lengths) > 1 else min([window, *lengths])
        coded = [np.searchsorted(self.vocabulary, s) for s in sequences]
        pairs = [c[:-1].astype(np.int64) * len(self.vocabulary) + c[1:] for c in coded]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, int, int]] = []  # state after a word, item, words read so far
        for item, c in enumerate(coded):
            state = 0
            for n, word in enumerate(c.tolist(), 1):
                state = self._extend(state, word)
                ends.append((state, item, n))
        self.items: list[dict[int, set[int]]] = [{} for _ in self.link]  # window length -> items
        for state, item, n in ends:
            total = len(coded[item])
            size = min(window, total)
            if n >= size if total >= window else n == total:
                while self.length[self.link[state]] >= size if self.link[state] >= 0 else False:
                    state = self.link[state]
                self.items[state].setdefault(size, set()).add(item)
        self.hit = [-1] * len(self.link)  # nearest state up the links, itself included, that ends windows
        for s in sorted(range(len(self.link)), key=self.length.__getitem__):
            self.hit[s] = s if self.items[s] else self.hit[self.link[s]] if self.link[s] >= 0 else -1

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def compact(self) -> Compact:
        """The automaton as arrays."""
        size = max(1, len(self.vocabulary))
        moves = sorted((state * size + word, to) for state, words_ in enumerate(self.next) for word, to in words_.items())
        ends = [(state, n, item) for state, found in enumerate(self.items) for n, items in sorted(found.items()) for item in sorted(items)]
        return Compact(
            self.ids, self.vocabulary, self.pairs, self.shortest, *np.array(moves, np.int64).reshape(-1, 2).T.copy(),
            *(np.array(x, np.int32) for x in (self.link, self.length, self.hit)), *np.array(ends, np.int32).reshape(-1, 3).T.copy(),
        )


@dataclass
class Compact:
    """A suffix automaton as flat arrays: moves by state and word, suffix links, and the windows that end in a state."""

    ids: list[str | None]
    vocabulary: np.ndarray
    pairs: np.ndarray
    shortest: int
    moves: np.ndarray
    targets: np.ndarray
    link: np.ndarray
    length: np.ndarray
    hit: np.ndarray
    end_state: np.ndarray
    end_size: np.ndarray
    end_item: np.ndarray

    def _move(self, state: int, word: int) -> int:
        key = state * len(self.vocabulary) + word
        at = int(np.searchsorted(self.moves, key))
        return int(self.targets[at]) if at < len(self.moves) and self.moves[at] == key else -1

    def stream(self, coded: list[int]) -> Iterator[tuple[int, int, set[int]]]:
        """(first word, word after the last, items) of every window in a stretch of known words."""
        state, length = 0, 0
        for at, word in enumerate(coded, 1):
            while (to := self._move(state, word)) < 0 and state:
                state = int(self.link[state])
                length = int(self.length[state])
            if to >= 0:
                state, length = to, length + 1
            s = int(self.hit[state])
            while s >= 0:
                lo, hi = np.searchsorted(self.end_state, [s, s + 1])
                for size in set(self.end_size[lo:hi].tolist()):
                    if size <= length:
                        yield at - size, at, set(self.end_item[lo:hi][self.end_size[lo:hi] == size].tolist())
                s = int(self.hit[self.link[s]]) if self.link[s] >= 0 else -1


def _stretches(automaton: Compact, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word codes, and where the stretches lie that are long enough to hold a window."""
    vocabulary = automaton.vocabulary
    if not len(hashes) or not len(vocabulary):
        return hashes, np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[code] == hashes
    if automaton.shortest == 1:
        start, end = runs(known, first)
        return code, start, end
    pair = code[:-1] * len(vocabulary) + code[1:]
    near = np.zeros(len(code), bool)  # this word and the next one stand together in some item
    both = np.flatnonzero(known[:-1] & known[1:])
    at = np.minimum(np.searchsorted(automaton.pairs, pair[both]), len(automaton.pairs) - 1)
    near[both[automaton.pairs[at] == pair[both]]] = True
    inner = first[1:-1] - 1
    near[inner[inner >= 0]] = False  # the last word of a row
    near[-1] = False
    start, end = runs(near, np.array([0, len(near)]))
    long = end - start + 1 >= automaton.shortest
    return code, start[long], end[long] + 1


def _find(automaton: Compact):
    def run(batches):
        for rows, buf, offs in chunks(batches):
            start, end, hashes, first = words(buf, offs)
            code, lo, hi = _stretches(automaton, hashes, first)
            cover = np.zeros(len(hashes) + 1, np.int32)
            found: dict[int, set[int]] = {}
            row = np.searchsorted(first, lo, "right") - 1
            for r, a, b in zip(row.tolist(), lo.tolist(), hi.tolist(), strict=True):
                for x, y, items in automaton.stream(code[a:b].tolist()):
                    cover[a + x] += 1
                    cover[a + y] -= 1
                    found.setdefault(r, set()).update(items)
            hit = np.cumsum(cover[:-1]) > 0
            span_from, span_to = runs(hit, first)
            of = np.searchsorted(first, span_from, "right") - 1
            spans = [[] for _ in range(len(rows))]
            for r, x, y in zip(of.tolist(), start[span_from].tolist(), end[span_to - 1].tolist(), strict=True):
                spans[r].append((x - int(offs[r]), y - int(offs[r])))
            counts = np.concatenate([[0], np.cumsum(hit)])
            yield pa.record_batch(
                [
                    *(rows.column(c) for c in rows.schema.names),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(counts[first[1:]] - counts[first[:-1]], pa.int64()),
                    pa.array([[automaton.ids[i] for i in found.get(r, ())] for r in range(len(rows))], pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=[*rows.schema.names, "n_words", "n_hit", "item_ids", "spans"],
            )

    return run


def _build(window: int):
    """The automaton of each part; rows come sorted by part."""

    def run(batches):
        part, held = None, []
        for batch in batches:
            for p, item, text in zip(*(batch.column(c).to_pylist() for c in ("part", "item_id", "text")), strict=True):
                if p != part and held:
                    yield model(part, held)
                    held = []
                part = p
                held.append((item, text))
        if held:
            yield model(part, held)

    def model(part: int, items: list[tuple[str | None, str | None]]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([part], pa.int32()), pa.array([pickle.dumps(Automaton(items, window).compact())], pa.binary())], names=["part", "model"])

    return run


def _passes(items: DataFrame, window: int) -> Iterator[list[Compact]]:
    """The automata of all items, as many at a time as a pass takes up; one without items if there are none."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    n = int((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PART_BYTES) + 1
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int")).repartition(n, "part").sortWithinPartitions("part")
    automata = written(in_arrow(dealt.select("part", "item_id", "text"), _build(window), "part int, model binary"), "automata")
    step, found = max(1, PASS_BYTES // PART_BYTES), False
    for k in range(0, n, step):
        models = [pickle.loads(r["model"]) for r in automata.filter(F.col("part").between(k, k + step - 1)).orderBy("part").collect()]
        if models:
            found = True
            yield models
    if not found:
        yield [Automaton([], window).compact()]


ADDED = "n_words bigint, n_hit bigint, item_ids array<string>, spans array<struct<start:bigint,end:bigint>>"
FOUND = [f.split()[0] for f in ADDED.split(", ")]


def _searched(docs: DataFrame, items: DataFrame, window: int, finish=None, schema: StructType | None = None) -> DataFrame:
    """The documents with the findings; `finish` makes batches of another schema of those of the last pass."""
    own, out = docs.columns, None
    ahead = _passes(items, window)
    models = next(ahead)
    while models:
        following = next(ahead, None)
        shared = docs.sparkSession.sparkContext.broadcast(models)
        before = out is not None

        def search(batches, shared=shared, before=before):
            for batch in batches:
                if not len(batch):
                    continue
                rows = batch.select(own)
                outs = [pa.Table.from_batches(_find(m)([rows])) for m in shared.value]
                if before:
                    outs.append(pa.Table.from_batches([batch]))
                if len(outs) == 1:
                    yield from outs[0].to_batches()
                else:
                    yield _united(outs, rows)

        def last(batches, search=search):
            return finish(search(batches))

        source = written(out, "searched") if before else docs
        out = in_arrow(source, search, extended(docs, ADDED)) if following or not finish else in_arrow(source, last, schema)
        models = following
    return out


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The frame's columns (`text` among them) with n_words, n_hit, item_ids (of the items found) and spans
    (bytes [start, end)); findings of several automata are united row by row, without a shuffle."""
    return _searched(free(docs, ADDED), items, window)


def _united(outs: list[pa.Table], batch: pa.RecordBatch) -> pa.RecordBatch:
    """One answer from those of several automata: spans are merged and their words counted anew."""
    text = batch.column("text").to_pylist()
    items = [sum(x, []) for x in zip(*(t["item_ids"].to_pylist() for t in outs), strict=True)]
    spans, n_hit = [], []
    for t, parts in zip(text, zip(*(t["spans"].to_pylist() for t in outs), strict=True), strict=True):
        merged: list[list[int]] = []
        for s in sorted((s["start"], s["end"]) for part in parts for s in part):
            if merged and s[0] <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], s[1])
            else:
                merged.append(list(s))
        raw = (t or "").encode()
        n_hit.append(sum(len(words(b := np.frombuffer(raw[x:y], np.uint8), np.array([0, len(b)]))[0]) for x, y in merged))
        spans.append([{"start": x, "end": y} for x, y in merged])
    return pa.record_batch([*batch.columns, outs[0]["n_words"].combine_chunks(), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, outs[0].schema.field("spans").type)], names=outs[0].schema.names)


def decontaminate(docs: DataFrame, items: DataFrame, min_words: int = WINDOW, max_coverage: float = 0.5, window: int = WINDOW) -> DataFrame:
    """The documents without their contaminated spans; `n_chars` is brought up to date.

    A hit span is cut out when it has at least `min_words` words or is a whole shorter item (spans
    never are shorter than a window, so the default cuts every one).  A document of whose words more
    than `max_coverage` are hit is removed as a whole.  Clean documents pass unchanged.
    """
    base = packed(docs, "text")

    def cut(batches):
        for batch in batches:
            text, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
            n_words, n_hit = batch.column("n_words").to_pylist(), batch.column("n_hit").to_pylist()
            for i, s in enumerate(spans):
                if s:
                    raw, at, kept = text[i].encode(), 0, []
                    for x in s:
                        n = len(words(b := np.frombuffer(raw[x["start"] : x["end"]], np.uint8), np.array([0, len(b)]))[0])
                        if n >= min(min_words, window) or n < window:
                            kept.append(raw[at : x["start"]])
                            at = x["end"]
                    text[i] = b"".join([*kept, raw[at:]]).decode()
            stays = [h <= max_coverage * n for h, n in zip(n_hit, n_words, strict=True)]
            out = pa.record_batch([batch.column("row"), pa.array(text, pa.string()), pc.greater(batch.column("n_hit"), 0)], names=["row", "text", "cut"])
            yield out.filter(pa.array(stays, pa.bool_()))

    left = _searched(base, items, window, cut, extended(base, "cut boolean"))
    return unpacked(left, docs, n_chars="if(cut, char_length(text), row.n_chars)")


def digest(ids: DataFrame) -> DataFrame:
    """The contract's columns from those of `hits`."""
    found = F.array_sort("item_ids")
    return ids.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", found), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Every document of the table against every benchmark item."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return digest(hits(docs.select("doc_id", "text"), items))
