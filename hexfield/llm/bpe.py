"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The corpus's most frequent words are compiled, with the ids that the vocabulary gives them, into a
minimal acyclic automaton: words share prefixes and, after minimisation, suffixes; every arc carries
how many words it passes over, so that the sum along a word's path is its number, and the number
names its ids.  Workers memory-map the automaton from a scratch file and walk it for all distinct
words of a chunk at once.  Words that it does not hold are merged exactly, those of up to 32 bytes all
together, one merge of each in a round.

The vocabulary is one of byte-level symbols with a word-end suffix, lower-casing and dropped white
space (`word_bpe_49k.json`).  Texts of characters below U+0240 are cut into words here; any text with
other characters, unusual controls or a special token's string takes the library's own normaliser
and pre-tokeniser, so that no rule of theirs has to be restated.

Defined results: null counts as an empty text, which has no ids and decodes to the empty text; special
tokens' strings inside a text become those tokens; repeated rows are each answered; `doc_id` may be
null; extra columns are carried.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import tempfile
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import extended, free, in_arrow, written
from .text import chunks, mix, prefix, ragged, span_hash

LEXICON_WORDS = 50_000
#: Distinct words that a worker keeps with their ids, and that a counting task gathers; full stores are emptied.
MAX_STORED_WORDS = 100_000
MAX_COUNTED_WORDS = 200_000
#: Longest words, in bytes, that are merged together; each width is a table of its own.  Longer ones are merged singly.
WIDTHS = (8, 16, 32)
MERGED_AT_ONCE = 1 << 14
NO_PAIR = np.iinfo(np.int32).max
PLAIN = 0x240


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower case, class (0 space, 1 letter, 2 number, 3 other) and hash value of the plain characters."""
    lower, kind = np.arange(PLAIN, dtype=np.uint16), np.full(PLAIN, 3, np.uint8)
    for c in range(PLAIN):
        small, sort = chr(c).lower(), unicodedata.category(chr(c))[0]
        if len(small) == 1:
            lower[c] = ord(small)
        kind[c] = 0 if c in (9, 10, 13, 32) else 1 if sort == "L" else 2 if sort == "N" else 3
    return lower, kind, mix(np.arange(5001, 5001 + PLAIN, dtype=np.uint64)) | np.uint64(1)


LOWERED, KIND, VALUE = _tables()
#: Bytes that send a text to the library: controls, and the first bytes of characters from U+0240 on.
ODD = np.zeros(256, bool)
ODD[[*range(9), 11, 12, *range(14, 32), 127, *range(0xC9, 0x100)]] = True


def _odd_rows(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows that the plain rules do not cover."""
    odd = ODD[buf]
    if len(buf) > 1:
        pair = (buf[:-1].astype(np.uint16) << 8) | buf[1:]
        odd[:-1] |= (pair == 0x3C7C) | (pair == 0xC4B0) | ((pair >= 0xC280) & (pair <= 0xC2A0))  # "<|", dotted I, C1 controls to no-break space
    sums = np.concatenate([[0], np.cumsum(odd)])
    return sums[offs[1:]] > sums[offs[:-1]]


def _cut(chars: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in lower-cased plain characters."""
    n = len(chars)
    kind = KIND[chars]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    start = kind > 0
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2) | edge[1:n]
    # an apostrophe that stands alone before s, t, m, d, re, ve or ll takes these letters along
    quote = np.flatnonzero((chars[:-1] == 39) & start[:-1] & (kind[1:] == 1) & ~edge[1:n]) if n > 1 else np.zeros(0, np.int64)
    if len(quote):
        one = chars[quote + 1]
        two_at = np.minimum(quote + 2, n - 1)
        two = np.where((quote + 2 < n) & ~edge[np.minimum(quote + 2, n)], chars[two_at], 0)
        takes = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, np.where(((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))), 2, 0))
        quote, takes = quote[takes > 0], takes[takes > 0]
        start[quote + 1] = False
        after = quote + 1 + takes
        inside = after < n
        after = after[inside]
        start[after[(kind[after] == 1) & ~edge[after]]] = True
    bounds = np.append(np.flatnonzero(start | (kind == 0)), n)
    first = np.flatnonzero(start)
    return first, bounds[np.searchsorted(bounds, first, "right")]


class Vocabulary:
    """The vocabulary file: ids, merge ranks and the library's own text rules."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        data = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        self.ids: dict[str, int] = data["model"]["vocab"]
        self.suffix = data["model"]["end_of_word_suffix"]
        self.ranks = {tuple(m): i for i, m in enumerate(data["model"]["merges"])}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special_pattern = re.compile("|".join(re.escape(s) for s in self.special)) if self.special else None
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
        rest = [b for b in range(256) if b not in set(plain)]
        self.symbol = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.byte = {c: b for b, c in self.symbol.items()}
        tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        shown = [tokens.get(i, "").encode() + b" " for i in range(max(tokens) + 1)]
        self.shown_length = np.array([len(x) for x in shown], np.int64)
        self.shown_start = np.cumsum(self.shown_length) - self.shown_length
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        # the merges as arrays over numbered parts: sorted pairs with their ranks, and by rank what a pair becomes
        numbers: dict[str, int] = {}
        number = lambda part: numbers.setdefault(part, len(numbers))
        self.inner, self.last = (np.array([number(self.symbol[b] + end) for b in range(256)]) for end in ("", self.suffix))
        pairs = sorted((number(a) << 32 | number(b), r) for (a, b), r in self.ranks.items())
        self.pairs, self.pair_ranks = np.array([p for p, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int32)
        self.made = np.zeros(len(data["model"]["merges"]), np.int64)
        self.made[list(self.ranks.values())] = [number(a + b) for a, b in self.ranks]
        self.token = np.array([self.ids[part] for part in numbers], np.int64)

    def merge(self, word: bytes) -> list[int]:
        """The exact merges of one word: always the pair of least rank, the leftmost of equals."""
        parts: list[str | None] = [self.symbol[b] for b in word]
        parts[-1] += self.suffix
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.ranks.get
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[k]))
            h = before[i]
            if h >= 0 and (r := rank((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return [self.ids[p] for p in parts if p is not None]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of numbered parts; NO_PAIR for those that don't merge and beside a word's end (-1)."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], NO_PAIR)

    def _merge_table(self, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and the ids, of words of `width` bytes at most: each round makes one merge in every
        word that has one left, the pair of least rank, the leftmost of equals."""
        size = np.array([len(w) for w in words], np.int64)
        letters, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size)
        done = np.full((len(words), width), -1, np.int64)
        done[np.repeat(np.arange(len(words)), size), ragged(np.zeros_like(size), size)] = self.inner[letters]
        done[np.arange(len(words)), size - 1] = self.last[letters[ends - 1]]
        part, live, column = done.copy(), np.arange(len(words)), np.arange(width - 1)
        rank = np.full(part.shape, NO_PAIR, np.int32)
        rank[:, :-1] = self._rank(part[:, :-1], part[:, 1:])
        while len(live):
            at = rank.argmin(axis=1)
            least = rank[np.arange(len(live)), at]
            more = least < NO_PAIR
            done[live[~more]] = part[~more]
            part, rank, live, at, least = part[more], rank[more], live[more], at[more], least[more]
            each, beyond = np.arange(len(live)), column > at[:, None]
            for values, blank in ((part, -1), (rank, NO_PAIR)):  # what follows the pair moves one place to the left
                values[:, :-1] = np.where(beyond, values[:, 1:], values[:, :-1])
                values[:, -1] = blank
            part[each, at] = self.made[least]
            rank[each, at] = self._rank(part[each, at], part[each, at + 1])
            each, at = each[at > 0], at[at > 0]
            rank[each, at - 1] = self._rank(part[each, at - 1], part[each, at])
        kept = done >= 0
        return kept.sum(axis=1), self.token[done[kept]]

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of all words, and their ids one after another, as `merge` gives them."""
        size = np.array([len(w) for w in words], np.int64)
        order, lengths, ids = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for least, width in zip((0, *WIDTHS), WIDTHS, strict=False):
            some = np.flatnonzero((size > least) & (size <= width))
            for i in range(0, len(some), MERGED_AT_ONCE):
                order.append(some[i : i + MERGED_AT_ONCE])
                for out, found in zip((lengths, ids), self._merge_table([words[k] for k in order[-1].tolist()], width), strict=True):
                    out.append(found)
        order.append(np.flatnonzero(size > WIDTHS[-1]))
        long = [np.array(self.merge(words[k]), np.int64) for k in order[-1].tolist()]
        length, found = np.concatenate([*lengths, np.array([len(x) for x in long], np.int64)]), np.concatenate([*ids, *long])
        order = np.concatenate(order)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return length[back], found[ragged((np.cumsum(length) - length)[back], length[back])]

    def odd_words(self, text: str) -> list[bytes | int]:
        """Words, as bytes, of a text by the library's own rules; special tokens as ids."""
        out: list[bytes | int] = []
        at = 0
        for m in [*(self.special_pattern.finditer(text) if self.special_pattern else ()), None]:
            piece = text[at : m.start() if m else len(text)]
            if piece:
                normal = self.library.normalizer.normalize_str(piece)
                out += [bytes(self.byte[c] for c in w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
            if m:
                out.append(self.special[m[0]])
                at = m.end()
        return out


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic automaton over the words, as the bytes of a file that can be memory-mapped.

    Words are added in order; whenever a branch is complete its states are replaced by equal ones met
    before.  The file holds int64 arrays behind their lengths: arc keys (state * 256 + byte, sorted),
    arc targets, words passed over, whether states end words, and the ids of the words in order.
    """
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}

    def settle(path: list[tuple[int, int, int]]) -> None:
        for parent, label, child in reversed(path):
            key = (final[child], tuple(sorted(arcs[child].items())))
            same = register.setdefault(key, child)
            if same != child:
                arcs[parent][label] = same

    path: list[tuple[int, int, int]] = []
    last = b""
    words = sorted(w for w in entries if w)
    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(path[common:])
        del path[common:]
        state = path[-1][2] if path else 0
        for label in word[common:]:
            arcs.append({})
            final.append(False)
            arcs[state][label] = len(arcs) - 1
            path.append((state, label, len(arcs) - 1))
            state = len(arcs) - 1
        final[state] = True
        last = word
    settle(path)

    number: dict[int, int] = {0: 0}
    order = [0]
    for s in order:
        for t in arcs[s].values():
            if t not in number:
                number[t] = len(order)
                order.append(t)
    below: dict[int, int] = {}

    def count(state: int) -> int:
        stack = [state]
        while stack:
            s = stack[-1]
            missing = [t for t in arcs[s].values() if t not in below]
            if missing:
                stack += missing
            else:
                below[stack.pop()] = final[s] + sum(below[t] for t in arcs[s].values())
        return below[state]

    count(0)
    keys, targets, passed = [], [], []
    for s in order:
        over = int(final[s])
        for label, t in sorted(arcs[s].items()):
            keys.append(number[s] * 256 + label)
            targets.append(number[t])
            passed.append(over)
            over += below[t]
    lengths = [len(entries[w]) for w in words]
    arrays = [keys, targets, passed, [int(final[s]) for s in order], np.concatenate([[0], np.cumsum(lengths)]), [i for w in words for i in entries[w]]]
    arrays = [np.asarray(a, np.int64) for a in arrays]
    return np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """A compiled lexicon, memory-mapped."""

    def __init__(self, compiled: bytes):
        self.file = tempfile.TemporaryFile()
        self.file.write(compiled)
        self.file.flush()
        mapped = np.memmap(self.file, np.int64, "r")
        ends = 6 + np.cumsum(mapped[:6])
        self.keys, self.targets, self.passed, self.final, self.starts, self.ids = (mapped[a:b] for a, b in zip([6, *ends[:-1]], ends, strict=True))

    def find(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words, -1 for those that are not held; all words walk together."""
        length = np.array([len(w) for w in words], np.int64)
        letters = np.frombuffer(b"".join(words), np.uint8)
        begins = np.cumsum(length) - length
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        alive = np.flatnonzero(length > 0) if len(self.keys) else np.zeros(0, np.int64)
        done = np.full(len(words), -1, np.int64)
        step = 0
        while len(alive):
            key = state[alive] * 256 + letters[begins[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            held = self.keys[at] == key
            alive, at = alive[held], at[held]
            state[alive] = self.targets[at]
            number[alive] += self.passed[at]
            step += 1
            over = length[alive] == step
            ends = alive[over]
            ends = ends[self.final[state[ends]] == 1]
            done[ends] = number[ends]
            alive = alive[~over]
        return done


class Words:
    """Words with their ids, as one worker has met them."""

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon | None):
        self.vocab, self.lexicon = vocab, lexicon
        self.clear()

    def clear(self) -> None:
        self.by_hash: dict[int, int] = {}
        self.by_bytes: dict[bytes, int] = {}
        self.length, self.start, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, words: list[bytes]) -> list[int]:
        """Places of words, new ones by lexicon or by merging."""
        new = [w for w in dict.fromkeys(words) if w not in self.by_bytes]
        if new:
            number = self.lexicon.find(new) if self.lexicon else np.full(len(new), -1)
            held, unseen = np.flatnonzero(number >= 0), np.flatnonzero(number < 0)
            length, ids = self.vocab.merge_all([new[i] for i in unseen.tolist()])
            if len(held):
                start = self.lexicon.starts[number[held]]
                size = self.lexicon.starts[number[held] + 1] - start
                length, ids = np.concatenate([size, length]), np.concatenate([self.lexicon.ids[ragged(start, size)], ids])
            self._append(length, ids)
            for i, k in enumerate([*held.tolist(), *unseen.tolist()], len(self.by_bytes) + self.specials):
                self.by_bytes[new[k]] = i
        return [self.by_bytes[w] for w in words]

    @property
    def specials(self) -> int:
        return len(self.vocab.special)

    def _append(self, length: np.ndarray, ids: np.ndarray) -> None:
        if not len(self.length) and self.specials:
            own = np.array([*self.vocab.special.values()], np.int64)
            length, ids = np.concatenate([np.ones(len(own), np.int64), length]), np.concatenate([own, ids])
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, ids])

    def special(self, token: int) -> int:
        if not len(self.length):
            self._append(np.zeros(0, np.int64), np.zeros(0, np.int64))
        return [*self.vocab.special.values()].index(token)


def _plain_words(buf: np.ndarray, offs: np.ndarray, odd: np.ndarray) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased plain text with starts, ends, hashes and rows of its words."""
    size = np.diff(offs)
    data = buf if not odd.any() else buf[np.repeat(~odd, size)]
    plain = np.flatnonzero(~odd)
    chars = LOWERED[np.frombuffer(data.tobytes().decode().encode("utf-16-le"), np.uint16)]
    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    bounds = letters[np.concatenate([[0], np.cumsum(size[plain])])]
    start, end = _cut(chars, bounds) if len(chars) else (np.zeros(0, np.int64),) * 2
    row = plain[np.searchsorted(bounds, start, "right") - 1] if len(start) else start
    return chars.tobytes().decode("utf-16-le"), start, end, span_hash(prefix(VALUE[chars]), start, end), row


def _count(path: str):
    def run(batches):
        total: dict[bytes, int] = {}

        def out():
            return pa.record_batch([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for rows, buf, offs in chunks(batches):
            odd = _odd_rows(buf, offs)
            text, start, end, hashes, _ = _plain_words(buf, offs, odd)
            _, at, times = np.unique(hashes, return_index=True, return_counts=True)
            for a, b, n in zip(start[at].tolist(), end[at].tolist(), times.tolist(), strict=True):
                w = text[a:b].encode()
                total[w] = total.get(w, 0) + n
            for i in np.flatnonzero(odd).tolist():
                for w in vocabulary(path).odd_words(rows.column("text")[i].as_py()):
                    if isinstance(w, bytes):
                        total[w] = total.get(w, 0) + 1
            if len(total) > MAX_COUNTED_WORDS:
                yield out()
                total.clear()
        yield out()

    return run


def frequent_words(docs: DataFrame, path: str, limit: int = LEXICON_WORDS) -> list[bytes]:
    """The words that all documents together hold most often, at most `limit`.

    Counts first meet in a histogram of a fixed number of classes; only words from the classes that
    fit below the limit reach the driver, however many tasks or distinct words there are.
    """
    counts = in_arrow(docs.select("text"), _count(path), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts.filter("n > 1").withColumn("class", F.floor(32 * F.log2("n")).cast("int")), "words")
    least, total = None, 0
    for r in counts.groupBy("class").count().orderBy(F.desc("class")).collect():
        total += r["count"]
        if total > limit:
            break
        least = r["class"]
    return [] if least is None else [bytes(r["word"]) for r in counts.filter(F.col("class") >= least).select("word").collect()]


ENCODED = "ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string, decoded string"
_STORES: dict[tuple, Words] = {}


def _words(path: str, lexicon) -> Words:
    key = (path, hashlib.sha256(lexicon.value).digest()) if lexicon is not None else (path, None)
    if key not in _STORES:
        _STORES.clear()
        _STORES[key] = Words(vocabulary(path), Lexicon(lexicon.value) if lexicon is not None else None)
    return _STORES[key]


def _encode(path: str, lexicon, with_values: bool):
    def run(batches):
        store = _words(path, lexicon)
        vocab = store.vocab
        for rows, buf, offs in chunks(batches):
            if len(store.by_bytes) > MAX_STORED_WORDS:
                store.clear()
            odd = _odd_rows(buf, offs)
            text, start, end, hashes, row = _plain_words(buf, offs, odd)
            unique, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            keys = unique.tolist()
            new = [i for i, h in enumerate(keys) if h not in store.by_hash]
            spans = zip(start[at[new]].tolist(), end[at[new]].tolist(), strict=True)
            for i, place in zip(new, store.add([text[a:b].encode() for a, b in spans]), strict=True):
                store.by_hash[keys[i]] = place
            word = np.array([store.by_hash[h] for h in keys], np.int64)[inverse] if keys else np.zeros(0, np.int64)
            for i in np.flatnonzero(odd).tolist():
                found = vocab.odd_words(rows.column("text")[i].as_py())
                store.add([w for w in found if isinstance(w, bytes)])
                places = [store.by_bytes[w] if isinstance(w, bytes) else store.special(w) for w in found]
                word, row = np.concatenate([word, np.array(places, np.int64)]), np.concatenate([row, np.full(len(places), i)])
            order = np.argsort(row, kind="stable")
            word, row = word[order], row[order]
            ids = store.ids[ragged(store.start[word], store.length[word])]
            tokens = np.concatenate([[0], np.cumsum(store.length[word])])[np.searchsorted(row, np.arange(len(rows) + 1))]
            shown = vocab.shown[ragged(vocab.shown_start[ids], vocab.shown_length[ids])].tobytes()
            ends = np.concatenate([[0], np.cumsum(vocab.shown_length[ids])])[tokens]
            raw = ids.astype("<u4").tobytes()
            bounds = list(zip(tokens[:-1].tolist(), tokens[1:].tolist(), strict=True))
            decoded = [shown[a : max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(tokens.astype(np.int32)), pa.array(ids.astype(np.int32))) if with_values else pa.nulls(len(rows), pa.list_(pa.int32()))
            yield pa.record_batch(
                [
                    *(rows.column(c) for c in rows.schema.names),
                    lists,
                    pa.array(np.diff(tokens)),
                    pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in bounds], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
                    pa.array([d.decode() for d in decoded] if with_values else [None] * len(rows), pa.string()),
                ],
                names=[*rows.schema.names, *(f.split()[0] for f in ENCODED.split(", "))],
            )

    return run


def encode(docs: DataFrame, path: str, words: int = LEXICON_WORDS, with_values: bool = True) -> DataFrame:
    """The frame's columns (`text` among them; those named like an added one are replaced) with the ids, their number and digests, and the decoded
    text; ids and decoded text are null unless `with_values`.

    The corpus's `words` most frequent words make the lexicon, whose size is bounded by their number.
    """
    vocab = vocabulary(path)
    frequent = frequent_words(docs, path, words)
    length, ids = vocab.merge_all(frequent)
    compiled = compile_lexicon(dict(zip(frequent, np.split(ids, np.cumsum(length)[:-1]), strict=True)) if frequent else {})
    lexicon = docs.sparkSession.sparkContext.broadcast(compiled)
    docs = free(docs, ENCODED)
    return in_arrow(docs, _encode(path, lexicon, with_values), extended(docs, ENCODED))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of every document."""
    return encode(docs.select("doc_id", "text"), path, with_values=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document under the 49k word vocabulary."""
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
