"""Vectorised byte-level helpers that the operators run inside Arrow tasks.

Texts arrive as Arrow batches; `chunks` cuts a batch into runs of whole documents of a few MB, so
that the temporary arrays of a task stay small however many rows a batch has.  A text is never
split: one very long document makes one chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
#: The prime modulus of span hashes and their two bases: two residues of 31 bits make a hash of 62.
PRIME = (1 << 31) - 1
BASES = (0x5F3759DF, 0x2545F491)
BLOCK = 1 << 15
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_LOW = np.uint64(PRIME)


def table(pattern: Iterable[int]) -> np.ndarray:
    """A 256-entry boolean table that is true at the given byte values."""
    out = np.zeros(256, bool)
    out[list(pattern)] = True
    return out


#: White space of the word rules: space and 0x09-0x0D.
SPACE = table([0x20, *range(0x09, 0x0E)])
#: Maps A-Z to a-z and leaves every other byte alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads a 64-bit value over all its bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A random-looking odd 64-bit value for each byte, and for each byte after ASCII lower-casing.
BYTE = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
BYTE2 = mix(np.arange(1001, 1257, dtype=np.uint64)) | np.uint64(1)
BYTE_LOWER = BYTE[LOWER]


def _folded(x: np.ndarray) -> np.ndarray:
    """The same modulo PRIME and much smaller; works in place on a fresh array."""
    over = x >> np.uint64(31)
    x &= _LOW
    x += over
    return x


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo PRIME for i < n."""
    if base not in _POW or len(_POW[base][0]) < n:
        size = max(n, CHUNK_BYTES + 4096)
        both = []
        for step in (base, pow(base, -1, PRIME)):
            out = np.ones(1, np.uint64)
            while len(out) < size:
                out = np.concatenate([out, out * np.uint64(pow(step, len(out), PRIME)) % np.uint64(PRIME)])
            both.append(out[:size])
        _POW[base] = both[0], both[1]
    return _POW[base]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums, a row for each base, from which `span_hash` reads the hash of any span of the values.

    The values' low and high 31 bits are coefficients of polynomials over a prime field.  (Modulo a power of
    two there are short texts that collide under every base.)
    """
    n = len(values)
    out = np.zeros((2, n + 1), np.uint64)
    for sums, base, shift in zip(out, BASES, (0, 33), strict=True):
        power = powers(base, n)[0]
        for i in range(0, n, BLOCK):  # blocks stay in the cache
            j = min(n, i + BLOCK)
            part = _folded((values[i:j] >> np.uint64(shift) & _LOW) * power[i:j])
            part[0] += sums[i]
            np.cumsum(part, out=sums[i + 1 : j + 1])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes, from 62 bits and the length, of the spans [start, end), the same wherever a span lies."""
    inverse = [powers(base, sums.shape[1])[1] for base in BASES]
    out = np.empty(len(start), np.uint64)
    for i in range(0, len(start), BLOCK):
        a, b = start[i : i + BLOCK], end[i : i + BLOCK]
        high, low = (_folded(_folded(_folded(s[b] - s[a])) * inv[a]) % np.uint64(PRIME) for s, inv in zip(sums, inverse, strict=True))
        out[i : i + BLOCK] = mix((high << np.uint64(31) | low) + (b - a).astype(np.uint64) * BASE)
    return out


def window_hash(values: np.ndarray, doublings: int) -> np.ndarray:
    """Hashes of all windows of 2**doublings values.  Meant for short windows: modulo 2**64, texts that
    collide whatever the base have a thousand values and more."""
    out = values
    for k in range(doublings):
        out = out[: -(1 << k)] * np.uint64(pow(int(BASE), 1 << k, 1 << 64)) + out[1 << k :]
    return mix(out)


def chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES, column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows with their text (or binary column) as bytes and row offsets; null counts as empty."""
    for batch in batches:
        text = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
        if not len(text):
            continue
        offs = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None and text.buffers()[2].size else np.zeros(0, np.uint8)
        i = 0
        while i < len(text):
            j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
            yield batch.slice(i, j - i), data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            i = j


def runs(mask: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values that stay inside a row."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1] | edge[1:n]
    last[:-1] &= ~mask[1:] | edge[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def per_row(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of the values of each row."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def grams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words inside a row, and the index of each one's first word.

    `first` holds each row's first word and, at its end, the number of words.
    """
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out *= BASE
        out += hashes[k : len(hashes) - n + 1 + k]
    inside = np.ones(len(out), bool)
    for k in range(1, n):  # a window may not reach over a row's end
        cut = first[1:-1] - k
        inside[cut[(cut >= 0) & (cut < len(out))]] = False
    at = np.flatnonzero(inside)
    return mix(out[at]), at


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices start[i] .. start[i] + length[i] - 1 of all i, one after another."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)
