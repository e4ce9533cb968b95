"""Slow, plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def low(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def repeats(docs: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    raw = [(t or "").encode() for t in docs]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def without_passages(docs: list[str | None], length: int, words: int) -> list[str | None]:
    """Each text without its runs of repeated strings that hold so many words, whole or in part."""
    raw = [(t or "").encode() for t in docs]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out: list[str | None] = []
    for t, b in zip(docs, raw, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        cut = [(m.start(), m.end()) for m in re.finditer(b"\x01+", bytes(gone))]
        cut = [(x, y) for x, y in cut if sum(1 for m in re.finditer(rb"[^\x20\x09-\x0D]+", b) if m.start() < y and m.end() > x) >= words]
        kept = b"".join(b[i : i + 1] for i in range(len(b)) if not any(x <= i < y for x, y in cut))
        out.append(t if t is None or not cut else kept.decode(errors="ignore"))
    return out


def quality(text: str | None) -> tuple[int, int, int, int, int, bool]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in lines
            lines.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered), failed


def item_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def leaks(docs: list[str | None], items: list[tuple[int, str | None]], size: int = 10) -> list[tuple[int, int, int, str, bool]]:
    windows: dict[tuple, set[str]] = defaultdict(set)
    for i, text in items:
        w = item_words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(str(i))
    out = []
    for text in docs:
        w, hit, found = item_words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if at := windows.get(tuple(w[k : k + n])):
                    found |= at
                    hit.update(range(k, k + n))
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def shingles(text: str | None, n: int = 5) -> set[tuple]:
    w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def components(docs: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t) for d, t in docs.items()}
    parent = {d: d for d in docs}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in docs}
