"""The prefix trie against a plain version, awkward rows among them."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from hexfield.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, p1 string"


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(of) - 1) * len(node[-1][1].encode()) if node else 0
    out = set()
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if built[c] == node)
        out.add((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out, sum(map(len, built.values()))


@pytest.fixture(scope="module")
def rows():
    out = []
    for c in range(120):  # copies, shared starts, and conversations that begin others
        for t in range((c * 7) % 12):
            out.append((c, t, ("user", "assistant")[t % 2], f"{'hello' if t < 3 else c % 4} ü {t}" if c % 3 else f"same {t}"))
    for t in range(300):  # one conversation holds most rows
        out.append((1000, t, "user", f"long {t % 50}"))
    return out + [
        (None, 1, "user", "no id"), (200, None, "user", "null turn"), (200, 1, None, "null role"), (200, 1, "user", None), (200, 1, "user", None), (200, 1, "a", ""),
        (201, 5, "user", "x" * 100_000), (202, 5, "user", "x" * 100_000), (203, 0, "us", "erx"), (204, 0, "user", "x"), (9_000_000_000, 1, "user", "hello ü 0"),
    ]


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_against_plain_version(spark, rows, partitions):
    """Few and many partitions, so that the long conversation spans several of them."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        df = spark.createDataFrame([(*r, 3, "p") for r in rows], SCHEMA)
        found = prefix_trie.prefix_trie(df)
        assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        got = [tuple(r) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want, _ = plain(rows)
    assert set(got) == want and len(got) == len(want)


def test_empty_and_turnless(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = [(c, 0, "user", "only") for c in (11, 12, 13, 14)]  # without the first of the family, short ones are rebuilt without turns
    df = spark.createDataFrame([(*r, 0, "") for r in lone], SCHEMA)
    assert {tuple(r) for r in prefix_trie.prefix_trie(df).collect()} == plain(lone)[0]
