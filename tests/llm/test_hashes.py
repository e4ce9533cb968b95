"""Texts that collide under polynomial hashes modulo powers of two, and rows that share an id."""

import hashlib

import numpy as np
import public_tokenizers
import pytest

from hexfield.llm import bpe, decontaminate, near_duplicates, quality, repeats
from hexfield.llm.text import BYTE, prefix, span_hash

from . import brute


def thue_morse(n, zero, one):
    return "".join(one if bin(i).count("1") % 2 else zero for i in range(n))


@pytest.fixture(scope="module")
def pairs():
    """Words of 1 to 8 KB beside their complements."""
    return [(thue_morse(n, "a", "b"), thue_morse(n, "b", "a")) for n in (1024, 2048, 4096, 8192)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def rows(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.select("doc_id", *columns).collect()}


def test_spans_differ(pairs):
    for x, y in pairs:
        buf = np.frombuffer((x + y + x).encode(), np.uint8)
        n = len(x)
        first, second, third = span_hash(prefix(BYTE[buf]), np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n])).tolist()
        assert first == third != second


def test_near_duplicates_and_repeats(spark, pairs):
    texts = [f"{w} one two three four {w}" for pair in pairs for w in pair]
    assert rows(near_duplicates.near_duplicates(frame(spark, texts)), "n_shingles", "component_id") == brute.components(dict(enumerate(texts)))
    found = rows(repeats.repeat_digests(frame(spark, texts)), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == dict(enumerate(brute.repeats(texts, 400)))


def test_quality_lines(spark, pairs):
    texts = [f"{x}\n{y}\n{x}" for x, y in pairs]
    measured = quality.measure(frame(spark, texts), public_tokenizers.path("piece_bpe_32k.model"))
    assert rows(measured, "n_dup_lines") == {i: (1,) for i in range(len(texts))}


def test_leaks(spark, pairs):
    texts, items = [x for x, _ in pairs], [(i, y) for i, (_, y) in enumerate(pairs)]
    found = rows(decontaminate.digest(decontaminate.hits(frame(spark, texts), spark.createDataFrame(items, "item_id int, text string"))), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert found == dict(enumerate(brute.leaks(texts, items)))
    assert not any(r[4] for r in found.values())


def test_encoding(spark, pairs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    texts = [w for pair in pairs[:2] for w in pair]
    want = {i: (hashlib.sha256(np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest(),) for i, t in enumerate(texts)}
    assert rows(bpe.digests(frame(spark, texts), public_tokenizers.path("word_bpe_49k.json")), "ids_sha256") == want


def test_one_of_each_decides_by_row(spark):
    """Texts that share an id are judged each by itself, also where an id stands for several groups."""
    words = [f"w{i}" for i in range(400)]
    a, tail, b, c = " ".join(words[:100]), " ".join([*words[:100], "tail"]), " ".join(words[200:300]), " ".join(words[300:])
    given = [(3, a), (5, tail), (5, b), (5, c), (7, b + " end"), (7, c), (7, c), (None, a), (8, ""), (8, None)]
    left = near_duplicates.one_of_each(spark.createDataFrame(given, "doc_id long, text string"))
    assert sorted(map(repr, map(tuple, left.collect()))) == sorted(map(repr, [(3, a), (5, b), (5, c), (None, a), (8, ""), (8, None)]))
    found = near_duplicates.near_duplicates(spark.createDataFrame(given, "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found.collect()) == sorted([(3, 3), (5, 3), (5, 5), (5, 5), (7, 5), (7, 5), (7, 5), (0, 0), (8, 8), (8, 8)])


def test_spans_and_rules_of_pages():
    """Row and column spans take time in proportion to a page's length, columns keep their widths, later rules count."""
    import time

    from hexfield.llm.html_text import page_text

    def seconds(k, cell):
        began = time.perf_counter()
        page_text("<table>" + "".join(f"<tr>{cell(i)}</tr>" for i in range(k)) + "</table>")
        return time.perf_counter() - began

    for cell in (lambda i: "<td rowspan=65534 colspan=1000>x</td>", lambda i: f"<td rowspan={1000 + i % 7} colspan=3>x</td>", lambda i: f"<td rowspan={2 + i % 5}>x</td><td colspan=900 rowspan=2>y</td>"):
        assert seconds(4000, cell) < 12 * max(seconds(1000, cell), 0.02)
    wide = "w" * 100
    lines = page_text(f"<table><tr><td>{wide}<td>b<tr><td>a<td>c</table>").split("\n")
    assert lines == [f"{wide}  b", "a" + " " * 101 + "c"]
    assert page_text("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>").split("\n") == ["a  b", "   c", "d  e"]
    shown = "<style>.a{display:none}.a{display:block}#b{display:none}p{visibility:hidden}.v{visibility:visible}</style><div class=a>one</div><div id=b class=a>two</div><p>three</p><p class=v>four</p><div class=a style='display:none'>five</div><div id=b style='display: block'>six</div>"
    assert page_text(shown).split() == ["one", "four", "six"]
