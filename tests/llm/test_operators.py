"""The operators against brute force, round trips and held-out accuracy, and on awkward inputs."""

import hashlib
import random
import re
import struct
import time
from functools import cache
from html.parser import HTMLParser
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from hexfield.llm import bpe, decontaminate, html_text, licenses, near_duplicates, quality, repeats, token_counts, tool_calls, toxicity

from . import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD, PIECE = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["the", "an", "wh", "tion", "é", "ing", "o", "X"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def awkward() -> list[str | None]:
    rng = random.Random(3)
    passage = prose(rng, 90)
    texts: list[str | None] = [None, "", " \n\t ", "x", "a b c", "a b c", "ab " * 400, "zz" * 700, "zz" * 900, "\n".join(["same line here"] * 30), passage, passage, passage.upper(), "é" * 500 + passage, "中文 текст ½ ﬁ \u0000 <|endoftext|> it's", prose(rng, 6000)]
    for i in range(12):
        texts.append(prose(rng, 20 + 15 * i) + "\n" + (passage if i % 2 else "") + " " + prose(rng, 10))
    base = prose(rng, 60).split()
    for i in range(8):
        w = list(base)
        for _ in range(i):
            w[rng.randrange(len(w))] = prose(rng, 1)
        texts.append(" ".join(w))
    return texts


@pytest.fixture(scope="session")
def docs(spark, awkward):
    return spark.createDataFrame([(i, t, [None, "en", "de", "zz"][i % 4], "s", len(t) if t is not None else None) for i, t in enumerate(awkward)], DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df):
    """Columns named as those that operators use inside."""
    for c in ("row", "tag", "trigger", "n_words", "kept", "spans", "digest", "ids", "score", "n", "component_id", "n_hit"):
        df = df.withColumn(c, F.lit("mine"))
    return df


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_repeats(docs, awkward):
    got = by_id(repeats.drop_repeats(docs.select("doc_id", "text"), with_text=False).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
    want = brute.repeats(awkward, repeats.LENGTH)
    assert [tuple(got[i])[1:] for i in range(len(awkward))] == want
    assert sum(w[1] for w in want) > 0


def digests(df):
    got = sorted(df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    return [tuple(r)[1:] for r in got]


def test_repeat_digests(docs, awkward):
    assert digests(repeats.repeat_digests(docs)) == brute.repeats(awkward, repeats.LENGTH)


@pytest.fixture(scope="session")
def contexts() -> list[str]:
    """A passage in different surroundings, parts of it, and near copies: many phrases share a trigger."""
    rng = random.Random(11)
    passage, texts = prose(rng, 110), []
    for i in range(60):
        cut = passage[rng.randrange(80) : len(passage) - rng.randrange(80)] if i % 2 else passage
        texts.append(prose(rng, rng.randint(0, 40)) + cut + prose(rng, rng.randint(0, 40)))
    for _ in range(10):
        k = rng.randrange(len(passage))
        texts.append(passage[:k] + "#" + passage[k:])
    return texts


def test_repeats_with_many_phrases_under_a_trigger(spark, contexts, monkeypatch):
    df = spark.createDataFrame(list(enumerate(contexts)), "doc_id long, text string")
    want = brute.repeats(contexts, repeats.LENGTH)
    assert digests(repeats.repeat_digests(df)) == want
    # the order of the suffixes decides: without its refinement spans go missing
    monkeypatch.setattr(repeats, "_refined", lambda dictionary, length: [])
    assert sum(x[1] for x in digests(repeats.repeat_digests(df))) < sum(w[1] for w in want)


def test_passages(spark):
    rng = random.Random(5)
    passage, short = " ".join(prose(rng, 52).split()[:52]), " ".join(prose(rng, 30).split()[:30])
    own = [prose(rng, 80) for _ in range(4)]
    texts = [own[0] + " " + passage + " " + own[1], passage + " " + own[2], own[3] + " " + short, short]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = by_id(repeats.repeat_digests(df))
    assert [rows[i].n_passages for i in range(4)] == [1, 1, 0, 0] and 51 <= rows[0].passage_words <= 54
    out = by_id(repeats.without_passages(df))
    assert out[0].text.startswith(own[0]) and passage[5:-5] not in out[0].text and out[2].text == texts[2] and out[3].text == short


def test_repeats_of_rows_with_the_same_or_no_id(spark):
    text = prose(random.Random(1), 200)
    df = spark.createDataFrame([(1, text), (1, text), (None, text + "tail"), (2, "short"), (2, None)], "doc_id long, text string")
    got = sorted((r["row"]["doc_id"] or 0, r["n_removed"], r["n_bytes"]) for r in repeats.drop_repeats(df).collect())
    n = len(text.encode())
    assert got == [(0, n, n + 4), (1, n, n), (1, n, n), (2, 0, 0), (2, 0, 5)]


def test_without_passages_keeps_columns(docs):
    wide = clashing(docs)
    out = repeats.without_passages(wide)
    assert out.columns == wide.columns and out.count() == wide.count()
    rows = by_id(out)
    assert rows[0].text is None and rows[10].text == "" and rows[10].n_chars == 0 and rows[3].trigger == "mine"


def test_quality(docs, awkward):
    got = by_id(quality.verdict(quality.measure(docs.select("doc_id", "text", "lang"), PIECE)))
    for i, t in enumerate(awkward):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(t), i
        assert not (r.base_failed and r.kept)


def test_quality_measures_by_hand(spark):
    text = "thanon ering, thanon œ中 stion"
    r = quality.measure(spark.createDataFrame([(text,)], "text string"), PIECE).first()
    model = SentencePieceProcessor(model_file=PIECE)
    ids = [i for w in text.split() for i in model.encode(w)]
    share = [ids.count(i) / len(ids) for i in set(ids)]
    assert r.n_tokens == len(ids) and r.byte_share == pytest.approx(sum(map(model.is_byte, ids)) / len(ids))
    assert r.entropy == pytest.approx(-sum(p * np.log2(p) for p in share) / np.log2(len(ids)))


def test_quality_bands(spark):
    df = spark.createDataFrame([("en", 100, 0, 2.2, 0.0, 0.7), ("en", 100, 0, 1.0, 0.0, 0.7), ("en", 100, 0, 2.2, 0.9, 0.7), ("en", 100, 0, 2.2, 0.0, 0.05), (None, 100, 0, 2.2, 0.0, 0.7), ("en", 100, 31, 2.2, 0.0, 0.7)], "lang string, n_words long, n_repeat_words long, chars_per_token double, byte_share double, entropy double").withColumn("n_tokens", F.lit(1000))
    assert [r.kept for r in quality.verdict(df).collect()] == [True, False, False, False, True, False]


#: Clean prose, the second English passage in unusually long words.
REAL_PROSE = [
    ("en", "The city council voted on Tuesday to approve a new budget that includes more money for public schools, road repairs and emergency services. Officials said the spending plan would not require an increase in property taxes, although several members warned that future growth could be slower than expected. Residents who attended the meeting asked why the proposed library had been delayed again, and the mayor promised that construction would begin before the end of the year."),
    ("en", "Notwithstanding considerable administrative responsibilities, international organisations increasingly acknowledge environmental sustainability, technological infrastructure, educational opportunities and governmental accountability as fundamental requirements. Consequently, interdisciplinary investigations concerning pharmaceutical manufacturing, telecommunications regulation and agricultural productivity demonstrate significant institutional transformation throughout developing countries."),
    ("de", "Der Stadtrat hat am Dienstag einen neuen Haushalt beschlossen, der mehr Geld für öffentliche Schulen, Straßen und Rettungsdienste vorsieht. Nach Angaben der Verwaltung müssen die Steuern dafür nicht erhöht werden, doch mehrere Mitglieder warnten, dass das Wachstum in den kommenden Jahren langsamer ausfallen könnte als erwartet. Bürger fragten, warum sich der Bau der Bibliothek erneut verzögert habe, und die Bürgermeisterin versprach, dass die Arbeiten noch vor dem Ende des Jahres beginnen."),
    ("es", "El ayuntamiento aprobó el martes un nuevo presupuesto que incluye más dinero para las escuelas públicas, la reparación de carreteras y los servicios de emergencia. Los responsables dijeron que el plan no exigirá un aumento de los impuestos, aunque varios concejales advirtieron de que el crecimiento podría ser más lento de lo esperado. Los vecinos que asistieron a la reunión preguntaron por qué se había retrasado otra vez la biblioteca, y la alcaldesa prometió que las obras comenzarán antes de que termine el año."),
    ("fr", "Le conseil municipal a adopté mardi un nouveau budget qui prévoit davantage de moyens pour les écoles publiques, la réparation des routes et les services de secours. Les responsables ont indiqué que ce plan ne demanderait pas de hausse des impôts, mais plusieurs élus ont averti que la croissance pourrait être plus lente que prévu. Les habitants présents à la réunion ont demandé pourquoi la bibliothèque avait encore pris du retard, et la maire a promis que les travaux commenceraient avant la fin de l'année."),
]


def test_quality_keeps_real_prose(spark):
    got = quality.verdict(quality.measure(spark.createDataFrame(REAL_PROSE, "lang string, text string"), PIECE))
    assert [r.kept for r in got.collect()] == [True] * len(REAL_PROSE)
    long = quality.verdict(got.drop("base_failed", "kept").withColumn("n_tokens", F.lit(10**6)))
    assert [r.kept for r in long.collect()] == [True] * len(REAL_PROSE)


def test_quality_keeps_columns(docs, empty):
    wide = clashing(docs)
    assert quality.keep_good(wide, PIECE).columns == wide.columns
    assert quality.keep_good(empty, PIECE).count() == 0


def test_token_counts(docs, awkward, tmp_path):
    path = f"file://{tmp_path}/cache"
    got = by_id(token_counts.count_tokens(docs, PIECE, path))
    model = SentencePieceProcessor(model_file=PIECE)
    assert [(got[i].n_bytes, got[i].n_tokens) for i in range(len(awkward))] == [(len((t or "").encode()), len(model.encode(t or ""))) for t in awkward]
    cached = docs.sparkSession.read.parquet(path)
    first = cached.count()
    assert first == len({t or "" for t in awkward}) == cached.select("digest").distinct().count()
    more = docs.limit(5).union(docs.sparkSession.createDataFrame([(99, "new text", "en", "s", 8)], DOCS))
    assert by_id(token_counts.count_tokens(more, PIECE, path))[99].n_tokens == len(model.encode("new text"))
    assert docs.sparkSession.read.parquet(path).count() == first + 1
    token_counts.count_tokens(more, WORD, path).collect()  # another tokenizer shares no counts
    assert docs.sparkSession.read.parquet(path).select("version").distinct().count() == 2


def test_token_counts_of_rows_with_the_same_or_no_id(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "other"), (None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted((r.n_bytes, r.n_tokens > 0) for r in token_counts.count_tokens(df, PIECE).collect()) == [(0, False), (3, True), (3, True), (3, True), (5, True)]


@cache
def library() -> Tokenizer:
    return Tokenizer.from_file(WORD)


def expected(text: str | None) -> tuple[int, str, str]:
    t = library()
    ids = t.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(b"".join(struct.pack("<I", i) for i in ids)).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe(spark, docs, awkward):
    got = by_id(bpe.digests(docs, WORD))
    assert [tuple(got[i])[1:] for i in range(len(awkward))] == [expected(t) for t in awkward]
    rng = random.Random(5)
    letters = "aAbBsStTrReEvVlLmMdD''' '  \n\t019²½ªºµİıÀéß \u0085\x0b\x1c!?-_<|>endoftext~ñŒœŽžǅ中ǆȀɐΑς​　Ⅷ𝒳ſ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(1500)] + ["'", "'s", "a'", "!'s", "''s", "we're I'll", "<|endoftext|>", "<|endoftext|", "a<|startoftext|>b", "ΑΣ"]
    got = by_id(bpe.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), WORD))
    assert [tuple(got[i])[1:] for i in range(len(texts))] == [expected(t) for t in texts]


def test_lexicon_is_minimal_and_exact():
    vocab = bpe.vocabulary(WORD)
    words = [b"walking", b"talking", b"walked", b"talked", b"walk", b"\xc3\xa9t\xc3\xa9", b"a"]
    lexicon = bpe.Lexicon(bpe.compile_lexicon({w: vocab.merge(w) for w in words}))
    found = lexicon.find([*words, b"walki", b"b", b"", b"walkings"])
    assert (found[: len(words)] >= 0).all() and (found[len(words) :] < 0).all()
    for w, k in zip(words, found, strict=False):
        assert lexicon.ids[lexicon.starts[k] : lexicon.starts[k + 1]].tolist() == vocab.merge(w)
    assert sorted(found[: len(words)]) == list(range(len(words)))
    shared = len(lexicon.final)
    assert shared < len({w[:i] for w in words for i in range(len(w) + 1)})  # a trie has a state for each prefix
    nothing = bpe.Lexicon(bpe.compile_lexicon({}))
    assert nothing.find([b"a"]).tolist() == [-1]


def test_words_merged_together_as_singly():
    vocab, rng = bpe.vocabulary(WORD), np.random.default_rng(7)
    words = [bytes(rng.choice(np.frombuffer(letters, np.uint8), n)) for letters in (b"ab", b"etaoinshr", bytes(range(256))) for n in [1, 2, 7, 8, 9, 16, 17, 31, 32, 33, 200] for _ in range(40)]
    words += [b"internationalisation", b"aaaaaaaaaaaaaaaa", b"ha" * 16]
    for some in (words, words[:1], []):
        length, ids = vocab.merge_all(some)
        assert [x.tolist() for x in np.split(ids, np.cumsum(length)[:-1])] == [vocab.merge(w) for w in some] or not some
        assert len(length) == len(some) and length.sum() == len(ids)


def test_bpe_round_trip(spark):
    text = "plain words here and there"
    r = bpe.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), WORD).first()
    assert r.decoded.replace(" ", "").replace("</w>", " ").strip() == text and len(r.ids) == r.n_tokens


@pytest.fixture(scope="session")
def items(awkward):
    words = awkward[10].split()
    return [(1, " ".join(words[5:20])), (2, " ".join(words[12:40]).upper()), (3, "The, AN"), (4, None), (5, "..."), (6, " ".join(words[5:20])), (10, "never seen words in here at all ok yes no maybe")]


def test_leaks(spark, docs, awkward, items, monkeypatch):
    table = spark.createDataFrame(items, "item_id int, text string")
    got = by_id(decontaminate.digest(decontaminate.hits(docs.select("doc_id", "text"), table)))
    want = brute.leaks(awkward, items)
    assert [tuple(got[i])[1:] for i in range(len(awkward))] == want and any(w[4] for w in want)
    monkeypatch.setattr(decontaminate, "PART_BYTES", 60)
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 120)
    parts = by_id(decontaminate.digest(decontaminate.hits(docs.select("doc_id", "text"), table)))
    assert parts == got


def test_leaks_against_random_items(spark):
    rng = random.Random(9)
    word = lambda: rng.choice("a b c d".split())
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 6, 14, 25])))) for i in range(12)]
    texts = [" ".join(word() for _ in range(rng.randint(0, 120))) for _ in range(60)] + [items[3][1] + " " + items[5][1]]
    got = by_id(decontaminate.digest(decontaminate.hits(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string"))))
    assert [tuple(got[i])[1:] for i in range(len(texts))] == brute.leaks(texts, items)


def test_decontaminate(spark, docs, items, awkward):
    table = spark.createDataFrame(items[:2], "item_id int, text string")
    wide = clashing(docs)
    out = decontaminate.decontaminate(wide, table)
    assert out.columns == wide.columns
    left, want = by_id(out), brute.leaks(awkward, items[:2])
    assert set(left) == {i for i, w in enumerate(want) if w[1] <= 0.5 * w[0]}
    for i, r in left.items():
        assert (r.text == awkward[i]) == (not want[i][4])
        if want[i][4]:
            assert r.n_chars == len(r.text) and len(brute.item_words(r.text)) == want[i][0] - want[i][1]
    none = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.decontaminate(docs, none).count() == docs.count()


def test_near_duplicates(docs, awkward):
    got = by_id(near_duplicates.near_duplicates(docs))
    want = brute.components(dict(enumerate(awkward)))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    kept = {r.doc_id for r in near_duplicates.one_of_each(clashing(docs)).collect()}
    assert kept == {i for i, (_, c) in want.items() if i == c}


@pytest.fixture(scope="module")
def chains() -> dict[int, str]:
    """Each text differs from the next by little and from later ones by more; blocks span components."""
    rng = random.Random(11)
    texts: dict[int, str] = {}
    for group in range(6):
        words = [f"g{group}w{i}" for i in range(80)]
        for k in range(12):
            texts[group * 100 + k] = " ".join(words)
            for _ in range(1 + group % 3):
                words[rng.randrange(80)] = f"n{rng.random()}"
    common = " ".join(f"c{i}" for i in range(45))
    for k in range(30):  # a shared passage makes up over half of these, which do not link
        texts[1000 + k] = common + " " + " ".join(f"u{k}_{i}" for i in range(16))
    return texts


def components_of(spark, texts):
    got = by_id(near_duplicates.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    return {i: (r.n_shingles, r.component_id) for i, r in got.items()}


@pytest.mark.parametrize(("cell", "partners"), [(2048, 16), (3, 16), (2048, 1)])
def test_near_duplicates_in_chains(spark, chains, monkeypatch, cell, partners):
    monkeypatch.setattr(near_duplicates, "CELL", cell)
    monkeypatch.setattr(near_duplicates, "PARTNERS", partners)
    assert components_of(spark, chains) == brute.components(chains)


def test_links_are_lost_without_the_trees(spark, monkeypatch):
    core = " ".join(f"h{i}" for i in range(84))
    texts = {k: core + " " + " ".join(f"o{k}_{i}" for i in range(20)) for k in range(160)}  # link with nothing, but are the least of the blocks
    texts |= {200 + k: core + " " + " ".join(f"e{k}_{i}" for i in range(8)) for k in range(2)}
    want = brute.components(texts)
    assert components_of(spark, texts) == want and want[201][1] == 200
    monkeypatch.setattr(near_duplicates, "_across", lambda partners: lambda batches: iter(()))
    assert components_of(spark, texts)[201][1] == 201


def test_a_tree_names_a_pair_once(spark, chains):
    """Every pair comes out of the first block that both lie in."""
    out = near_duplicates._sketch([pa.record_batch({"doc_id": pa.array(list(chains)), "text": pa.array(list(chains.values()))})])
    table = pa.Table.from_batches(list(out))
    bands = np.array(table["bands"].combine_chunks().flatten()).reshape(len(chains), -1)
    found = []
    for b in sorted(set(bands.ravel().tolist())):
        at = np.flatnonzero((bands == b).any(1))
        if len(at) < 2:
            continue
        node = np.array(list(chains))[at]
        part = pa.table({"block": pa.array([b] * len(at)), "one": pa.array([0] * len(at)), "two": pa.array([0] * len(at)), "side": pa.array([0] * len(at)), "node": pa.array(node), "n": table["n"].combine_chunks().take(pa.array(at)), "pivot": pa.array([-1] * len(at)), "component": pa.array(node), "bitmap": table["bitmap"].combine_chunks().take(pa.array(at)), "bands": table["bands"].combine_chunks().take(pa.array(at))})
        for x in near_duplicates._across(1000)(part.to_batches()):
            found += list(zip(x["a"].to_pylist(), x["b"].to_pylist(), strict=True))
    assert len(found) == len(set(found)) > 0


def test_near_duplicates_of_rows_with_the_same_or_no_id(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "A B c d e f"), (8, None), (9, "")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in near_duplicates.near_duplicates(df).collect()) == [(0, 0), (5, 5), (5, 5), (7, 5), (8, 8), (9, 9)]


def test_signature_tree_loses_no_pair():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(40):
        base = rng.choice(3000, rng.integers(5, 300), replace=False)
        for _ in range(rng.integers(1, 6)):
            sets.append({int(x) if rng.random() > 0.04 else int(rng.integers(3000, 9000)) for x in base})
    bits = np.zeros((len(sets), near_duplicates.BITS), bool)
    for i, s in enumerate(sets):
        bits[i, [x % near_duplicates.BITS for x in s]] = True
    bitmap = np.frombuffer(np.packbits(bits, axis=1).tobytes(), np.uint64).reshape(len(sets), -1)
    x, y, _ = near_duplicates.Tree(np.array([len(s) for s in sets]), bitmap, np.arange(len(sets))).pairs()
    found = {(min(a, b), max(a, b)) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    want = {(b, a) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert want <= found and len(found) < len(sets) * (len(sets) - 1) / 4


def test_toxicity_labels_that_repeat(spark):
    texts = spark.createDataFrame([(i, "good text here" if i % 2 else "vile text here") for i in range(40)] + [(1, None), (2, "a")], "doc_id long, text string")
    labels = [(i, 1 - i % 2) for i in range(40)] + [(i, 0) for i in range(0, 40, 4)] + [(None, 1), (3, None)]
    forward, backward = (spark.createDataFrame(x, "doc_id long, toxic int") for x in (labels, labels[::-1]))
    one, two = (toxicity.fit(texts, x) for x in (forward, backward))
    assert np.array_equal(one[0], two[0]) and one[1] == two[1]
    scored = by_id(toxicity.score(texts.filter("doc_id > 3").withColumn("Score", F.lit("mine")), one))
    assert scored[4].score > 0.5 > scored[5].score
    assert np.isfinite(toxicity.fit(texts, forward, most_bytes=10)[1])


def test_added_columns_replace_those_of_their_names(spark, docs, items):
    wide = docs.withColumns({c: F.lit("mine") for c in ("score", "ids", "N_tokens", "n_hit", "spans", "n_words", "n_lines")})
    assert bpe.encode(wide, WORD).select("ids", "n_tokens").dtypes == [("ids", "array<int>"), ("n_tokens", "bigint")]
    assert sum(r.n_hit for r in decontaminate.hits(wide, spark.createDataFrame(items, "item_id int, text string")).collect()) > 0
    assert quality.measure(wide, PIECE).select("n_words").dtypes == [("n_words", "bigint")]
    assert html_text.extract_text(wide.withColumnRenamed("text", "html")).select("n_lines", "text").dtypes[0] == ("n_lines", "bigint")


def test_operators_on_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.hits(empty, none).count() == 0
    assert {r.n_hit for r in decontaminate.hits(docs, none).collect()} == {0}
    model = toxicity.fit(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(empty, model).count() == 0
    assert repeats.repeat_digests(empty).count() == 0
    assert tool_calls.link_calls(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_token_cache_with_double_entries(spark, docs, tmp_path):
    path = f"file://{tmp_path}/cache"
    first = sorted(token_counts.count_tokens(docs, PIECE, path).collect(), key=lambda r: r.doc_id)
    spark.read.parquet(path).write.mode("append").parquet(path)  # another run added the same
    assert sorted(token_counts.count_tokens(docs, PIECE, path).collect(), key=lambda r: r.doc_id) == first


def test_toxicity_generalises_to_misspellings():
    rng = random.Random(2)
    bad = ["idiotic", "worthless", "disgusting"]
    texts = [prose(rng, 40) for _ in range(400)]
    labels = np.array([i % 2 for i in range(400)], float)
    texts = [t + " " + " ".join(rng.choice(bad) for _ in range(3)) if y else t for t, y in zip(texts, labels, strict=True)]
    vectors, softmax, bias = toxicity.train(texts, labels, np.ones(400))

    class Model:
        value = (vectors.astype(float) @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0]))

    import pyarrow as pa

    test = [prose(rng, 40) + " idiotik worthles disgustingg", prose(rng, 40), None, ""]
    s = np.concatenate([b.column("score").to_numpy() for b in toxicity._score(Model)([pa.record_batch({"text": pa.array(test, pa.string())})])])
    assert s[0] > 0.5 > s[1] and 0 <= s[2] == s[3] <= 1


def test_toxicity_query(spark, sf):
    rows = {r.doc_id: r for r in toxicity.op2_toxicity(spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(rows[d].score, y) for d, y in labels.items() if d in rows and rows[d].held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    pairs = [(a > b) + (a == b) / 2 for a, y in held for b, z in held if y == 1 and z == 0]
    assert not pairs or sum(pairs) / len(pairs) > 0.6


def test_toxicity_without_labels(spark, docs):
    for rows, share in (([], 0.0), ([(1, 1), (2, 1)], 1.0)):
        model = toxicity.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert {round(r.score, 6) for r in toxicity.score(docs.select("doc_id", "text"), model).collect()} == {share}


CALLS = [
    ("c", 1, "assistant", '{"tool_calls":[{"id":"a","name":"answer","arguments":{"prompt":"x \\"q\\"","words":2}},{"id":"b","name":"revise","arguments":{"prompt":null,"words":"two","odd":1},"after":["a"]}]}'),
    ("c", 2, "tool", '{"tool_call_id":"a","content":"r\\n1"}'),
    ("c", 3, "tool", '{"tool_call_id":"a","content":"later"}'),
    ("c", 4, "assistant", '{"tool_calls":[{"id":"x","name":"gone","arguments":{},"after":["y"]},{"id":"y","name":"answer","after":["x"]},{"id":"z","name":"answer","arguments":{"prompt":"p","words":1},"after":["a","b"]},{"id":"u","name":"answer","arguments":{"prompt":"p","words":1},"after":["nowhere"]}]}'),
    ("c", 0, "tool", '{"tool_call_id":"z","content":"too soon"}'),
    ("d", 0, "assistant", '{"tool_calls":[{"id":"a","name":"revise","arguments":{"prompt":"p","words":3}}]}'),
    ("c", 5, "user", None), ("c", 6, "user", "plain"), ("c", 7, "user", "{broken"), (None, 1, "user", "{}"),
]


def test_tool_calls(spark):
    df = spark.createDataFrame(CALLS, "conv_id string, turn int, role string, text string")
    got = {(r.conv_id, r.call_id): r for r in tool_calls.link_calls(df).collect()}
    assert {k: (r.level, r.status, r.problems) for k, r in got.items()} == {
        ("c", "a"): (0, "done", ""), ("c", "b"): (1, "open", "type:prompt,type:words,unknown:odd"), ("c", "x"): (None, "open", "tool"), ("c", "y"): (None, "open", "missing:prompt,missing:words"),
        ("c", "z"): (2, "early", ""), ("c", "u"): (None, "open", ""), ("d", "a"): (0, "open", ""),
    }
    assert got["c", "a"].call_json == '{"arguments":{"prompt":"x \\"q\\"","words":2},"id":"a","name":"answer","result":"r\\n1"}'
    assert got["c", "b"].call_json == '{"arguments":{"odd":1,"prompt":null,"words":"two"},"id":"b","name":"revise","result":null}'
    assert tool_calls.link_calls(df.limit(0)).count() == 0
    given = ['{"prompt":5,"words":1}', '{"prompt":"p","words":"12"}', '{"prompt":"p","words":1.5,"first":true}', '{"prompt":"p","words":123456789012345678901,"first":"yes"}', '["p"]', '"p"']
    more = spark.createDataFrame([("e", i, "assistant", f'{{"tool_calls":[{{"id":"{i}","name":"answer","arguments":{a}}}]}}') for i, a in enumerate(given)], "conv_id string, turn int, role string, text string")
    assert [r.problems for r in sorted(tool_calls.link_calls(more).collect(), key=lambda r: r.turn)] == ["type:prompt", "type:words", "type:words", "type:first", "missing:prompt,missing:words,object", "missing:prompt,missing:words,object"]


def test_html_table_strays():
    page = html_text.page_text
    assert page("a<table>text<tr><td>1</td><td>2</td></tr></table>b") == "a\ntext\n\n1  2\n\nb"
    assert page("<table><tr><div>foreign</div><td>1</td>x</tr>y<tbody>z<tr><td>2</td></tr></table>") == "foreign\nx y z\n\n1\n2"
    assert page("<table><form><tr><td>1</td></tr></form><tr><td>2</td></tr></table>") == "1\n2"
    assert page("<table><form>f<div><tr><form><td>1</td><td>2</td></form></tr></div></form></table>") == "f\n\n1  2"
    assert page("<table>\n <caption>c</caption>\n <form hidden><tr><td>1</td></tr></form> <tr><td>2</td> </tr></table>") == "c\n2"
    assert page("<table>" + "<div>" * 20000 + "<tr><td>1</td></tr>" + "</div>" * 20000 + "</table>") == "1"


@pytest.mark.parametrize("sheet,seen", [("<style>@media print{.a{color:red}.nav{display:none}}</style>", True), ("<style media=print>.nav{display:none}</style>", True), ("<style>@media (max-width:9px){p{color:red}.nav{display:none}} .b{display:none}</style>", True), ("<style>@media screen{p{color:red}.nav{display:none}}</style>", False), ("<style>@media print{.a{x:y}} .nav{display:none}</style>", False), ("<style media='screen, print'>/* } */ @import 'x'; .b, .nav {color:red; display:none</style>", False)])
def test_html_media(sheet, seen):
    assert html_text.page_text(f"{sheet}<p class=nav>menu</p><p>text</p>") == ("menu\n\ntext" if seen else "text")


HOSTILE = ["<table><tr><td>x</td></tr><caption>" * 3000, "<a x=1 " * 20000, "<a x=1 " * 20000 + '"', "<span>" * 5000 + "<tr>" * 5000, "<span>" * 10000 + "<br>z<hr>" * 5000, "<style " * 20000, "<style>a{" * 20000, "<ul><li>x" * 20000, "<table><tr><td>a<td>" * 8000, "<b>x</b>" * 50000, "<table><tr>" + "<td>a" * 1000 + "<td>" + "<br>x" * 10000, "<table>" + "<tr><td colspan=1000>a<td rowspan=60000>b" * 2000, "<table><tr><td>" + "y" * 100000 + "</td></tr>" + "<tr><td>a</td><td>b</td></tr>" * 5000]


@pytest.mark.parametrize("html", HOSTILE, ids=range(len(HOSTILE)))
def test_html_takes_time_in_proportion(html):
    began = time.process_time()
    text = html_text.page_text(html)
    assert time.process_time() - began < 5 and len(text) < 60 * len(html)


def test_html_spans():
    page = html_text.page_text
    assert page("<table><tr><td colspan=2>wide cell</td><td>c</td></tr><tr><td rowspan=2>one</td><td>two</td><td>three</td></tr><tr><td>x</td><td>y</td></tr></table>") == "wide cell  c\none  two  three\n     x    y"
    assert page("<table><tr><td rowspan=0>a<td colspan=x>b<tr><td>c<td>d</table>") == "a  b\nc  d"


class Words(HTMLParser):
    """The words outside elements that are not seen, in any order."""

    def __init__(self):
        super().__init__()
        self.words, self.unseen = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title", "head", "template", "noscript"):
            self.unseen += 1

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title", "head", "template", "noscript"):
            self.unseen -= 1

    def handle_data(self, data):
        if not self.unseen:
            self.words += data.split()


def test_html_loses_no_visible_word(spark, sf):
    """Against a plain walk over the pages of the table that hide nothing by rules, as wholes of letters."""
    rng = random.Random(8)
    made = []
    for _ in range(200):
        tags = rng.choices(["p", "div", "table", "tr", "td", "caption", "ul", "li", "b", "span", "pre", "h2", "blockquote", "dl", "dd", "a", "section"], k=rng.randint(1, 25))
        made.append("".join(rng.choice([f"<{t}>", f"</{t}>", f"<{t}> w{rng.randrange(99)} ", f" w{rng.randrange(99)}</{t}> "]) for t in tags))
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect() if r.html and "hidden" not in r.html and "none" not in r.html]
    for html in made + pages[:300]:
        walk = Words()
        walk.feed(html)
        walk.close()
        letters = lambda s: sorted(c for c in s if c.isalnum())
        got = html_text.page_text(html)
        marks = re.sub(r"(?m)^( *)(- |-?[0-9]+\. )+", "", got) if "<ol" in html or "<li" in html else got
        if "<ol" not in html:
            assert letters(marks) == letters("".join(walk.words)), html


WRAPPED = {
    "MIT": """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software without
   specific prior written permission.
""",
    "Apache-2.0": """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
""",
    "MPL-2.0": """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at http://mozilla.org/MPL/2.0/.
""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
""",
    "BSD-2-Clause": """Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
""",
}


def test_licences_in_wrapped_texts(spark):
    rows = [(n, t.replace("\n", end)) for n, t in WRAPPED.items() for end in ("\n", "\r\n")] + [("MIT", "Some title\nReleased under the MIT License\nmore")]
    got = {(r.doc_id, r.licenses) for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {(n, n) for n in WRAPPED}


COMMON = Path("/usr/share/common-licenses")
WHOLE = {"GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "Apache-2.0": "Apache-2.0", "MPL-2.0": "MPL-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0"}


@pytest.mark.skipif(not COMMON.exists(), reason="no licence texts on this machine")
def test_whole_licences_are_named_once(spark):
    rows = [(n, (COMMON / n).read_text(errors="replace")) for n in WHOLE if (COMMON / n).exists()]
    rows += [(n, f"{t}\n\n{t}") for n, t in rows]
    got = {(r.doc_id, r.licenses) for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {(n, WHOLE[n]) for n, _ in rows}


def test_rules_take_what_they_match(spark):
    """Against a plain reading of the rules."""
    rng = random.Random(4)
    ids = sorted({i for _, parts in licenses.LONG_RULES for i in parts if i.startswith(("bsd", "mit", "gpl3", "gnu"))})
    texts = [" \n\n".join(rng.choice(list(licenses.PUBLISHED[i])) for i in rng.choices(ids, k=rng.randint(0, 9))) for _ in range(150)]
    got = by_id(licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for i in range(len(texts)):
        left, named = got[i].sentence_ids.split(","), []
        for name, parts in licenses.RULES:
            hit = True
            at = 0
            while hit:
                found, k = [], at
                for p in parts:
                    k = next((j for j in range(k, len(left)) if left[j] == p), None)
                    if k is None:
                        break
                    found.append(k)
                    k += 1
                hit = len(found) == len(parts)
                if hit:
                    at = found[-1] + 1 - len(found)
                    left = [x for j, x in enumerate(left) if j not in found]
                    named += [name] if name not in named else []
        assert got[i].licenses == ",".join(named), texts[i]


def test_licences_in_sql(spark):
    import duckdb
    import pandas as pd

    documents = pd.DataFrame([*WRAPPED.items(), ("none", "A line.\nAnother"), ("null", None), ("notice", "x\nReleased under the MIT License\ny")], columns=["doc_id", "text"])
    con = duckdb.connect()
    con.register("documents", documents)
    got = licenses.scan(spark.createDataFrame([tuple(r) for r in documents.itertuples(index=False)], "doc_id string, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(licenses.OP6_SQL).fetchall())


def test_licences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions.\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    rows = [(1, "Hi! Released under the MIT License."), (2, mit), (3, "\n".join(reversed(mit.split("\n")))), (4, None), (5, ""), (6, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.\nReleased under the MIT License."), (7, "|a|b.c d.")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.licenses for i, r in got.items()} == {1: "MIT", 2: "MIT", 3: "", 4: "", 5: "", 6: "Apache-2.0,MIT", 7: ""}
    assert (got[6].n_known, got[6].sentence_ids, got[1].n_sentences, got[4].n_sentences) == (3, "apache2-notice,notice-mit,notice-mit", 2, 0)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p>a<p>b", "a\n\nb"),
        ("<ul><li>a<li>b<ol><li>c</ol></ul>", "- a\n- b\n  1. c"),
        ("<table><tr><td>aa<td>b<tr><td>c<td>dd</table>", "aa  b\nc   dd"),
        ("<div hidden>x</div><script>y</script>z<!-- c -->", "z"),
        ("<style>.k{display:none}</style><p class='a k'>x</p>y", "y"),
        ("<pre>\n a\n  b</pre>c", " a\n  b\n\nc"),
        ("a &amp; b&nbsp;c<br>d", "a & b\xa0c\nd"),
        ("<title>t</title>a<b>b</b></i></p>c", "abc"),
        ("<ol start=4><li>x</ol>", "4. x"),
        ("x" + "<div>" * 3000 + "y", "x\ny"),
        ("a < b", "a < b"),
    ],
)
def test_html(html, text):
    assert html_text.page_text(html) == text


def test_html_query(spark, sf):
    rows = html_text.op10_html_text(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/pages.parquet").count() and all("<p>" not in r.text and "track(" not in r.text and r.n_chars == len(r.text) for r in rows)


def test_empty_tables(empty, spark):
    assert repeats.without_passages(empty).count() == 0
    assert near_duplicates.one_of_each(empty).count() == 0
    assert token_counts.count_tokens(empty, PIECE).count() == 0
    assert bpe.digests(empty, WORD).count() == 0
    assert licenses.scan(empty).count() == 0
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, html string")).count() == 0
