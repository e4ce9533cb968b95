"""Every stage of the pipeline against brute force on what its predecessor kept."""

import corpus_pipeline
from hexfield.llm import queries, repeats

from . import brute
from .test_operators import DOCS, awkward, docs, expected, items  # noqa: F401  fixtures


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, docs, items, tmp_path):  # noqa: F811
    good = docs.filter("length(text) > 200 or text is null")
    good.write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame(items[:2], "item_id int, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    sf = f"file://{tmp_path}"
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "repeats", "decontamination", "tokens"]
    now = spark.read.parquet(f"{sf}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(stages.items()):
        before = texts(now)
        stage(spark, now, sf).write.parquet(f"{sf}/{i}")
        now = spark.read.parquet(f"{sf}/{i}")
        if name == "tokens":
            assert {r.doc_id: tuple(r)[1:] for r in now.collect()} == {d: expected(t) for d, t in before.items()}
            break
        assert now.dtypes == docs.dtypes
        after = texts(now)
        kept.append(len(after))
        if name == "quality":
            passed = {d for d, t in before.items() if not brute.quality(t)[5]}
            assert set(after) <= passed and after == {d: before[d] for d in after} and len(after) > 5
        elif name == "near_duplicates":
            assert after == {d: before[d] for d, (_, c) in brute.components(before).items() if c == d}
        elif name == "repeats":
            ids = sorted(before)
            assert after == dict(zip(ids, brute.without_passages([before[d] for d in ids], repeats.PASSAGE_BYTES, repeats.PASSAGE_WORDS), strict=True))
        else:
            want = dict(zip(before, brute.leaks(list(before.values()), items[:2]), strict=True))
            assert set(after) == {d for d, w in want.items() if w[1] <= 0.5 * w[0]}
            assert all((after[d] == before[d]) == (not want[d][4]) for d in after)
    assert kept == sorted(kept, reverse=True)
    run = {tuple(r) for r in corpus_pipeline.run(spark, sf).collect()}
    assert run == {tuple(r) for r in now.collect()}


def test_every_operator_is_registered():
    assert [int(q[2:].split("_")[0]) for q in sorted(queries.QUERIES, key=lambda q: int(q[2:].split("_")[0]))] == list(range(1, 14))
