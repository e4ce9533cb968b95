"""Operators that work in rounds or ranges, against plain versions."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hexfield.functions import geo
from hexfield.operators import dedupe, model, tables
from hexfield.sources import readers, writers
from hexfield.streaming import incremental


def test_percentiles(spark):
    rng = random.Random(1)
    for values in ([5.0], [1.0, 2.0], [3.0] * 900 + [4.0], [rng.gauss(0, 1) for _ in range(3000)], [rng.choice((1e-300, 1e300, -1e300, 0.0, 7.5)) for _ in range(500)], [float(2**k) for k in range(60)]):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
        points = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
        want = df.agg(*(F.percentile("v", p) for p in points)).first()
        assert tables.percentiles(df, "v", points) == list(want)
    assert tables.percentiles(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]
    assert tables.percentiles(spark.createDataFrame([(float("nan"),), (2.0,)], "v double"), "v", [0.5]) == [2.0]


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "HEAVY", 50)
    star = spark.range(1, 20_000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    chain = spark.range(30_000, 30_400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    loops = spark.createDataFrame([(50_000, 50_000), (50_001, 50_002), (50_002, 50_001)], "a long, b long")
    nodes = spark.range(0, 20_000).union(spark.range(30_000, 30_401)).union(spark.range(50_000, 50_004)).toDF("id")
    found = dedupe.clusters(nodes, star.union(chain).union(loops), "id")
    sizes = {r.cluster: r["count"] for r in found.groupBy("cluster").count().collect()}
    assert sizes == {0: 20_000, 30_000: 401, 50_000: 1, 50_001: 2, 50_003: 1}


def test_auc_by_group(spark):
    rng = random.Random(2)
    rows = [(g, round(rng.random(), 2), int(rng.random() < 0.3)) for g in ("a", "b", "c") for _ in range(150)] + [("none", 0.5, 0)] * 5 + [("all", 0.5, 1)] * 5 + [(None, 0.1, 0), (None, 0.9, 1)]
    got = {r["g"]: r for r in model.scores_by(spark.createDataFrame(rows, "g string, score double, label int"), "g").collect()}
    for g in ("a", "b", "c", None):
        own = [(s, y) for x, s, y in rows if x == g]
        pairs = [(s > t) + (s == t) / 2 for s, y in own if y for t, z in own if not z]
        assert got[g].auc == pytest.approx(sum(pairs) / len(pairs))
        hits = [sum(z for t, z in own if t >= s) / sum(t >= s for t, _ in own) for s, y in own if y]
        assert got[g].average_precision == pytest.approx(sum(hits) / len(hits))
    assert got["none"].auc is None and got["all"].auc is None and got["all"].average_precision is None


def test_staged_scores(spark):
    """Each round's average precision from one pass; the whole ensemble gives the learner's own scores."""
    rng = random.Random(3)
    rows = [(i, x := rng.random(), y := rng.random(), int(x + y * y + rng.gauss(0, 0.3) > 1.3)) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, x double, y double, label int").withColumn("weight", F.lit(1.0))
    used, fit = model.fit_boosted(df.filter("id < 400"), ["x", "y", "absent"], rounds=6, depth=2, balanced=True)
    held = df.filter("id >= 400")
    curve = model.learning_curve(fit, held, used)
    got = sorted(curve.collect())
    assert [r["round"] for r in got] == list(range(1, 7)) and sum(r.is_best for r in got) == 1
    best = max(got, key=lambda r: (r.average_precision, -r["round"]))
    assert best.is_best and model.stopped_at(curve, 50) == best["round"] and model.stopped_at(curve, 1) <= best["round"]
    whole = {r.id: r.score for r in model.scored(fit, held, used).collect()}
    last = {r.id: r.score for r in model.scored_at(fit, held, used, 6).collect()}
    assert all(last[i] == pytest.approx(whole[i], abs=1e-9) for i in whole)
    ap = model.average_precision(model.scored_at(fit, held, used, 3)).first()[0]
    assert got[2].average_precision == pytest.approx(ap)


def test_inverse_albers(spark):
    """There and back within a millimetre, for points and for corners."""
    df = spark.range(0, 2000).select((-125 + F.col("id") % 59).cast("double").alias("lon"), (24.3 + F.col("id") / 80).alias("lat"))
    x, y = geo.albers(F.col("lon"), F.col("lat"))
    lon, lat = geo.albers_inverse(F.col("x"), F.col("y"))
    back = df.withColumns({"x": x, "y": y}).withColumns({"lon2": lon, "lat2": lat})
    off = back.agg(F.max(F.abs(F.col("lon2") - F.col("lon"))), F.max(F.abs(F.col("lat2") - F.col("lat")))).first()
    assert max(off) < 8e-9  # degrees; a millimetre is 9e-9
    ring = F.array(F.array(F.struct("x", "y")))
    corner = back.select(geo.projected(ring, geo.albers_inverse)[0][0].alias("p"), "lon", "lat").select(F.max(F.abs(F.col("p.x") - F.col("lon"))), F.max(F.abs(F.col("p.y") - F.col("lat")))).first()
    assert max(corner) < 8e-9


def test_batches_survive(spark, tmp_path):
    """A run that dies in its third batch, and one that leaves a torn batch: no key is lost or doubled."""
    keys, path = spark.range(100).toDF("k"), f"file://{tmp_path}/store"
    seen = []

    def work(df, fail_at=None):
        if df.isEmpty() is False:
            seen.append(df.count())
            if fail_at is not None and len(seen) > fail_at:
                raise RuntimeError("killed")
        return df.select("k", (F.col("k") * 2).alias("v"))

    with pytest.raises(RuntimeError):
        incremental.run_batches(keys, "k", lambda df: work(df, 2), path, 5)
    schema = keys.select("k", F.col("k").alias("v")).schema
    done = incremental.committed(spark, path, schema).count()
    assert 0 < done < 100
    torn = tmp_path / "store" / "open" / "torn"
    torn.mkdir(parents=True)
    (torn / "part-0.parquet").write_bytes(b"half")
    out = incremental.run_batches(keys, "k", work, path, 3)
    assert sorted(tuple(r) for r in out.collect()) == [(k, 2 * k) for k in range(100)]
    assert not torn.exists() and sum(seen[-3:]) <= 100 - done
    assert incremental.run_batches(keys, "k", work, path, 3).count() == 100


def test_collection(spark, tmp_path):
    corner = lambda x, y: F.struct((F.col("id") + x).cast("double").alias("x"), F.lit(float(y)).alias("y"))
    df = spark.range(200).select(F.format_string("c%03d", "id").alias("cell"), F.array(corner(0, 0), corner(1, 0), corner(1, 1)).alias("ring"), (F.col("id") / 7).alias("score"), F.lit('a "quoted" ü').alias("note"))
    parts = writers.write_collection(df, f"file://{tmp_path}/map", "cell", "ring", ["cell", "score", "note"], {"title": "Sites"}, 3)
    raw = b"".join(p.read_bytes() for p in sorted(Path(tmp_path, "map").glob("part-*")))
    doc = json.loads(raw)
    assert doc["type"] == "FeatureCollection" and doc["metadata"] == {"count": 200, "title": "Sites"}
    assert [f["properties"]["cell"] for f in doc["features"]] == [f"c{i:03d}" for i in range(200)]
    assert doc["features"][8]["properties"]["score"] == 1.143 and doc["features"][8]["properties"]["note"] == 'a "quoted" ü'
    rows = parts.orderBy("part").collect()
    assert sum(r.bytes for r in rows) == len(raw) and all(raw[r.offset :].startswith(Path(tmp_path, "map", r.part).read_bytes()) for r in rows)
    empty = writers.write_collection(df.limit(0), f"file://{tmp_path}/none", "cell", "ring", ["cell"])
    assert empty.count() and json.loads(b"".join(p.read_bytes() for p in sorted(Path(tmp_path, "none").glob("part-*"))))["features"] == []


def test_months_are_told_by_files(spark, tmp_path):
    """Names of files and of folders tell the band; no row's path is searched for it."""
    names = {"tmean_annual": 0, "tmean_03": 3, "t mean%_04_x": 4, "deep/tmean_12": 12}
    for i, name in enumerate(names):
        spark.range(10 * i, 10 * i + i + 1).toDF("k").repartition(2).write.parquet(f"{tmp_path}/{name}")
    next((tmp_path / "tmean_03").glob("part-00000-*")).rename(tmp_path / "loose_07.parquet")
    found = readers.read_months(spark, str(tmp_path), "*.parquet", "k bigint")
    assert found.columns == ["k", "band"]
    got = {r.k: r.band for r in found.collect()}
    assert {k: b for k, b in got.items() if k // 10 != 1} == {10 * i + j: b for i, b in enumerate(names.values()) if i != 1 for j in range(i + 1)}
    assert {k for k in got if k // 10 == 1} == {10, 11} and {got[10], got[11]} <= {3, 7} and 7 in got.values()
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError, match=r"\[1, 2\]"):
        readers.require_bands(found, [0, 1, 2, 4, 12])
