"""Labels, splits, a weighted boosted classifier and exact evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import materialized
from .grid import neighbours
from .spatial import in_box

SOFT_WEIGHT = 0.25


def soft_labels(cells: DataFrame, label: str = "has_dc", weight: float = SOFT_WEIGHT) -> DataFrame:
    """Adds label, is_soft and weight: cells around a positive one that are not positive themselves are
    positive with a small weight."""
    around = neighbours(cells.filter(F.col(label) == 1)).select("q", "r", F.lit(1).alias("_near"))
    near = (F.coalesce("_near", F.lit(0)) == 1) & (F.col(label) == 0)
    out = cells.join(around, ["q", "r"], "left").withColumn("is_soft", near.cast("int")).drop("_near")
    return out.withColumn("label", F.greatest(F.col(label), F.col("is_soft"))).withColumn("weight", F.when(F.col("is_soft") == 1, weight).otherwise(1.0))


def spatial_split(df: DataFrame, boxes: Sequence[tuple[str, float, float, float, float]], x: str = "lon", y: str = "lat") -> DataFrame:
    """Adds the holdout box of each row (null: none) and is_test."""
    return df.withColumn("box", in_box(F.col(x), F.col(y), boxes)).withColumn("is_test", F.col("box").isNotNull().cast("int"))


def split_summary(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows, positives and rate of both sides; few: fewer than 20 positives."""
    out = df.groupBy("is_test").agg(F.count("*").alias("rows"), F.sum(label).alias("positives"), F.avg(label).alias("rate"))
    return out.withColumn("few", F.col("positives") < 20)


def _by_score(df: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives of each distinct score."""
    return df.groupBy(F.col(score).alias("score")).agg(F.sum(label).alias("pos"), F.sum(1 - F.col(label)).alias("neg"))


def _prefixed(counts: DataFrame, parts: int = 64) -> DataFrame:
    """Cumulative counts from the highest score down, without a window over everything: scores are cut
    into ranges by their quantiles, sums run inside each range, and the ranges' totals, one row each,
    are added."""
    cuts = counts.agg(F.percentile_approx("score", [i / parts for i in range(1, parts)], 1000)).first()[0] or []
    cuts = sorted(set(cuts))
    part = F.lit(0)
    for c in cuts:
        part = part + (F.col("score") <= F.lit(c)).cast("int")  # greater scores come first
    marked = counts.withColumn("part", part)
    inside = Window.partitionBy("part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most `parts` rows
    totals = marked.groupBy("part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    totals = totals.select("part", F.coalesce(F.sum("p").over(before), F.lit(0)).alias("p0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    run = marked.withColumn("tp", F.sum("pos").over(inside)).withColumn("fp", F.sum("neg").over(inside))
    out = run.join(F.broadcast(totals), "part")
    return out.select("score", "pos", "neg", (F.col("tp") + F.col("p0")).alias("tp"), (F.col("fp") + F.col("n0")).alias("fp"))


def _ranked_by(counts: DataFrame, group: str, parts: int = 64) -> DataFrame:
    """Cumulative counts by group from its highest score down.  Scores are cut into ranges by the quantiles of
    all of them; sums run inside each group's range and start from the totals of its higher ranges, so a group
    of most rows is no single task."""
    cuts = sorted(set(counts.agg(F.percentile_approx("score", [i / parts for i in range(1, parts)], 1000)).first()[0] or []))
    part = F.lit(0)
    for c in cuts:
        part = part + (F.col("score") <= F.lit(c)).cast("int")
    marked = counts.withColumn("part", part)
    inside = Window.partitionBy(group, "part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most `parts` rows
    totals = marked.groupBy(group, "part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    totals = totals.select(F.col(group).alias("_g"), F.col("part").alias("_p"), F.coalesce(F.sum("p").over(before), F.lit(0)).alias("p0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    run = marked.withColumn("tp", F.sum("pos").over(inside)).withColumn("fp", F.sum("neg").over(inside))
    out = run.join(totals, F.col(group).eqNullSafe(F.col("_g")) & (F.col("part") == F.col("_p")))
    return out.select(group, "score", "pos", "neg", (F.col("tp") + F.col("p0")).alias("tp"), (F.col("fp") + F.col("n0")).alias("fp"))


def scores_by(df: DataFrame, group: str, score: str = "score", label: str = "label") -> DataFrame:
    """(group, rows, positives, auc, average_precision) of each group; null where a class lacks."""
    y = F.col(label).cast("long")
    counts = df.groupBy(group, F.col(score).alias("score")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    wins = F.sum(F.col("neg") * (F.col("tp") - F.col("pos")) + F.col("pos") * F.col("neg") / 2)
    steps = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    out = _ranked_by(counts, group).groupBy(group).agg(F.sum(F.col("pos") + F.col("neg")).alias("rows"), F.sum("pos").alias("positives"), F.try_divide(wins, F.sum("pos") * F.sum("neg")).alias("auc"), F.try_divide(steps, F.sum("pos")).alias("average_precision"))
    return out.withColumn("average_precision", F.when(F.col("positives") < F.col("rows"), F.col("average_precision")))


def curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Precision and recall at every distinct score."""
    points = _prefixed(_by_score(df, score, label))
    total = df.agg(F.sum(label).alias("all_pos"))  # one row
    both = points.join(F.broadcast(total), how="inner", on=F.lit(True))
    return both.withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp"))).withColumn("recall", F.try_divide("tp", "all_pos"))


def roc_auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under the ROC curve, ties counting half; null when a class is missing."""
    points = _prefixed(_by_score(df, score, label))
    wins = F.sum(F.col("neg") * (F.col("tp") - F.col("pos")) + F.col("pos") * F.col("neg") / 2)
    return points.agg(F.try_divide(wins, F.sum("pos") * F.sum("neg")).alias("auc"))


def average_precision(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Step-wise average precision."""
    return curve(df, score, label).agg(F.sum(F.col("precision") * F.try_divide("pos", "all_pos")).alias("average_precision"))


def precision_at_recall(df: DataFrame, least: float, score: str = "score", label: str = "label") -> DataFrame:
    """Precision, recall and threshold at the highest score whose recall reaches a level."""
    reached = curve(df, score, label).filter(F.col("recall") >= least)
    return reached.agg(F.max_by(F.struct("score", "precision", "recall"), "score").alias("p")).select("p.*")


def top_k_precision(df: DataFrame, ks: Sequence[int], key: str, score: str = "score", label: str = "label") -> DataFrame:
    """Mean label among the k best scores, the key breaking ties."""
    best = df.select(key, score, label).orderBy(F.desc(score), key).limit(max(ks))
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), key)))  # at most max(ks) rows
    return ranked.agg(*(F.avg(F.when(F.col("rank") <= k, F.col(label))).alias(f"p_at_{k}") for k in ks))


def balanced_weight(label: Column, weight: Column, positive_rate: float) -> Column:
    """Weights under which both classes weigh the same."""
    return weight * F.when(label == 1, 0.5 / positive_rate).otherwise(0.5 / (1 - positive_rate))


def fit_boosted(df: DataFrame, features: Sequence[str], label: str = "label", weight: str = "weight", rounds: int = 100, depth: int = 4, rate: float = 0.1, validation: str | None = None, balanced: bool = False):
    """A boosted-tree model over the features present; nulls become -1 beyond a flag column of their own.
    `balanced` lets both classes weigh the same."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    if balanced:
        share = df.agg(F.try_divide(F.sum(F.col(label) * F.col(weight)), F.sum(weight))).first()[0]
        if share and share < 1:
            df = df.withColumn(weight, balanced_weight(F.col(label), F.col(weight), share))
    used = [c for c in features if c in df.columns]
    gbt = GBTClassifier(featuresCol="features", labelCol=label, weightCol=weight, maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=0.7, featureSubsetStrategy="0.7", minInstancesPerNode=10, seed=7)
    if validation:
        gbt = gbt.setValidationIndicatorCol(validation)
    assembled = VectorAssembler(inputCols=[*(f"{c}_x" for c in used), *(f"{c}_null" for c in used)], outputCol="features")
    return used, Pipeline(stages=[assembled, gbt]).fit(filled(df, used))


def filled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature columns without nulls, beside flags for where they were."""
    return df.withColumns({f"{c}_x": F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in features} | {f"{c}_null": F.col(c).isNull().cast("double") for c in features})


def scored(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds the score of class 1."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(filled(df, features))
    return out.withColumn("score", vector_to_array("probability")[1]).select(*df.columns, "score")


def importances(spark, model, features: Sequence[str]) -> DataFrame:
    """(feature, importance) of a fitted model; a feature's flag counts with it."""
    values = model.stages[-1].featureImportances.toArray()
    n = len(features)
    return spark.createDataFrame([(f, float(values[i] + values[n + i])) for i, f in enumerate(features)], "feature string, importance double")


def margins(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds `margins`: the ensemble's margin after each of its rounds, all from one pass over the rows."""
    fitted = model.stages[-1]
    out = model.stages[0].transform(filled(df, features))
    for i, tree in enumerate(fitted.trees):
        out = tree.setFeaturesCol("features").setPredictionCol(f"_t{i}").transform(out)
    steps = F.array(*(F.col(f"_t{i}") * float(w) for i, w in enumerate(fitted.treeWeights)))
    sums = F.aggregate(steps, F.array().cast("array<double>"), lambda s, t: F.concat(s, F.array(F.when(F.size(s) > 0, F.element_at(s, -1)).otherwise(0.0) + t)))
    return out.select(*df.columns, sums.alias("margins"))


def learning_curve(model, df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """(round, average_precision, auc, is_best) on a frame, for every round of the ensemble; the earliest round
    of the greatest average precision is the best."""
    each = margins(model, df, features).select(label, F.posexplode("margins").alias("round", "score")).withColumn("round", F.col("round") + 1)
    points = materialized(scores_by(each, "round", "score", label))
    best = points.agg(F.max_by("round", F.struct(F.coalesce("average_precision", F.lit(-1.0)).alias("ap"), -F.col("round")))).first()[0]
    return points.select("round", "average_precision", "auc", (F.col("round") == F.lit(best)).alias("is_best"))


def stopped_at(curve: DataFrame, patience: int = 20) -> int:
    """The round that training stops at: the best one before `patience` rounds bring nothing better."""
    best, at = -1.0, 0
    for r in sorted(curve.select("round", "average_precision").collect()):  # a row for each round
        if (r.average_precision or 0.0) > best:
            best, at = r.average_precision or 0.0, r["round"]
        elif r["round"] - at >= patience:
            break
    return at


def scored_at(model, df: DataFrame, features: Sequence[str], rounds: int) -> DataFrame:
    """Adds the score of class 1 by the first rounds of the ensemble alone."""
    margin = F.element_at("margins", rounds)
    return margins(model, df, features).withColumn("score", 1 / (1 + F.exp(-2 * margin))).drop("margins")


def metrics_record(scored: DataFrame, label: str = "label", score: str = "score", weight: str | None = None) -> DataFrame:
    """One row on a scored table: rows, positives, their share and the mean score of each class."""
    y, w = F.col(label).cast("double"), F.col(weight) if weight else F.lit(1.0)
    return scored.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(y), F.lit(0.0)).cast("long").alias("n_positive"), (F.sum(y * w) / F.sum(w)).alias("base_rate"), F.avg(F.when(y > 0, F.col(score))).alias("mean_score_positive"), F.avg(F.when(y == 0, F.col(score))).alias("mean_score_negative"))


def evaluation_record(scored: DataFrame, key: str, config: dict, label: str = "has_dc", soft: str = "is_soft", score: str = "score", least_recall: float = 0.6, ks: Sequence[int] = (100, 500, 1000)) -> DataFrame:
    """One row on a scored table that is_test cuts into two sides: cells and positives of both, soft ones of the
    training side, AUC and average precision of both by the hard label, precision and threshold at a recall and
    precision of the best k on the test side, and the entries of a configuration.  A measure that a side does not
    allow is null."""
    y, s, test = F.col(label).cast("long"), F.col(soft).cast("long"), F.col("is_test") == 1
    counted = {"train_cells": F.count_if(~test), "test_cells": F.count_if(test), "train_positives": F.count_if(~test & (y == 1)), "train_soft_positives": F.count_if(~test & (s == 1) & (y == 0)), "test_positives": F.count_if(test & (y == 1)), "hard_positives": F.count_if(y == 1), "soft_positives": F.count_if(s == 1)}
    sides = scores_by(scored, "is_test", score, label)
    of = lambda side, measure: F.max(F.when(F.col("is_test") == side, F.col(measure)))
    areas = sides.agg(of(0, "auc").alias("train_auc_roc"), of(0, "average_precision").alias("train_auc_pr"), of(1, "auc").alias("auc_roc"), of(1, "average_precision").alias("auc_pr"))
    held = scored.filter(test)
    percent = round(least_recall * 100)
    reached = precision_at_recall(held, least_recall, score, label).agg(F.max("precision").alias(f"precision_at_r{percent}"), F.max("score").alias(f"threshold_at_r{percent}"))
    best = top_k_precision(held, ks, key, score, label).withColumnsRenamed({f"p_at_{k}": f"top_{k}_precision" for k in ks})
    out = scored.agg(*(c.alias(n) for n, c in counted.items()))
    for row in (areas, reached, best):
        out = out.join(F.broadcast(row), how="inner", on=F.lit(True))  # one row each
    return out.select(*(F.lit(v).alias(n) for n, v in config.items()), "*")
