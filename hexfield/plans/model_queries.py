"""Queries over labels, evaluation, scoring and export, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import model, scoring, spatial
from ..operators.grid import with_cells, with_rings
from ..sources.writers import feature
from . import layers as L

Q: dict = {}


def query(sql: str | None):
    def add(f):
        Q[f.__name__] = (f, sql)
        return f

    return add


def milli(c, k=1000):
    return F.floor(c * k + 0.5).cast("long")


CELLS = f"{L.POINTS}, {L.cells_sql('points', 'pc')}, cells AS (SELECT q, r, cell_id, max(CASE WHEN balance > 9500 THEN 1 ELSE 0 END) AS has_dc, max(balance) AS balance, count(*) AS n FROM pc GROUP BY 1, 2, 3)"
SOFT = f"{CELLS}, ring AS (SELECT DISTINCT q + dq AS q, r + dr AS r FROM cells, (VALUES (1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1)) AS s(dq, dr) WHERE has_dc = 1), soft AS (SELECT c.*, CASE WHEN ring.q IS NOT NULL AND has_dc = 0 THEN 1 ELSE 0 END AS is_soft FROM cells c LEFT JOIN ring ON c.q = ring.q AND c.r = ring.r)"


def cells(spark, d):
    """Occupied cells; those with a rich customer have a facility."""
    c = with_cells(L.points(spark, d), L.EDGE)
    return c.groupBy("q", "r", "cell_id").agg(F.max((F.col("balance") > 9500).cast("int")).alias("has_dc"), F.max("balance").alias("balance"), F.count("*").alias("n"))


@query(f"WITH {SOFT} SELECT cell_id, has_dc, is_soft, greatest(has_dc, is_soft) AS label, CASE WHEN is_soft = 1 THEN 0.25e0 ELSE 1e0 END AS weight FROM soft")
def soft_labels(spark, d):
    """Neighbours of positive cells as weak positives."""
    return model.soft_labels(cells(spark, d)).select("cell_id", "has_dc", "is_soft", "label", "weight")


BOXES = [("NJ", 0.0, 20000.0, 0.0, 40000.0), ("CO", 10000.0, 50000.0, 30000.0, 60000.0)]


def split(spark, d):
    p = L.points(spark, d).withColumn("label", (F.col("balance") > 9000).cast("int"))
    return model.spatial_split(p, BOXES, "x", "y")


@query(f"WITH {L.POINTS}, b AS (SELECT id, CASE WHEN balance > 9000 THEN 1 ELSE 0 END AS label, CASE WHEN x BETWEEN 0 AND 20000 AND y BETWEEN 0 AND 40000 THEN 'NJ' WHEN x BETWEEN 10000 AND 50000 AND y BETWEEN 30000 AND 60000 THEN 'CO' END AS box FROM points) SELECT CASE WHEN box IS NULL THEN 0 ELSE 1 END AS is_test, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, CAST(floor(avg(label) * 1000000 + 0.5e0) AS BIGINT) AS rate, sum(label) < 20 AS few FROM b GROUP BY 1")
def spatial_split(spark, d):
    """Training and holdout sides of a geographic split."""
    return model.split_summary(split(spark, d)).withColumn("rate", milli(F.col("rate"), 1000000))


SCORES = "sc AS (SELECT c_custkey AS id, CAST((c_custkey * 7919) % 997 AS DOUBLE) AS score, CASE WHEN (c_custkey * 7919) % 997 + (c_custkey * 31) % 400 > 1100 THEN 1 ELSE 0 END AS label FROM customer)"


def scores(spark, d):
    return L.table(spark, d, "customer").selectExpr("c_custkey AS id", "cast((c_custkey * 7919) % 997 AS double) AS score", "CASE WHEN (c_custkey * 7919) % 997 + (c_custkey * 31) % 400 > 1100 THEN 1 ELSE 0 END AS label")


@query(f"WITH {SCORES}, p AS (SELECT score FROM sc WHERE label = 1), n AS (SELECT score FROM sc WHERE label = 0) SELECT CAST(floor(sum(CASE WHEN p.score > n.score THEN 1e0 WHEN p.score = n.score THEN 0.5e0 ELSE 0e0 END) / count(*) * 1000000000 + 0.5e0) AS BIGINT) AS auc FROM p, n")
def auc_rank(spark, d):
    """Exact area under the ROC curve with ties."""
    return model.roc_auc(scores(spark, d)).select(milli(F.col("auc"), 1000000000).alias("auc"))


CURVE = f"{SCORES}, g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM sc GROUP BY 1), c AS (SELECT score, pos, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, (SELECT sum(label) FROM sc) AS total FROM g)"


@query(f"WITH {CURVE} SELECT CAST(floor(sum(tp * 1e0 / (tp + fp) * pos / total) * 1000000 + 0.5e0) AS BIGINT) AS average_precision FROM c")
def average_precision(spark, d):
    """Step-wise average precision."""
    return model.average_precision(scores(spark, d)).select(milli(F.col("average_precision"), 1000000).alias("average_precision"))


@query(f"WITH {SCORES} SELECT count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive, CAST(floor(avg(label) * 1000000 + 0.5e0) AS BIGINT) AS base_rate, CAST(floor(avg(CASE WHEN label = 1 THEN score END) * 1000 + 0.5e0) AS BIGINT) AS mean_score_positive, CAST(floor(avg(CASE WHEN label = 0 THEN score END) * 1000 + 0.5e0) AS BIGINT) AS mean_score_negative FROM sc")
def metrics_record(spark, d):
    """One row of counts and means on a scored table."""
    m = model.metrics_record(scores(spark, d))
    return m.select("n_rows", "n_positive", milli(F.col("base_rate"), 1000000).alias("base_rate"), *(milli(F.col(c)).alias(c) for c in ("mean_score_positive", "mean_score_negative")))


@query(f"WITH {CURVE} SELECT score, CAST(floor(tp * 1e0 / (tp + fp) * 1000000 + 0.5e0) AS BIGINT) AS precision, CAST(floor(tp * 1e0 / total * 1000000 + 0.5e0) AS BIGINT) AS recall FROM c WHERE tp * 1e0 / total >= 0.6e0 ORDER BY score DESC LIMIT 1")
def pr_at_recall(spark, d):
    """Precision at the highest threshold with a recall of 0.6."""
    return model.precision_at_recall(scores(spark, d), 0.6).select("score", *(milli(F.col(c), 1000000).alias(c) for c in ("precision", "recall")))


@query(f"WITH {SCORES}, k AS (SELECT label, row_number() OVER (ORDER BY score DESC, id) AS k FROM sc) SELECT CAST(floor(avg(CASE WHEN k <= 100 THEN label END) * 1000 + 0.5e0) AS BIGINT) AS p_at_100, CAST(floor(avg(CASE WHEN k <= 500 THEN label END) * 1000 + 0.5e0) AS BIGINT) AS p_at_500, CAST(floor(avg(CASE WHEN k <= 1000 THEN label END) * 1000 + 0.5e0) AS BIGINT) AS p_at_1000 FROM k")
def topk_precision(spark, d):
    """Precision among the best scores."""
    return model.top_k_precision(scores(spark, d), [100, 500, 1000], "id").select(*(milli(F.col(f"p_at_{k}")).alias(f"p_at_{k}") for k in (100, 500, 1000)))


FEATURES = ["x", "y", "nation", "site_d2", "missing"]


def training(spark, d):
    near = spatial.nearest(L.points(spark, d), L.sites(spark, d), "id", ["site"], 4000.0).select("id", F.col("d2").alias("site_d2"))
    return split(spark, d).join(near, "id").withColumn("weight", F.lit(1.0)).withColumn("label", (F.col("site_d2") < 9e6).cast("double"))


def fitted(spark, d):
    data = training(spark, d)
    return data, *model.fit_boosted(data.filter("is_test = 0"), FEATURES, rounds=10, depth=3)


@query(None)
def gbt_scores(spark, d):
    """Scores of all points by a boosted classifier, with residuals."""
    data, used, fit = fitted(spark, d)
    return model.scored(fit, data, used).select("id", "is_test", "label", "score", (F.col("score") - F.col("label")).alias("residual"))


@query(None)
def importance_share(spark, d):
    """Importances with running shares."""
    from ..operators.tables import cumulative_share

    _, used, fit = fitted(spark, d)
    return cumulative_share(model.importances(spark, fit, used), "importance", [F.desc("importance"), F.col("feature")])


@query(None)
def learning_curve(spark, d):
    """Average precision and AUC on the holdout by round, from one pass; both classes weigh the same."""
    data = training(spark, d)
    used, fit = model.fit_boosted(data.filter("is_test = 0"), FEATURES, rounds=10, depth=3, balanced=True)
    return model.learning_curve(fit, data.filter("is_test = 1"), used)


BY_REGION = "SELECT c_custkey AS id, c_nationkey AS region, CAST((c_custkey * 7919) % 1009 AS DOUBLE) / 1000 AS score, CASE WHEN c_nationkey = 7 THEN 0 WHEN c_nationkey = 8 THEN 1 WHEN (c_custkey * 31) % 10 < 3 THEN 1 ELSE 0 END AS label FROM customer"


@query(f"""WITH s AS ({BY_REGION}), c AS (SELECT region, score, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY 1, 2),
r AS (SELECT *, sum(pos) OVER (PARTITION BY region ORDER BY score DESC) AS tp, sum(neg) OVER (PARTITION BY region ORDER BY score DESC) AS fp FROM c)
SELECT region, CAST(sum(pos + neg) AS BIGINT) AS n_rows, CAST(sum(pos) AS BIGINT) AS positives, CAST(floor(sum(neg * (tp - pos) + pos * neg / 2e0) / nullif(sum(pos) * sum(neg), 0) * 1000000 + 0.5e0) AS BIGINT) AS auc,
CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN CAST(floor(sum(pos * tp / CAST(tp + fp AS DOUBLE)) / sum(pos) * 1000000 + 0.5e0) AS BIGINT) END AS average_precision FROM r GROUP BY region""")
def auc_by_region(spark, d):
    """AUC and average precision of each region, null where a class lacks."""
    c = F.col("c_custkey")
    label = F.when(F.col("region") == 7, 0).when(F.col("region") == 8, 1).when(c * 31 % 10 < 3, 1).otherwise(0)
    data = L.table(spark, d, "customer").withColumn("region", F.col("c_nationkey")).select("region", ((c * 7919 % 1009).cast("double") / 1000).alias("score"), label.alias("label"))
    return model.scores_by(data, "region").select("region", F.col("rows").alias("n_rows"), "positives", milli(F.col("auc"), 1000000).alias("auc"), milli(F.col("average_precision"), 1000000).alias("average_precision"))


FLAGS = ["in_protected_area", "in_wetland", "in_floodplain_100yr", "in_high_wildfire", "in_high_seismic", "high_water_stress", "in_tribal_land", "in_critical_habitat"]
SCORED_COLUMNS = ", ".join(
    [
        "c_custkey AS id",
        *(f"CASE WHEN (c_custkey * {3 + i}) % {7 + 2 * i} = 0 THEN 1 WHEN c_custkey % 13 = {i} THEN NULL ELSE 0 END AS {f}" for i, f in enumerate(FLAGS)),
        "CAST((c_custkey * 17) % 101 AS DOUBLE) / 100 AS demographic",
        "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE (c_custkey * 53) % 20000 END AS pop_within_25mi",
        "CAST((c_custkey * 41) % 1001 AS DOUBLE) / 1000 AS viability",
        "CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END AS has_dc",
        "CASE WHEN c_custkey % 21 = 0 THEN 1 WHEN c_custkey % 22 = 0 THEN NULL ELSE 0 END AS is_soft",
        "CAST((c_custkey * 7) % 901 AS DOUBLE) AS dist_nearest_ixp_km",
        "CAST((c_custkey * 11) % 97 AS DOUBLE) AS dist_transmission_km",
        "CAST((c_custkey * 13) % 91 AS DOUBLE) AS dist_substation_km",
        "CAST((c_custkey * 19) % 2500 AS DOUBLE) AS annual_cdd",
        "CAST((c_custkey * 23) % 130 AS DOUBLE) / 8 AS mean_slope_deg",
        "CASE WHEN c_custkey % 29 = 0 THEN 1 ELSE 0 END AS high_ej_burden",
        "CAST((c_custkey * 3) % 120 AS DOUBLE) AS elec_price_mwh",
        "CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS cooling_favorable",
    ]
)
RAW = f"raw AS (SELECT {SCORED_COLUMNS} FROM customer), top_ AS (SELECT max(pop_within_25mi) AS m FROM raw)"
COMPONENTS = ["in_protected_area", "in_wetland", "in_floodplain_100yr", "in_high_wildfire", "in_high_seismic", "high_water_stress", "demographic_index", "population", "in_tribal_land", "in_critical_habitat"]
COMP = f"{RAW}, comp AS (SELECT *, " + ", ".join(f"coalesce({ {'demographic_index': 'demographic', 'population': 'pop_within_25mi * 1e0 / m'}.get(c, c)}, 0) * 1e0 AS c_{c}" for c in COMPONENTS) + " FROM raw, top_)"
PENALTY = "(" + " + ".join(f"c_{c} * {w}e0" for c, w in scoring.WEIGHTS.items()) + f") / {sum(scoring.WEIGHTS.values())}e0"
FINAL = f"{COMP}, fin AS (SELECT *, {PENALTY} AS penalty, viability * (1 - {PENALTY}) AS final FROM comp)"


def components(spark, d):
    t = L.table(spark, d, "customer").selectExpr(*(x for x in SCORED_COLUMNS.replace(", CASE", "\nCASE").replace(", CAST", "\nCAST").split("\n")))
    t = scoring.normalized_by_max(t, "pop_within_25mi", "c_population")
    return t.withColumns({f"c_{c}": F.coalesce(F.col("demographic" if c == "demographic_index" else c).cast("double"), F.lit(0.0)) for c in COMPONENTS if c != "population"})


def final(spark, d):
    t = components(spark, d).withColumn("penalty", scoring.penalty())
    return t.withColumn("final", scoring.final_score(F.col("viability"), F.col("penalty")))


@query(f"WITH {FINAL} SELECT id, CAST(floor(penalty * 1000000 + 0.5e0) AS BIGINT) AS penalty, CAST(floor(final * 1000000 + 0.5e0) AS BIGINT) AS final FROM fin")
def impact_penalty(spark, d):
    """Penalties and final scores."""
    return final(spark, d).select("id", milli(F.col("penalty"), 1000000).alias("penalty"), milli(F.col("final"), 1000000).alias("final"))


@query(
    f"""WITH {FINAL}, f2 AS (SELECT *, coalesce(in_protected_area, 0) = 1 OR coalesce(in_wetland, 0) = 1 OR coalesce(in_tribal_land, 0) = 1 OR coalesce(in_critical_habitat, 0) = 1 AS hard FROM fin)
SELECT id, CASE WHEN has_dc = 1 THEN 'Existing Data Center' WHEN hard THEN 'Hard Exclusion' WHEN penalty >= 0.5 THEN 'High Community Impact' WHEN final >= 0.5 AND coalesce(is_soft, 0) = 0 THEN 'Candidate' ELSE 'Low Viability' END AS category FROM f2"""
)
def display_category(spark, d):
    """Display categories."""
    return final(spark, d).select("id", scoring.category(F.col("has_dc"), scoring.is_hard(), F.col("penalty"), F.col("final"), F.col("is_soft")).alias("category"))


@query(
    f"""WITH {COMP} SELECT 'plain' AS scenario, id, CAST(floor(viability * (1 - (c_in_wetland * 2e0 + c_population * 1e0) / 3e0) * 1000000 + 0.5e0) AS BIGINT) AS final_score FROM comp
UNION ALL SELECT 'people', id, CAST(floor(viability * (1 - (c_demographic_index * 1e0 + c_population * 1e0) / 2e0) * 1000000 + 0.5e0) AS BIGINT) FROM comp"""
)
def rescore_weights(spark, d):
    """Final scores under two other sets of weights."""
    weights = spark.createDataFrame([("plain", "in_wetland", 2.0), ("plain", "population", 1.0), ("people", "demographic_index", 1.0), ("people", "population", 1.0)], "scenario string, component string, weight double")
    return scoring.rescored(components(spark, d), weights, "id").withColumn("final_score", milli(F.col("final_score"), 1000000))


def _reason_sql() -> str:
    flag = [f"CASE WHEN {c} = 1 THEN '{t}' END" for c, t in scoring.FLAG_REASONS]
    num = lambda c: f"CAST(CAST({c} AS BIGINT) AS VARCHAR)"
    bad = [
        *flag,
        f"CASE WHEN dist_nearest_ixp_km > 500 THEN 'Distant from backbone internet (' || {num('dist_nearest_ixp_km')} || ' km to nearest IXP)' END",
        f"CASE WHEN dist_transmission_km > 75 THEN 'Far from high-voltage transmission (' || {num('dist_transmission_km')} || ' km)' END",
        f"CASE WHEN dist_substation_km > 75 THEN 'Far from electrical substation (' || {num('dist_substation_km')} || ' km)' END",
        f"CASE WHEN annual_cdd > 2000 THEN 'High cooling load (' || {num('annual_cdd')} || ' CDD annually)' END",
        "CASE WHEN pop_within_25mi < 5000 THEN 'Very low population — limited workforce access' END",
        "CASE WHEN mean_slope_deg > 10 THEN 'Steep' END",
        "CASE WHEN high_ej_burden = 1 THEN 'High environmental justice burden area' END",
    ]
    good = [
        f"CASE WHEN dist_nearest_ixp_km < 100 THEN 'Strong backbone connectivity (' || {num('dist_nearest_ixp_km')} || ' km to IXP)' END",
        f"CASE WHEN elec_price_mwh < 60 THEN 'Low industrial electricity cost ($' || {num('elec_price_mwh')} || '/MWh)' END",
        "CASE WHEN cooling_favorable = 1 THEN 'Climate favorable for free-air cooling' END",
    ]
    joined = lambda parts: "concat_ws('; ', " + ", ".join(parts) + ")"
    return f"WITH {RAW}, e AS (SELECT id, viability, {joined(bad)} AS bad, {joined(good)} AS good FROM raw) SELECT id, CASE WHEN bad <> '' THEN bad WHEN viability >= 0.6 AND good <> '' THEN good WHEN viability < 0.15 THEN 'Low combined infrastructure and market accessibility score' ELSE 'Moderate suitability — review feature details' END AS reasons FROM e"


@query(_reason_sql())
def explain_cells(spark, d):
    """Reasons of every cell; the slope's figure is left out, since rounding of ties differs in SQL."""
    t = components(spark, d)
    steep = F.transform(scoring.reasons(), lambda r: F.when(r.startswith("Steep"), "Steep").otherwise(r))
    return t.select("id", F.array_join(steep, "; ").alias("reasons"))


@query(f"WITH {FINAL} SELECT id, CAST(floor(viability * 1000 + 0.5e0) AS BIGINT) AS viability FROM fin WHERE viability >= 0.15 AND has_dc = 0 AND coalesce(is_soft, 0) = 0 ORDER BY fin.viability DESC, id LIMIT 50")
def candidate_pool(spark, d):
    """The fifty most viable candidates."""
    return scoring.candidates(final(spark, d)).orderBy(F.desc("viability"), "id").limit(50).select("id", milli(F.col("viability")).alias("viability"))


@query(f"WITH {CELLS} SELECT cell_id, 7 AS corners, 'Feature' AS kind, n FROM cells WHERE has_dc = 1")
def geojson_features(spark, d):
    """Cells with facilities as GeoJSON, read back."""
    c = with_rings(cells(spark, d).filter("has_dc = 1"), L.EDGE)
    j = c.select("cell_id", "n", feature(F.col("ring"), ["cell_id", "n"]).alias("json"))
    back = F.from_json("json", "struct<type:string,geometry:struct<type:string,coordinates:array<array<array<double>>>>,properties:struct<cell_id:string,n:bigint>>")
    return j.select(back.alias("f")).select("f.properties.cell_id", F.size(F.col("f.geometry.coordinates")[0]).alias("corners"), F.col("f.type").alias("kind"), "f.properties.n")


@query(f"WITH {FINAL} SELECT id, CAST(floor(viability * 1000 + 0.5e0) AS BIGINT) AS viability, CAST(floor(final * 1000 + 0.5e0) AS BIGINT) AS final FROM fin WHERE viability >= 0.02")
def basemap(spark, d):
    """Rows of the base map."""
    return final(spark, d).filter("viability >= 0.02").select("id", milli(F.col("viability")).alias("viability"), milli(F.col("final")).alias("final"))


RANK = f"""{L.POINTS}, {L.SITES}, {L.cells_sql('points', 'pc')}, n AS (SELECT p.id, min((p.x - s.sx) * (p.x - s.sx) + (p.y - s.sy) * (p.y - s.sy)) AS d2 FROM points p, sites s GROUP BY 1),
g AS (SELECT cell_id, count(*) AS facilities, min(d2) AS d2, max(CASE WHEN balance > 9500 THEN 1 ELSE 0 END) AS has_dc, max(CASE WHEN nation % 7 = 0 THEN 1 ELSE 0 END) AS hard, max((nation * 37) % 100) AS people FROM pc JOIN n ON pc.id = n.id GROUP BY 1),
v AS (SELECT *, 1e0 / (1 + sqrt(d2) / 10000) AS viability, people / 100e0 AS penalty FROM g)"""


@query(
    f"""WITH {RANK} SELECT cell_id, facilities, CAST(d2 AS BIGINT) AS d2, CAST(floor(viability * (1 - penalty) * 1000000 + 0.5e0) AS BIGINT) AS score,
CASE WHEN has_dc = 1 THEN 'Existing Data Center' WHEN hard = 1 THEN 'Hard Exclusion' WHEN penalty >= 0.5 THEN 'High Community Impact' WHEN viability * (1 - penalty) >= 0.5 THEN 'Candidate' ELSE 'Low Viability' END AS category
FROM v ORDER BY score DESC, cell_id LIMIT 20"""
)
def site_ranking(spark, d):
    """Cells ranked by a score from the nearest site and a penalty: the flagship, end to end."""
    p = with_cells(L.points(spark, d), L.EDGE)
    near = spatial.nearest(p, L.sites(spark, d), "id", ["site"], 4000.0).select("id", "d2")
    g = p.join(near, "id").groupBy("cell_id").agg(F.count("*").alias("facilities"), F.min("d2").alias("d2"), F.max((F.col("balance") > 9500).cast("int")).alias("has_dc"), F.max((F.col("nation") % 7 == 0).cast("int")).alias("hard"), F.max((F.col("nation") * 37) % 100).alias("people"))
    v = g.withColumn("viability", 1 / (1 + F.sqrt("d2") / 10000)).withColumn("penalty", F.col("people") / 100)
    score = scoring.final_score(F.col("viability"), F.col("penalty"))
    out = v.select("cell_id", "facilities", F.col("d2").cast("long").alias("d2"), milli(score, 1000000).alias("score"), scoring.category(F.col("has_dc"), F.col("hard") == 1, F.col("penalty"), score, F.lit(0)).alias("category"))
    return out.orderBy(F.desc("score"), "cell_id").limit(20)
