"""Impact weights, categories, explanations and exports of scored cells."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weights of the impact components, and the columns that exclude a cell.
WEIGHTS = {
    "in_protected_area": 1.0, "in_wetland": 1.0, "in_floodplain_100yr": 0.6, "in_high_wildfire": 0.5, "in_high_seismic": 0.4,
    "high_water_stress": 0.5, "demographic_index": 0.7, "population": 0.6, "in_tribal_land": 1.0, "in_critical_habitat": 0.9,
}
HARD_EXCLUSIONS = ["in_protected_area", "in_wetland", "in_tribal_land", "in_critical_habitat"]
#: Texts of the reasons.
FLAG_REASONS = [
    ("in_protected_area", "Inside protected federal land (PAD-US GAP 1/2)"),
    ("in_tribal_land", "Sovereign tribal territory (AIANNH)"),
    ("in_wetland", "Wetland area — permitting barrier"),
    ("in_critical_habitat", "ESA critical habitat designation"),
    ("in_floodplain_100yr", "100-year flood zone (FEMA NRI)"),
    ("in_high_wildfire", "High wildfire hazard"),
    ("in_high_seismic", "High seismic risk zone"),
    ("high_water_stress", "High baseline water stress"),
]
VIABLE = 0.15


def normalized_by_max(df: DataFrame, column: str, out: str, quantile: float | None = None) -> DataFrame:
    """A column divided by its greatest value (or a quantile), cut at 1; 0 where that is not positive."""
    top = df.agg((F.percentile(column, quantile) if quantile else F.max(column)).alias("_top"))  # one row
    value = F.when(F.col("_top") > 0, F.least(F.lit(1.0), F.coalesce(column, F.lit(0)) / F.col("_top"))).otherwise(0.0)
    return df.join(F.broadcast(top), how="inner", on=F.lit(True)).withColumn(out, value).drop("_top")


def penalty(weights: dict[str, float] = WEIGHTS, prefix: str = "c_") -> Column:
    """Weighted mean of the components, cut to [0, 1]; nulls count 0."""
    parts = [F.coalesce(F.col(prefix + c).cast("double"), F.lit(0.0)) * w for c, w in weights.items()]
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), reduce(lambda a, b: a + b, parts) / sum(weights.values())))


def final_score(viability: Column, impact: Column) -> Column:
    """Viability less its penalised part, in [0, 1]."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), viability * (1 - impact)))


def category(has_dc: Column, hard: Column, impact: Column, final: Column, soft: Column) -> Column:
    """The display category."""
    out = F.when(has_dc == 1, "Existing Data Center").when(hard, "Hard Exclusion").when(impact >= 0.5, "High Community Impact")
    return out.when((final >= 0.5) & (F.coalesce(soft, F.lit(0)) == 0), "Candidate").otherwise("Low Viability")


def is_hard(columns=tuple(HARD_EXCLUSIONS)) -> Column:
    """Whether any excluding flag is set; null counts as not set."""
    return reduce(lambda a, b: a | b, (F.coalesce(F.col(c), F.lit(0)) == 1 for c in columns))


def rescored(components: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    """Final scores under other weights: `weights` (scenario, component, weight) holds a few rows a
    scenario; components stay in their rows, and each is weighed where it stands."""
    pivoted = weights.groupBy("scenario").pivot("component", list(WEIGHTS)).agg(F.first("weight"))
    wide = pivoted.select("scenario", *(F.coalesce(c, F.lit(0.0)).alias(f"w_{c}") for c in WEIGHTS))
    total = reduce(lambda a, b: a + b, (F.col(f"w_{c}") for c in WEIGHTS))
    parts = [F.coalesce(F.col(f"c_{c}").cast("double"), F.lit(0.0)) * F.col(f"w_{c}") for c in WEIGHTS]
    joined = components.join(F.broadcast(wide), how="inner", on=F.lit(True))
    impact = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.try_divide(reduce(lambda a, b: a + b, parts), total), F.lit(0.0))))
    return joined.select("scenario", key, final_score(F.col("viability"), impact).alias("final_score"))


def reasons() -> Column:
    """What speaks against a cell, else what speaks for a strong one, else a general remark."""
    set_ = lambda c: F.coalesce(F.col(c), F.lit(0)) == 1
    text = lambda fmt, c: F.format_string(fmt, F.col(c).cast("double"))
    against = [F.when(set_(c), t) for c, t in FLAG_REASONS]
    against += [
        F.when(F.col("dist_nearest_ixp_km") > 500, text("Distant from backbone internet (%.0f km to nearest IXP)", "dist_nearest_ixp_km")),
        F.when(F.col("dist_transmission_km") > 75, text("Far from high-voltage transmission (%.0f km)", "dist_transmission_km")),
        F.when(F.col("dist_substation_km") > 75, text("Far from electrical substation (%.0f km)", "dist_substation_km")),
        F.when(F.col("annual_cdd") > 2000, text("High cooling load (%.0f CDD annually)", "annual_cdd")),
        F.when(F.col("pop_within_25mi") < 5000, "Very low population — limited workforce access"),
        F.when(F.col("mean_slope_deg") > 10, text("Steep terrain (%.1f° avg slope)", "mean_slope_deg")),
        F.when(set_("high_ej_burden"), "High environmental justice burden area"),
    ]
    strong = [
        F.when(F.col("dist_nearest_ixp_km") < 100, text("Strong backbone connectivity (%.0f km to IXP)", "dist_nearest_ixp_km")),
        F.when(F.col("elec_price_mwh") < 60, text("Low industrial electricity cost ($%.0f/MWh)", "elec_price_mwh")),
        F.when(set_("cooling_favorable"), "Climate favorable for free-air cooling"),
    ]
    bad, good = F.array_compact(F.array(*against)), F.array_compact(F.array(*strong))
    viability = F.coalesce(F.col("viability"), F.lit(0.0))
    remark = F.array(F.when(viability < VIABLE, "Low combined infrastructure and market accessibility score").otherwise("Moderate suitability — review feature details"))
    return F.when(F.size(bad) > 0, bad).when((viability >= 0.6) & (F.size(good) > 0), good).otherwise(remark)


def merged(master: DataFrame, scores: DataFrame, key: str = "cell_id", needed=tuple(HARD_EXCLUSIONS)) -> DataFrame:
    """The master table with its cells' scores (viability, and has_dc and is_soft if given): no score is a
    viability of 0 and no soft positive, a facility flag of the master counts before the scores' one.  A
    master without one of the needed columns is an error that names it."""
    if missing := [c for c in (key, *needed) if c not in master.columns]:
        raise ValueError(f"the master table lacks {missing}")
    if missing := [c for c in (key, "viability") if c not in scores.columns]:
        raise ValueError(f"the scores lack {missing}")
    kept = [c for c in ("viability", "has_dc", "is_soft") if c in scores.columns]
    both = master.drop("viability", "is_soft").join(scores.select(key, *(F.col(c).alias(f"_{c}") for c in kept)), key, "left")
    had = [F.col("has_dc")] if "has_dc" in master.columns else []
    had += [F.col("_has_dc")] if "has_dc" in kept else []
    out = both.withColumn("viability", F.coalesce("_viability", F.lit(0.0))).withColumn("is_soft", F.coalesce(F.col("_is_soft") if "is_soft" in kept else F.lit(0), F.lit(0)).cast("int"))
    if had:
        out = out.withColumn("has_dc", F.coalesce(*had, F.lit(0)).cast("int"))
    return out.drop(*(f"_{c}" for c in kept))


def candidates(df: DataFrame, least: float = VIABLE) -> DataFrame:
    """Viable cells without a facility that are not soft positives."""
    return df.filter((F.col("viability") >= least) & (F.coalesce("has_dc", F.lit(0)) == 0) & (F.coalesce("is_soft", F.lit(0)) == 0))
