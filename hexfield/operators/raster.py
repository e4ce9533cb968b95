"""Raster operators on pixel tables (row, col, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Land-cover classes and their groups.
CLASS_NAMES = {
    11: "Open Water", 12: "Perennial Ice/Snow", 21: "Developed, Open Space", 22: "Developed, Low Intensity",
    23: "Developed, Medium Intensity", 24: "Developed, High Intensity", 31: "Barren Land (Rock/Sand/Clay)",
    41: "Deciduous Forest", 42: "Evergreen Forest", 43: "Mixed Forest", 52: "Shrub/Scrub", 71: "Grassland/Herbaceous",
    81: "Pasture/Hay", 82: "Cultivated Crops", 90: "Woody Wetlands", 95: "Emergent Herbaceous Wetlands",
}
CLASS_GROUPS = {
    "developed": [21, 22, 23, 24], "developed_high": [23, 24], "forest": [41, 42, 43], "agriculture": [81, 82],
    "shrub_grassland": [52, 71], "wetland": [90, 95], "barren": [31], "water": [11],
}


def zonal_classes(cells: DataFrame, pixels: DataFrame, key: str, groups: dict[str, Sequence[int]] = CLASS_GROUPS) -> DataFrame:
    """For each cell the pixels in it (which carry the key), their share in each class group and the
    dominant class (the least of equals); cells without pixels have nulls and 0 pixels."""
    counts = pixels.filter(F.col("class").isNotNull()).groupBy(key, "class").agg(F.count("*").alias("n"))
    share = [(F.sum(F.when(F.col("class").isin(*g), F.col("n")).otherwise(0)) / F.sum("n")).alias(f"pct_{name}") for name, g in groups.items()]
    stats = counts.groupBy(key).agg(F.sum("n").alias("total_pixels"), F.min_by("class", F.struct(-F.col("n"), F.col("class"))).alias("dominant_class"), *share)
    return cells.select(key).join(stats, key, "left").fillna(0, subset=["total_pixels"])


def zonal_stats(cells: DataFrame, pixels: DataFrame, key: str, nodata: float | None = None, more: Sequence[Column] = ()) -> DataFrame:
    """Mean, greatest, population deviation and number of the values in each cell, with further aggregates."""
    valid = pixels.filter(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))
    valid = valid if nodata is None else valid.filter(F.col("value") != nodata)
    stats = valid.groupBy(key).agg(F.avg("value").alias("mean"), F.max("value").alias("most"), F.stddev_pop("value").alias("deviation"), F.count("*").alias("pixels"), *more)
    return cells.select(key).join(stats, key, "left").fillna(0, subset=["pixels"])


def pixel_of(x: Column, y: Column, x0: float, y0: float, dx: float, dy: float) -> tuple[Column, Column]:
    """(row, col) under a point for a raster whose upper left corner is (x0, y0)."""
    return F.floor((F.lit(y0) - y) / dy).cast("int"), F.floor((x - x0) / dx).cast("int")


def sample_points(points: DataFrame, pixels: DataFrame, key: str, bands: Sequence[int] | None = None) -> DataFrame:
    """The value of the pixel under each point (row, col); negative or missing is null.  With bands the
    values come as one column each."""
    valid = pixels.filter("value >= 0")
    if bands is None:
        return points.select(key, "row", "col").join(valid.select("row", "col", "value"), ["row", "col"], "left").select(key, "value")
    wide = valid.groupBy("row", "col").pivot("band", list(bands)).agg(F.first("value"))
    return points.select(key, "row", "col").join(wide, ["row", "col"], "left").select(key, *(F.col(str(b)).alias(f"band_{b}") for b in bands))


def focal_disk_sum(points: DataFrame, pixels: DataFrame, key: str, radius: int, width: int) -> DataFrame:
    """Sum of the values within a disk of pixels around each point (row, col); what is missing, negative
    or outside the raster of the given width counts 0.

    Prefix sums along each raster row turn the disk into one span for each of its 2 * radius + 1 rows, so
    a place costs two lookups a row, whatever the disk's area.  Rows are filled to their whole width
    first; a raster row is the unit of one task, and its length is the raster's, not the data's.  Points of
    one pixel are looked up once, and lookups, far more than the points that they come from, are never broadcast.
    """
    valid = pixels.filter("value > 0").groupBy("row", "col").agg(F.sum("value").alias("value"))
    rows = valid.select("row").distinct().select("row", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("col"))
    full = rows.join(valid, ["row", "col"], "left").fillna(0, subset=["value"])
    upto = F.sum("value").over(Window.partitionBy("row").orderBy("col").rowsBetween(Window.unboundedPreceding, 0))
    sums = full.select("row", "col", upto.alias("upto"))
    at = points.select(F.col("row").alias("at_row"), F.col("col").alias("at_col")).distinct()
    spans = at.select("at_row", "at_col", F.explode(F.sequence(F.lit(-radius), F.lit(radius))).alias("dy"))
    half = F.floor(F.sqrt(F.lit(radius * radius) - F.col("dy") * F.col("dy"))).cast("int")
    first, last = F.greatest(F.col("at_col") - half, F.lit(0)), F.least(F.col("at_col") + half, F.lit(width - 1))
    spans = spans.filter(first <= last)
    ends = F.array(F.struct((first - 1).alias("col"), F.lit(-1).alias("sign")), F.struct(last.alias("col"), F.lit(1).alias("sign")))
    lookups = spans.select("at_row", "at_col", (F.col("at_row") + F.col("dy")).alias("row"), F.explode(ends).alias("e")).select("at_row", "at_col", "row", "e.*")
    found = lookups.hint("merge").join(sums, ["row", "col"]).groupBy("at_row", "at_col").agg(F.sum(F.col("sign") * F.col("upto")).alias("total"))
    out = found.withColumnsRenamed({"at_row": "row", "at_col": "col"})
    return points.select(key, "row", "col").join(out, ["row", "col"], "left").select(key, "total").fillna(0, subset=["total"])


def regridded(pixels: DataFrame, x: Column, y: Column, size: float) -> DataFrame:
    """Pixels averaged into square cells of a metric grid by their projected centres."""
    binned = pixels.withColumn("gx", F.floor(x / size).cast("long")).withColumn("gy", F.floor(y / size).cast("long"))
    return binned.groupBy("gx", "gy").agg(F.avg("value").alias("value"), F.count("*").alias("pixels"))


def density_count(density: Column, area: float) -> Column:
    """Density times area, null without a valid density."""
    return F.when(density >= 0, density * area)


def cover_tiers(share: Column, tiers: Sequence[float] = (0.0, 0.25, 0.5)) -> list[Column]:
    """Flags: any cover at all, then at least each tier; null is 0."""
    return [F.coalesce(((share > t) if t == 0 else (share >= t)).cast("int"), F.lit(0)).alias(f"cover_{round(t * 100)}") for t in tiers]
