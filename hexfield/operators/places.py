"""Named places: county layers and the county of each cell, cities by lists of names, cloud regions, states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean, geo
from ..functions.reference import CLOUD_REGIONS, STATE_BOXES
from .spatial import in_box, in_polygon

COUNTY = ["county_fips", "state", "county", "county_name"]


def county_layer(polygons: DataFrame, endings: Sequence[str] = clean.COUNTY_ENDINGS) -> DataFrame:
    """Counties (STATEFP, COUNTYFP, NAME, rings) with the state's abbreviation, the name for comparison and the
    whole code; what lies in no state is left out."""
    code = F.concat(clean.padded(F.trim("STATEFP"), 2), clean.padded(F.trim("COUNTYFP"), 3))
    rows = polygons.select(code.alias("county_fips"), clean.state_of(F.trim("STATEFP")).alias("state"), clean.strip_endings(F.col("NAME"), endings).alias("county"), F.col("NAME").alias("county_name"), "rings")
    return rows.filter("state is not null")


def with_county(cells: DataFrame, counties: DataFrame, key: str = "cell_id", size: float = 50_000.0) -> DataFrame:
    """The cells with the county that holds each; of several the least code, none gives nulls.  Columns of
    these names that the cells had before are replaced."""
    found = in_polygon(cells, counties, key, COUNTY, size)
    return cells.drop(*COUNTY).join(found, key, "left")


def by_name(df: DataFrame, endings: Sequence[str] = clean.COUNTY_ENDINGS) -> DataFrame:
    """Rows whose state and county are spelled as in a county layer: upper case, and lower case without endings."""
    return df.withColumns({"state": F.nullif(F.upper(F.trim("state")), F.lit("")), "county": clean.strip_endings(F.col("county"), endings)})


def spelled(names: DataFrame, column: str = "name") -> DataFrame:
    """Spellings of listed cities, each once: as listed, without a final city or town, and with `city` added; blank
    names and null are none."""
    raw = clean.blank_to_null(F.col(column))
    more = F.when(~F.endswith(F.lower(raw), F.lit(" city")), F.concat(raw, F.lit(" city")))
    return names.select(F.explode(F.array(raw, clean.place_name(raw), more)).alias("spelling")).filter("spelling <> ''").distinct()


def cities(places: DataFrame, names: DataFrame) -> DataFrame:
    """Centroids (name, sx, sy) of the places (NAME, rings) that a list of city names holds, as they are named
    or without brackets and a final city or town."""
    raw = F.trim("NAME")
    spellings = F.array_distinct(F.array(raw, clean.place_name(raw)))
    each = places.withColumn("_row", F.monotonically_increasing_id()).select("_row", "NAME", "rings", F.explode(spellings).alias("spelling"))
    met = each.join(spelled(names), "spelling", "left_semi").dropDuplicates(["_row"])
    middle = geo.rings_centroid(F.col("rings"))
    return met.select(F.col("NAME").alias("name"), middle["x"].alias("sx"), middle["y"].alias("sy"))


def cloud_regions(spark: SparkSession) -> DataFrame:
    """Cloud regions (provider, region, name, sx, sy) in metres."""
    rows = spark.createDataFrame(CLOUD_REGIONS, "provider string, region string, name string, lat double, lon double")
    return rows.select("provider", "region", "name", geo.mercator_x(F.col("lon")).alias("sx"), geo.mercator_y(F.col("lat")).alias("sy"))


def state_at(lat: Column, lon: Column) -> Column:
    """The abbreviation of the first state whose box holds a point, edges included."""
    return in_box(lon, lat, [(name, west, east, south, north) for name, (south, west, north, east) in STATE_BOXES.items()])


def unknown_states(df: DataFrame, column: str = "state_abb") -> DataFrame:
    """Abbreviations that name no state, each once."""
    return clean.unknown(df.select(F.upper(F.trim(column)).alias(column)), column, sorted(clean.STATES.values()))
