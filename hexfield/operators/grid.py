"""Cells: lattices over an area, rings, neighbourhoods, flags and tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import SQRT3, albers, hex_axial, hex_center, hex_id, hex_neighbours, hex_ring, mercator_x, mercator_y, valid_ring
from ..sources.shared import materialized
from .polygons import edges_of, spans
from .tables import prefix_sample

#: The box of the contiguous states, edges included (lat, lat, lon, lon).
CONUS = (24.0, 50.0, -125.0, -66.0)


def with_cells(df: DataFrame, edge: float, x: str = "x", y: str = "y") -> DataFrame:
    """Adds the cell (q, r, cell_id) that holds each point."""
    q, r = hex_axial(F.col(x), F.col(y), edge)
    return df.withColumns({"q": q, "r": r}).withColumn("cell_id", hex_id(F.col("q"), F.col("r")))


def lattice(spark: SparkSession, x0: float, y0: float, x1: float, y1: float, edge: float) -> DataFrame:
    """All cells whose centre lies in a box, edges included."""
    r0, r1 = int(y0 // (1.5 * edge)) - 1, int(y1 // (1.5 * edge)) + 1
    width = SQRT3 * edge
    rows = spark.range(r0, r1 + 1).select(F.col("id").alias("r"))
    q0, q1 = F.floor(F.lit(x0 / width) - F.col("r") / 2) - 1, F.floor(F.lit(x1 / width) - F.col("r") / 2) + 1
    cells = rows.select(F.explode(F.sequence(q0.cast("long"), q1.cast("long"))).alias("q"), "r")
    x, y = hex_center(F.col("q"), F.col("r"), edge)
    return cells.select("q", "r", hex_id(F.col("q"), F.col("r")).alias("cell_id"), x.alias("x"), y.alias("y")).filter(F.col("x").between(x0, x1) & F.col("y").between(y0, y1))


def fill(boundary: DataFrame, edge: float, strict: bool = False) -> DataFrame:
    """Cells whose centre lies inside a boundary (`rings`), or inside any of several; an error if there are
    none.  Left and lower sides count as inside, with `strict` none does.  Each row of cells is filled between
    the boundary's crossings with the line of its centres, so no cell meets more of the boundary than its own
    row's crossings."""
    named = boundary.select(F.monotonically_increasing_id().alias("poly"), "rings")
    if strict:
        # inside whichever way sides along the line are taken, and between crossings, not on one
        named = materialized(named)
        edges = edges_of(named, ["poly"])
        both = [_filled(spans(edges, ["poly"], 0.0, 1.5 * edge, upper), edge).filter("x > x_in") for upper in (False, True)]
        inside = both[0].join(both[1].select("poly", "q", "r"), ["poly", "q", "r"], "left_semi")
    else:
        inside = _filled(spans(edges_of(named, ["poly"]), ["poly"], 0.0, 1.5 * edge), edge)
    inside = inside.select("q", "r", hex_id(F.col("q"), F.col("r")).alias("cell_id"), "x", "y").dropDuplicates(["q", "r"])
    if not inside.take(1):
        raise ValueError("the boundary holds no cell")
    return inside


def _filled(lines: DataFrame, edge: float) -> DataFrame:
    """Cells (poly, q, r, x, y, x_in) whose centre lies in a stretch [x_in, x_out) of their row's line."""
    width = SQRT3 * edge
    lines = lines.withColumnRenamed("row", "r")
    q = F.sequence(F.ceil(F.col("x_in") / width - F.col("r") / 2).cast("long") - 1, F.ceil(F.col("x_out") / width - F.col("r") / 2).cast("long"))
    x, y = hex_center(F.col("q"), F.col("r"), edge)
    placed = lines.withColumn("q", F.explode(q)).withColumn("x", x).filter("x >= x_in AND x < x_out")
    return placed.select("poly", "q", "r", "x", y.alias("y"), "x_in")


def center_points(cells: DataFrame, key: str = "cell_id", index: str = "__index_level_0__", albers_too: bool = False, first: int | None = None) -> DataFrame:
    """A staged grid as points (key, lat, lon, x, y in Web Mercator metres): a key that was written as the
    table's index gets its name back, and a grid that lacks a column is an error that names it.  `albers_too`
    adds ax and ay in the equal-area projection; `first` keeps the rows of so many least keys."""
    named = cells if key in cells.columns or index not in cells.columns else cells.withColumnRenamed(index, key)
    if missing := [c for c in (key, "lat", "lon") if c not in named.columns]:
        raise ValueError(f"the grid lacks {missing}; it has {named.columns}")
    out = named.select(key, "lat", "lon", mercator_x(F.col("lon")).alias("x"), mercator_y(F.col("lat")).alias("y"))
    if albers_too:
        ax, ay = albers(F.col("lon"), F.col("lat"))
        out = out.withColumns({"ax": ax, "ay": ay})
    return out if first is None else prefix_sample(out, first, key)


def with_rings(cells: DataFrame, edge: float) -> DataFrame:
    """Adds each cell's ring."""
    return cells.withColumn("ring", hex_ring(F.col("q"), F.col("r"), edge))


def neighbours(cells: DataFrame, with_self: bool = False) -> DataFrame:
    """The cells around a set of cells (q, r), each once."""
    around = cells.select(F.explode(hex_neighbours(F.col("q"), F.col("r"), with_self)).alias("n")).select("n.q", "n.r").distinct()
    return around.withColumn("cell_id", hex_id(F.col("q"), F.col("r")))


def conus_flag(df: DataFrame) -> DataFrame:
    """Adds is_conus from lat and lon."""
    return df.withColumn("is_conus", (F.col("lat").between(CONUS[0], CONUS[1]) & F.col("lon").between(CONUS[2], CONUS[3])).cast("int"))


def tiles(df: DataFrame, x: str, y: str, x0: float, y0: float, size: float) -> DataFrame:
    """Adds the tile (tx, ty); a point on a shared edge belongs to the lower tile, one on the outer edge to the first."""

    def of(v, low):
        t = (v - low) / size
        return F.greatest(F.lit(0), F.ceil(t) - 1).cast("long")

    return df.withColumn("tx", of(F.col(x), x0)).withColumn("ty", of(F.col(y), y0))


def valid_polygons(df: DataFrame, ring: str = "ring") -> DataFrame:
    """Rows whose ring is complete and has an area."""
    return df.filter(valid_ring(F.col(ring)))


def bounding_box(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Least and greatest coordinates of a layer."""
    return df.agg(F.min(x).alias("x0"), F.min(y).alias("y0"), F.max(x).alias("x1"), F.max(y).alias("y1"))
