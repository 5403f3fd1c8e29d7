"""Point clouds to grids, and grids to coarser grids.  Cells are rows (tile, row, col); an empty cell has no row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUND, WATER = 2, 9
CANOPY_FLOOR = 0.5


def extents(points: DataFrame, res: float = 1.0) -> DataFrame:
    """Extent and grid size of each tile, over all its points."""
    box = points.groupBy("tile").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    return box.withColumns({"cols": F.ceil((F.col("x1") - F.col("x0")) / res).cast("int"), "rows": F.ceil((F.col("y1") - F.col("y0")) / res).cast("int")})


def indexed(points: DataFrame, extent: DataFrame, res: float = 1.0) -> DataFrame:
    """Points with their cell; row 0 is north, and a point on the far edge of a whole-numbered extent falls outside.

    The extents are one row per tile; Spark broadcasts them while they are small and shuffles otherwise.
    """
    placed = points.join(extent, "tile").withColumns({"col": ((F.col("x") - F.col("x0")) / res).cast("int"), "row": ((F.col("y1") - F.col("y")) / res).cast("int")})
    return placed.where("col >= 0 and col < cols and row >= 0 and row < rows").drop("x0", "x1", "y0", "y1")


def surfaces(points: DataFrame, res: float = 1.0) -> DataFrame:
    """All surfaces in one pass: ``dtm`` (mean ground), ``dsm`` (highest return), ``density`` (share off the ground), ``water``.

    Sums, counts and maxima combine before the only shuffle, so a tile with most of the points costs no more than its cells.
    """
    cells = indexed(points, extents(points, res), res)
    ground = F.col("cls") == GROUND
    out = cells.groupBy("tile", "rows", "cols", "row", "col").agg(
        F.sum(F.when(ground, F.col("z"))).alias("gz"), F.count(F.when(ground, True)).alias("gn"), F.max("z").alias("dsm"),
        F.count("*").alias("n"), F.bool_or(F.col("cls") == WATER).alias("water"),
    )
    return out.select(
        "tile", "rows", "cols", "row", "col", F.when(F.col("gn") > 0, F.col("gz") / F.col("gn")).alias("dtm"), "dsm",
        ((F.col("n") - F.col("gn")) / F.col("n")).alias("density"), "water", "n",
    )


def canopy(dsm: Column, dtm: Column) -> Column:
    """Height above ground: nothing below zero, and nothing under half a metre; null where either surface is."""
    return height_of(dsm - dtm)


def height_of(difference: Column) -> Column:
    """What counts as canopy of a difference of surfaces: nothing below zero, and nothing under half a metre."""
    return F.when(difference < CANOPY_FLOOR, 0.0).otherwise(difference)


def filled_canopy(cells: DataFrame) -> DataFrame:
    """Canopy height of all cells of each tile: the difference of the surfaces, where both are, with its gaps filled."""
    from ridgeline.operators.focal import fill_gaps

    difference = cells.select("tile", "rows", "cols", "row", "col", (F.col("dsm") - F.col("dtm")).alias("chm"))
    return fill_gaps(difference, "chm").withColumn("chm", height_of(F.col("chm")))


def overview(cells: DataFrame, factor: int, *values: str) -> DataFrame:
    """Coarser grid: the mean of each factor x factor block's cells that have data."""
    coarse = {"row": F.floor(F.col("row") / factor).cast("int"), "col": F.floor(F.col("col") / factor).cast("int")}
    return cells.withColumns(coarse).groupBy("tile", "row", "col").agg(*[F.avg(v).alias(v) for v in values])


def pyramid(cells: DataFrame, value: str, factors: tuple[int, ...] = (2, 4, 8, 16, 32, 64, 128, 256)) -> DataFrame:
    """Overviews by each factor: ``factor``, ``tile``, ``row``, ``col`` and the mean of the cells with data.

    Sums and counts roll up from factor to factor (each a multiple of the one before), so that each
    level reads a fraction of the one before and every mean is that of the full grid's cells.
    """
    level = cells.where(F.col(value).isNotNull()).select("tile", "row", "col", F.col(value).cast("double").alias("s"), F.lit(1).cast("long").alias("n"))
    out, before = None, 1
    for factor in factors:
        if factor % before:
            raise ValueError("each factor must be a multiple of the one before")
        step, before = factor // before, factor
        coarse = {"row": F.floor(F.col("row") / step).cast("int"), "col": F.floor(F.col("col") / step).cast("int")}
        level = level.withColumns(coarse).groupBy("tile", "row", "col").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        made = level.select(F.lit(factor).alias("factor"), "tile", "row", "col", (F.col("s") / F.col("n")).alias(value))
        out = made if out is None else out.unionByName(made)
    return out


def mosaic(*grids: DataFrame) -> DataFrame:
    """Union of grids; where they overlap the later one shows."""
    layers = [g.withColumn("_layer", F.lit(i)) for i, g in enumerate(grids)]
    whole = layers[0]
    for layer in layers[1:]:
        whole = whole.unionByName(layer)
    others = [c for c in grids[0].columns if c not in ("row", "col")]
    return whole.groupBy("row", "col").agg(F.max_by(F.struct(*others), "_layer").alias("v")).select("row", "col", "v.*")
