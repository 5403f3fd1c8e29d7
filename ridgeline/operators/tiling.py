"""Work lists and states of tile pyramids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remaining(work: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Work that isn't done; a result of no bytes doesn't count as done."""
    finished = done.where("size > 0") if "size" in done.columns else done
    return work.join(finished.select(*keys).distinct(), list(keys), "left_anti")


def common_extent(extents: DataFrame) -> DataFrame:
    """Intersection of all extents; no row if they share nothing."""
    return extents.agg(F.max("west").alias("west"), F.max("south").alias("south"), F.min("east").alias("east"), F.min("north").alias("north")).where("west < east and south < north")


def totals(tiles: DataFrame) -> DataFrame:
    """Tiles written and present by zoom and in all (null zoom)."""
    return tiles.rollup("z").agg(F.count_if(F.col("state") == "written").alias("written"), F.count_if(F.col("state") == "present").alias("present"), F.count("*").alias("tiles"))


def stacked(canopy: DataFrame, wetness: DataFrame) -> DataFrame:
    """Pixels of both rasters side by side, whichever has them."""
    return canopy.withColumnRenamed("v", "canopy").join(wetness.withColumnRenamed("v", "wetness"), ["z", "x", "y", "px"], "full")


def parsed_paths(files: DataFrame, path_col: str = "path") -> DataFrame:
    """Tiles of paths that end in z/x/y.png or z/x/y.empty; other files aren't tiles."""
    pattern = r"(\d+)/(\d+)/(\d+)\.(png|empty)$"
    part = lambda i: F.regexp_extract(path_col, pattern, i)
    found = files.where(F.col(path_col).rlike(pattern))
    return found.select(*[part(i).cast("int").alias(n) for i, n in ((1, "z"), (2, "x"), (3, "y"))], (part(4) == "empty").alias("empty"), path_col)


def feature_tiles(features: DataFrame, zoom: Column) -> DataFrame:
    """Tiles that each feature's box meets at a zoom."""
    from ridgeline.functions.tiles import cover

    lons, lats = F.transform("geometry", lambda p: p["lon"]), F.transform("geometry", lambda p: p["lat"])
    boxed = features.withColumns({"z": zoom, "west": F.array_min(lons), "east": F.array_max(lons), "south": F.array_min(lats), "north": F.array_max(lats)})
    return cover(boxed).drop("west", "east", "south", "north")
