"""Web-map tile arithmetic as column expressions (XYZ scheme, EPSG:3857)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HALF_WORLD = 20037508.3427892
TILE_PIXELS = 256


def lon_to_x(lon: Column, zoom: Column) -> Column:
    return ((lon + 180.0) / 360.0 * F.pow(F.lit(2.0), zoom)).cast("int")


def lat_to_y(lat: Column, zoom: Column) -> Column:
    angle = F.radians(lat)
    return ((1.0 - F.ln(F.tan(angle) + 1.0 / F.cos(angle)) / F.pi()) / 2.0 * F.pow(F.lit(2.0), zoom)).cast("int")


def tms_row(y: Column, zoom: Column) -> Column:
    """Row of the south-based scheme; its own inverse."""
    return F.call_function("shiftleft", F.lit(1), zoom.cast("int")) - 1 - y


def bounds(x: Column, y: Column, zoom: Column) -> dict[str, Column]:
    """West, south, east and north of a tile in metres."""
    side = F.lit(2 * HALF_WORLD) / F.pow(F.lit(2.0), zoom)
    west, north = x * side - HALF_WORLD, F.lit(HALF_WORLD) - y * side
    return {"west": west, "south": north - side, "east": west + side, "north": north}


def cover(boxes: DataFrame, zoom_col: str = "z") -> DataFrame:
    """Every tile that a box (west, south, east, north in degrees) touches, both ends included; not clamped to the world."""
    z = F.col(zoom_col)
    columns = F.sequence(lon_to_x(F.col("west"), z), lon_to_x(F.col("east"), z))
    rows = F.sequence(lat_to_y(F.col("north"), z), lat_to_y(F.col("south"), z))
    return boxes.withColumn("x", F.explode(columns)).withColumn("y", F.explode(rows))


def strips(tiles: DataFrame, width: int = 64) -> DataFrame:
    """Tiles of a row in runs of at most ``width`` columns: ``z``, ``y``, ``strip``, ``columns``."""
    from pyspark.sql import Window

    order = Window.partitionBy("z", "y").orderBy("x")
    numbered = tiles.select("z", "y", "x").distinct().withColumn("strip", F.floor((F.row_number().over(order) - 1) / width).cast("int"))
    return numbered.groupBy("z", "y", "strip").agg(F.array_sort(F.collect_list("x")).alias("columns"))
