"""Raster values as bytes.  Arithmetic is in 32-bit floats, rounding to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(value, F.lit(high)), F.lit(low))


def terrain_code(elevation: Column) -> Column:
    """24-bit code: tenths of a metre above -10000 m."""
    moved = (elevation.cast("float") + F.lit(10000.0).cast("float")).cast("float")
    tenths = (moved / F.lit(0.1).cast("float")).cast("float")
    return _clip(F.rint(tenths), 0.0, float(2**24 - 1)).cast("long")


def terrain_rgb(elevation: Column) -> dict[str, Column]:
    code = terrain_code(elevation)
    return {"r": F.shiftright(code, 16).cast("int"), "g": F.shiftright(code, 8).bitwiseAND(255).cast("int"), "b": code.bitwiseAND(255).cast("int")}


def terrain_elevation(r: Column, g: Column, b: Column) -> Column:
    return (r * 65536 + g * 256 + b) * 0.1 - 10000


def canopy_byte(height: Column, top: float = 35.0) -> Column:
    scaled = (height.cast("float") / F.lit(top).cast("float")).cast("float") * F.lit(255.0).cast("float")
    return _clip(F.rint(scaled.cast("float")), 0.0, 255.0).cast("int")


def wetness_byte(percent: Column) -> Column:
    return _clip(F.rint((percent.cast("float") * F.lit(2.55).cast("float")).cast("float")), 0.0, 255.0).cast("int")


def relief_byte(relief: Column, limit: float = 3.0) -> Column:
    """Relief between -limit and limit; 128 is level."""
    return F.rint((_clip(relief / limit, -1.0, 1.0) + 1.0) * 127.5).cast("int")


def overlay_channels(canopy: Column, wetness: Column, sky: Column | None = None) -> dict[str, Column]:
    """Red is reserved (0), green sky view, blue canopy, alpha wetness; a channel without data is 0."""
    byte = lambda c: F.coalesce(c, F.lit(0))
    return {"r": F.lit(0), "g": byte(sky) if sky is not None else F.lit(0), "b": byte(canopy_byte(canopy)), "a": byte(wetness_byte(wetness))}
