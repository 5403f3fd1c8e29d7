"""Colours of slopes, ramps, categories and statuses."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the map style.
SLOPE_STOPS = ((0.0, (33, 102, 224)), (1.0, (33, 102, 224)), (5.0, (255, 140, 0)), (math.degrees(math.atan(0.25)), (220, 30, 30)), (45.0, (154, 30, 200)))
RAMPS = {
    "wetness": ((168, 138, 91), (27, 79, 114)),
    "vegetation": ((194, 178, 128), (18, 63, 18)),
    "canopy": ((245, 240, 232), (200, 230, 160), (116, 184, 110), (45, 122, 58), (13, 74, 31)),
    "density": ((245, 240, 232), (212, 232, 176), (122, 184, 112), (45, 110, 45), (10, 58, 10)),
}
#: Colour of water as shares of full light; hue, saturation and the lightness at the slider's ends.
WATER = (0.4, 0.6, 0.85)
SHADOW, HIGHLIGHT = (240, 15, 8, 40), (45, 30, 55, 90)
STATUS = {"clear": "#4caf50", "overgrown": "#e0b400", "partially_blocked": "#e0791e", "fully_blocked": "#d43d3d"}
POINT = {"clear": "#4caf50", "comment": "#5ba4cf", "image": "#9a5ec8"}
LANDUSE = {"forest": "#2d4a2d", "wood": "#2d4a2d", "farmland": "#6b7a3a", "meadow": "#4a6b3a", "wetland": "#3a5a6b", "heath": "#5a4a3a"}
SCALE = {"0": "#4caf50", "1": "#2196f3", "1+": "#1565c0", "2": "#e53935", "3": "#880e4f"}


def lookup(value: Column, colours: dict[str, str], otherwise: str | None = None) -> Column:
    found = F.coalesce(*[F.when(value == k, F.lit(v)) for k, v in colours.items()])
    return found if otherwise is None else F.coalesce(found, F.lit(otherwise))


def ramp(share: Column, name: str) -> dict[str, Column]:
    """Colour between a ramp's evenly spaced stops at a share of 0 to 1."""
    t, stops, out = F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0)), RAMPS[name], {}
    last = len(stops) - 1
    for k, channel in enumerate("rgb"):
        value = None
        for i, (a, b) in enumerate(zip(stops, stops[1:], strict=False)):
            piece = F.lit(float(a[k])) + (b[k] - a[k]) * (t * last - i if last > 1 else t)
            value = F.when(t <= (i + 1) / last, piece) if value is None else value.when(t <= (i + 1) / last, piece)
        out[channel] = F.rint(value).cast("int")
    return out


def shaded(share: Column, shade: Column, water: Column, name: str = "canopy", weight: float = 0.3) -> dict[str, Column]:
    """A ramp's colour over a hillshade, 0 to 1 for each channel; water has one flat colour."""
    return {c: F.when(water, w).otherwise(blend(shade, v / 255, weight)) for (c, v), w in zip(ramp(share, name).items(), WATER, strict=True)}


def light_colours(altitude: Column) -> dict[str, Column]:
    """Shadow and highlight as HSL at a sun's altitude of 0 to 1; lightness goes evenly through its range, an addition of ours."""
    t = F.greatest(F.least(altitude, F.lit(1.0)), F.lit(0.0))
    return {n: F.format_string(f"hsl({h}, {s}%%, %d%%)", F.rint(low + (high - low) * t).cast("int")) for n, (h, s, low, high) in (("shadow", SHADOW), ("highlight", HIGHLIGHT))}


def slope_colour(degrees: Column) -> dict[str, Column]:
    """Piecewise linear between the stops, clamped at both ends."""
    out = {}
    for k, channel in enumerate("rgb"):
        value = F.when(degrees <= SLOPE_STOPS[0][0], float(SLOPE_STOPS[0][1][k]))
        for (d0, c0), (d1, c1) in zip(SLOPE_STOPS, SLOPE_STOPS[1:], strict=False):
            value = value.when(degrees <= d1, c0[k] + (c1[k] - c0[k]) * (degrees - d0) / (d1 - d0))
        out[channel] = F.rint(value.otherwise(float(SLOPE_STOPS[-1][1][k]))).cast("int")
    return out


def blend(shade: Column, colour: Column, share: float = 0.3) -> Column:
    return F.greatest(F.least(shade * share + colour * (1 - share), F.lit(1.0)), F.lit(0.0))
