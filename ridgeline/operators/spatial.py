"""Distance joins, raster look-ups, and places found or created."""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.functions.geo import EARTH_RADIUS, haversine, to_grid
from ridgeline.functions.text import whole_number
from ridgeline.operators.storage import materialize, release


def _height(metres: float) -> float:
    """Degrees of latitude of a row of cells."""
    # A hundredth more than on the sphere covers the spheroid too, whose degrees are up to 0.7 % shorter.
    return math.degrees(metres / EARTH_RADIUS) * 1.01


def _around(row: Column, metres: float) -> Column:
    """Cells in a row around the earth: as many as are at least as wide as the radius at the row's far
    edge and one row beyond it, so that points within the radius lie in the same or in touching cells."""
    dy = _height(metres)
    far = F.least(F.greatest(F.abs(row), F.abs(row + 1)) * dy + dy, F.lit(90.0))
    ratio = math.sin(math.radians(dy) / 2) / F.greatest(F.cos(F.radians(far)), F.lit(1e-12))
    return F.when(ratio >= 1, 1).otherwise(F.greatest(F.floor(math.pi / F.asin(F.least(ratio, F.lit(1.0)))), F.lit(1))).cast("long")


def cell_of(lon: Column, lat: Column, metres: float) -> Column:
    """(cy, cx) of a point: rows of latitude from the equator, cells of each row eastwards from 180 W."""
    row = F.floor(lat / _height(metres))
    n = _around(row, metres)
    return F.struct(row.alias("cy"), F.pmod(F.floor(F.pmod(lon + 180, F.lit(360.0)) / 360 * n), n).alias("cx"))


def cells_near(lon: Column, lat: Column, metres: float) -> Column:
    """The cells in which points within the radius can lie: three in each of three rows, across 180 degrees, fewer near a pole."""

    def of_row(step: int) -> Column:
        row = F.floor(lat / _height(metres)) + step
        n = _around(row, metres)
        own = F.floor(F.pmod(lon + 180, F.lit(360.0)) / 360 * n)
        return F.array(*[F.struct(row.alias("cy"), F.pmod(own + k, n).alias("cx")) for k in (-1, 0, 1)])

    return F.array_distinct(F.concat(*[of_row(step) for step in (-1, 0, 1)]))


def nearest_within(probes: DataFrame, known: DataFrame, metres: float, distance: Callable[[Column, Column, Column, Column], Column] = haversine) -> DataFrame:
    """Nearest known place of each probe within a radius, at any latitude and across 180 degrees:
    ``probe_id``, ``known_id``, ``metres``; ties by id.  ``distance`` is ``geo.haversine`` or ``geo.spheroid_distance``.

    Each probe looks into the cells around it, so the join is on equal cells; the nearest is
    kept by an aggregation that combines before its shuffle.
    """
    asked = probes.select("probe_id", F.col("lon").alias("plon"), F.col("lat").alias("plat"), F.explode(cells_near(F.col("lon"), F.col("lat"), metres)).alias("c"))
    held = known.select("known_id", "lon", "lat", cell_of(F.col("lon"), F.col("lat"), metres).alias("c")).select("known_id", "lon", "lat", "c.*")
    asked = asked.select("probe_id", "plon", "plat", "c.*")
    near = asked.join(held, ["cy", "cx"]).withColumn("metres", distance(F.col("plon"), F.col("plat"), F.col("lon"), F.col("lat"))).where(F.col("metres") <= metres)
    return near.groupBy("probe_id").agg(F.min(F.struct("metres", "known_id")).alias("m")).select("probe_id", "m.known_id", "m.metres")


def cell_values(points: DataFrame, cells: DataFrame, x0: float, y1: float, res: float) -> DataFrame:
    """Points with the raster value under them; outside the raster there is none."""
    placed = points.withColumns({"col": F.floor((F.col("x") - x0) / res).cast("int"), "row": F.floor((F.lit(y1) - F.col("y")) / res).cast("int")})
    return placed.join(cells.select("row", "col", "v"), ["row", "col"], "left")


def fill_elevation(peaks: DataFrame, cells: DataFrame, x0: float, y1: float, res: float) -> DataFrame:
    """Peaks without an elevation take the raster's, rounded half to even, as text."""
    found = cell_values(peaks, cells, x0, y1, res)
    own = F.when(F.coalesce("ele", F.lit("")) != "", F.col("ele"))
    return found.withColumn("ele", F.coalesce(own, whole_number(F.col("v")))).drop("v", "row", "col")


def bilinear(targets: DataFrame, cells: DataFrame, x0: float, y1: float, res: float) -> DataFrame:
    """Targets (``id``, x, y) with the value between the four cell centres around them; empty neighbours leave their weight to the others."""
    fx, fy = (F.col("x") - x0) / res - 0.5, (F.lit(y1) - F.col("y")) / res - 0.5
    corner = lambda i, j: F.struct((F.floor(fy) + j).cast("int").alias("row"), (F.floor(fx) + i).cast("int").alias("col"), (F.abs(fx - F.floor(fx) - (1 - i)) * F.abs(fy - F.floor(fy) - (1 - j))).alias("w"))
    asked = targets.select("id", F.inline(F.array(*[corner(i, j) for i in (0, 1) for j in (0, 1)])))
    met = asked.join(cells.select("row", "col", "v"), ["row", "col"], "left").where("w > 0")
    weight = F.sum(F.when(F.col("v").isNotNull(), F.col("w")))
    return met.groupBy("id").agg((F.sum(F.col("v") * F.col("w")) / weight).alias("v"))


def tile_pixels(tiles: DataFrame, size: int = 256) -> DataFrame:
    """Pixel centres of web map tiles (``z``, ``x``, ``y``): with ``px``, ``py``, ``lon`` and ``lat``."""
    step = F.lit(2.0) * math.pi / F.pow(F.lit(2.0), F.col("z"))
    cut = tiles.select("z", "x", "y", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("py")).select("*", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("px"))
    east = (F.col("x") + (F.col("px") + 0.5) / size) * step - math.pi
    north = F.lit(math.pi) - (F.col("y") + (F.col("py") + 0.5) / size) * step
    return cut.withColumns({"lon": F.degrees(east), "lat": F.degrees(F.atan(F.sinh(north)))})


def warped_tiles(tiles: DataFrame, cells: DataFrame, x0: float, y1: float, res: float, size: int = 256) -> DataFrame:
    """Web map tiles of a raster in the national grid (EPSG:3006), pixel by pixel between the four cell
    centres around it: ``z``, ``x``, ``y``, ``px``, ``py``, ``v``.  Pixels outside the raster are left out."""
    east, north = to_grid(F.col("lon"), F.col("lat"))
    spot = F.struct("z", "x", "y", "px", "py").alias("id")
    targets = tile_pixels(tiles, size).select(spot, east.alias("x"), north.alias("y"))
    return bilinear(targets, cells, x0, y1, res).where("v is not null").select("id.*", "v")


class _Index:
    """Places by cells of space as wide as the radius, so that a point looks into 27 of them."""

    def __init__(self, metres: float):
        self.metres, self.cells = metres, {}

    def _at(self, lon: float, lat: float) -> tuple[int, int, int]:
        a, b = math.radians(lon), math.radians(lat)
        return tuple(math.floor(EARTH_RADIUS * v / self.metres) for v in (math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b)))

    def add(self, place, lon: float, lat: float) -> None:
        self.cells.setdefault(self._at(lon, lat), []).append((place, lon, lat))

    def nearest(self, lon: float, lat: float) -> tuple | None:
        """(metres, place) within the radius; ties by place."""
        x, y, z = self._at(lon, lat)
        near = [(_apart(lon, lat, a, b), k) for i in (-1, 0, 1) for j in (-1, 0, 1) for m in (-1, 0, 1) for k, a, b in self.cells.get((x + i, y + j, z + m), ())]
        return min((n for n in near if n[0] <= self.metres), default=None)


def _apart(lon1: float, lat1: float, lon2: float, lat2: float) -> float:
    p, q = math.radians(lat1), math.radians(lat2)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS * math.asin(math.sqrt(min(1.0, h)))


def find_or_create(points: DataFrame, metres: float = 15.0, places: DataFrame | None = None) -> DataFrame:
    """Points in order of (created_at, id) take the nearest place within reach or become one: ``id``, ``place_id``, ``created``.

    ``places`` (place_id of the points' id type, lon, lat) are those that exist already.  The outcome
    depends on the order, so points that could meet stay together: those in touching cells form a
    group, found by repeated minima over touching cells and over labels' own labels.  Each group is
    worked through in order, with an index of its places, so that a dense group costs what it has of
    points and not of pairs; one group is one task.  Existing places connect no points; each goes to
    all groups that could meet it.  Points without a position, or an id, belong to no place.
    """
    name = lambda c: F.concat_ws(":", c["cy"], c["cx"])
    here, near = cell_of(F.col("lon"), F.col("lat"), metres), F.transform(cells_near(F.col("lon"), F.col("lat"), metres), name)
    placed = points.where("id is not null and lon is not null and lat is not null").select("id", "lon", "lat", "created_at", name(here).alias("cell"), near.alias("near"))
    placed = materialize(placed)
    cells = placed.select(F.col("cell").alias("key")).distinct()
    steps = placed.select(F.col("cell").alias("a"), F.explode("near").alias("b")).distinct()
    touching = materialize(steps.join(cells.withColumnRenamed("key", "b"), "b", "left_semi"))
    labels, moved = cells.withColumn("label", F.col("key")), True
    last = None
    while moved:
        both = touching.unionByName(touching.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(labels, F.col("a") == F.col("key"))
        told = both.groupBy("b").agg(F.min("label").alias("least"))
        heard = materialize(labels.join(told, F.col("key") == F.col("b")).select("key", F.least("label", "least").alias("label"), (F.col("least") < F.col("label")).alias("moved")))
        moved = bool(heard.where("moved").limit(1).count())
        # A cell also takes the label of the cell it is labelled after, so labels double their reach each round.
        roots = heard.select(F.col("key").alias("label"), F.col("label").alias("root"))
        labels = materialize(heard.join(roots, "label").select("key", F.least("label", "root").alias("label")))
        release(heard)
        if last is not None:
            release(last)
        last = labels
    kind = points.schema["id"].dataType.simpleString()
    rows = placed.join(labels, F.col("cell") == F.col("key")).select("label", F.lit(False).alias("known"), "id", "lon", "lat", "created_at")
    if places is not None:
        held = places.select(F.col("place_id").cast(kind).alias("id"), "lon", "lat", name(here).alias("key"))
        reach = touching_of(placed, labels)
        known = held.join(reach, "key").select("label", F.lit(True).alias("known"), "id", "lon", "lat", F.lit(None).cast(points.schema["created_at"].dataType).alias("created_at"))
        rows = rows.unionByName(known.distinct())

    def work(part: pd.DataFrame) -> pd.DataFrame:
        index, out = _Index(metres), []
        for k, lon, lat in part.loc[part["known"], ["id", "lon", "lat"]].itertuples(index=False):
            index.add(k, lon, lat)
        new = part[~part["known"]].sort_values(["created_at", "id"])
        for k, lon, lat in new[["id", "lon", "lat"]].itertuples(index=False):
            met = index.nearest(lon, lat)
            if met is None:
                index.add(k, lon, lat)
            out.append((k, k if met is None else met[1], met is None))
        return pd.DataFrame(out, columns=["id", "place_id", "created"])

    return rows.groupBy("label").applyInPandas(work, f"id {kind}, place_id {kind}, created boolean")


def touching_of(placed: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, label): the cells in which a group's points can meet places."""
    return placed.join(labels, F.col("cell") == F.col("key")).select("label", F.explode("near").alias("key")).distinct()


def inside(lon: Column, lat: Column, ring: Column) -> Column:
    """Whether a point lies in a closed ring (array of lon, lat), by the parity of crossings."""
    edges = F.arrays_zip(F.slice(ring, 1, F.size(ring) - 1).alias("a"), F.slice(ring, 2, F.size(ring) - 1).alias("b"))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((a["lat"] > lat) != (b["lat"] > lat)) & (lon < (b["lon"] - a["lon"]) * (lat - a["lat"]) / (b["lat"] - a["lat"]) + a["lon"])

    return F.size(F.filter(edges, crosses)) % 2 == 1


def entered(track: DataFrame, ring: Column) -> DataFrame:
    """Fixes of a track (``track_id``, ``at``, lon, lat) at which it enters the ring."""
    now = track.withColumn("_in", inside(F.col("lon"), F.col("lat"), ring))
    before = F.lag("_in", 1, False).over(Window.partitionBy("track_id").orderBy("at"))
    return now.withColumn("_was", before).where("_in and not _was").drop("_in", "_was")


def crossings(track: DataFrame, line: Column) -> DataFrame:
    """Fixes of a track (``track_id``, ``at``, lon, lat) at which the step to them crosses the line (array of lon, lat); touching an end counts on one side only."""
    order = Window.partitionBy("track_id").orderBy("at")
    stepped = track.withColumns({"_lon": F.lag("lon").over(order), "_lat": F.lag("lat").over(order)})
    edges = F.arrays_zip(F.slice(line, 1, F.size(line) - 1).alias("a"), F.slice(line, 2, F.size(line) - 1).alias("b"))
    left = lambda px, py, qx, qy, x, y: (qx - px) * (y - py) - (qy - py) * (x - px) > 0
    lon, lat, x, y = F.col("lon"), F.col("lat"), F.col("_lon"), F.col("_lat")

    def crossed(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return (left(x, y, lon, lat, a["lon"], a["lat"]) != left(x, y, lon, lat, b["lon"], b["lat"])) & (left(a["lon"], a["lat"], b["lon"], b["lat"], x, y) != left(a["lon"], a["lat"], b["lon"], b["lat"], lon, lat))

    return stepped.where(F.col("_lon").isNotNull() & F.exists(edges, crossed)).drop("_lon", "_lat")
