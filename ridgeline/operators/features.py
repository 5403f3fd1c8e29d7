"""Tagged map elements to thematic layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.functions.text import plain_key

# Fixed vocabularies of map tags.
ROADS = [
    "motorway", "trunk", "primary", "secondary", "tertiary", "residential", "service", "unclassified", "living_street", "motorway_link",
    "trunk_link", "primary_link", "secondary_link", "tertiary_link",
]
TRACKS = ["track"]
PATHS = [
    "path", "footway", "cycleway", "bridleway", "steps", "pedestrian",
]
RAILS = [
    "rail", "tram", "light_rail", "subway", "narrow_gauge", "monorail", "funicular", "miniature",
]
NATURAL_LINES = [
    "cliff", "ridge", "coastline", "arete", "valley",
]
PEAKS = [
    "peak", "saddle", "volcano", "hill", "mountain_pass",
]
PLACES = [
    "city", "town", "village", "hamlet", "suburb", "locality", "island", "islet", "isolated_dwelling", "farm",
    "neighbourhood", "quarter", "borough",
]
ROUTES = [
    "mtb", "bicycle", "ski", "hiking", "foot", "horse",
]
WATER_NATURAL = [
    "water", "wetland", "bay", "strait", "lake",
]
WATER_LANDUSE = [
    "reservoir", "basin",
]
LANDUSE = [
    "forest", "farmland", "meadow", "orchard", "vineyard", "allotments", "cemetery", "commercial", "industrial", "residential",
    "retail", "military", "quarry", "landfill",
]
LANDCOVER = [
    "wood", "scrub", "heath", "grassland", "fell", "glacier", "mud", "sand", "beach", "wetland",
]
KEPT_HIGHWAYS = [
    "primary", "secondary", "tertiary", "residential", "unclassified", "service", "track", "path", "footway", "cycleway",
    "bridleway",
]
KEPT_WATERWAYS = [
    "stream", "river", "canal", "ditch",
]
KEPT_COLUMNS = [
    "osm_id", "highway", "waterway", "name", "surface", "mtb:scale", "mtb_scale", "mtb:scale:imba", "mtb_scale_imba", "tracktype",
    "geometry",
]


def tag(tags: Column, key: str) -> Column:
    """A tag's value; absent and empty are the same."""
    return F.coalesce(F.try_element_at(tags, F.lit(key)), F.lit(""))


def is_line(tags: Column) -> Column:
    """Ways that any line layer might take."""
    return (tag(tags, "highway") != "") | (tag(tags, "waterway") != "") | (tag(tags, "railway") != "") | (tag(tags, "power") == "line") | tag(tags, "natural").isin(NATURAL_LINES)


def is_simple_line(tags: Column) -> Column:
    return F.map_contains_key(tags, "highway") | F.map_contains_key(tags, "waterway")


def line_layer(tags: Column) -> Column:
    """First layer that fits; null if none does."""
    highway = tag(tags, "highway")
    return (
        F.when(highway.isin(ROADS), "roads").when(highway.isin(TRACKS), "tracks").when(highway.isin(PATHS), "paths")
        .when(tag(tags, "waterway") != "", "waterways").when(tag(tags, "railway").isin(RAILS), "railways")
        .when(tag(tags, "power") == "line", "powerlines").when(tag(tags, "natural").isin(NATURAL_LINES), "natural_lines")
    )


def point_layer(tags: Column) -> Column:
    return F.when(tag(tags, "natural").isin(PEAKS), "peaks").when(tag(tags, "place").isin(PLACES), "places")


def polygon_layers(natural: Column, landuse: Column, building: Column) -> Column:
    """All layers that fit."""
    n, u, b = (F.coalesce(c, F.lit("")) for c in (natural, landuse, building))
    return F.array_compact(F.array(
        F.when(n.isin(WATER_NATURAL) | u.isin(WATER_LANDUSE), "water"),
        F.when(u.isin(LANDUSE) | n.isin(LANDCOVER), "landuse"),
        F.when(b != "", "buildings"),
    ))


def kept_rows(df: DataFrame) -> DataFrame:
    """Rows of a kept highway or waterway, with the kept columns that exist; a missing column keeps nothing."""
    keep = F.lit(False)
    for name, values in (("highway", KEPT_HIGHWAYS), ("waterway", KEPT_WATERWAYS)):
        if name in df.columns:
            keep = keep | F.coalesce(F.col(name).isin(values), F.lit(False))
    return df.where(keep).select([c for c in KEPT_COLUMNS if c in df.columns])


def in_box(lon: Column, lat: Column, box: tuple[float, float, float, float], margin: float = 0.0) -> Column:
    west, south, east, north = box
    return lon.between(west - margin, east + margin) & lat.between(south - margin, north + margin)


def line_meets_box(geometry: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether a line's own box meets the box; touching counts."""
    west, south, east, north = box
    lons, lats = F.transform(geometry, lambda p: p["lon"]), F.transform(geometry, lambda p: p["lat"])
    return (F.array_max(lons) >= west) & (F.array_min(lons) <= east) & (F.array_max(lats) >= south) & (F.array_min(lats) <= north)


def plain_keys(features: DataFrame, id_col: str, pos_col: str, key_col: str) -> DataFrame:
    """Adds ``plain``: the n-th repeat of a normalised key within a feature gets the suffix _n."""
    key = plain_key(F.col(key_col))
    nth = F.row_number().over(Window.partitionBy(id_col, key).orderBy(pos_col)) - 1
    return features.withColumn("plain", F.when(nth == 0, key).otherwise(F.concat(key, F.lit("_"), nth.cast("string"))))


def plain_tags(entries: Column) -> Column:
    """The same within a row: an array of (key, value) in order becomes a map; a later equal key wins."""
    keyed = F.transform(entries, lambda e: F.struct(plain_key(e["key"]).alias("key"), e["value"].alias("value")))
    count = lambda e, i: F.size(F.filter(F.slice(keyed, 1, i), lambda o: o["key"] == e["key"]))
    named = F.transform(keyed, lambda e, i: F.struct(F.when(count(e, i) == 0, e["key"]).otherwise(F.concat(e["key"], F.lit("_"), count(e, i).cast("string"))).alias("key"), e["value"].alias("value")))
    last = F.filter(named, lambda e, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last)


def best_routes(relations: DataFrame, members: DataFrame) -> DataFrame:
    """The best route of each way: smallest rank of its kind, then first in the file (``seq``), then id.

    relations: relation_id, seq, route, name; members: relation_id, way_id and, where nodes or relations
    are members too, ``type`` (``w`` for ways; the others don't count).  Also returns all
    memberships.  The minimum combines before the shuffle, so a way in many relations is no burden.
    """
    rank = F.coalesce(*[F.when(F.col("route") == r, i) for i, r in enumerate(ROUTES)])
    named = relations.withColumn("rank", rank).where("rank is not null and coalesce(name, '') <> ''")
    if "type" in members.columns:
        members = members.where("type = 'w'")
    joined = named.join(members.select("relation_id", "way_id"), "relation_id")
    best = F.min_by(F.struct("route", "name", "relation_id"), F.struct("rank", "seq", "relation_id")).alias("best")
    return joined.groupBy("way_id").agg(best, F.count("*").alias("memberships")).select("way_id", F.col("best.route").alias("route_type"), F.col("best.name").alias("route_name"), F.col("best.relation_id").alias("route_relation_id"), "memberships")


def with_routes(ways: DataFrame, routes: DataFrame) -> DataFrame:
    return ways.join(routes.select("way_id", "route_type", "route_name", "route_relation_id"), "way_id", "left")


def way_lines(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Node positions of each way in order, missing nodes left out; ways of fewer than two are dropped."""
    refs = ways.select("way_id", F.posexplode("refs").alias("pos", "node_id"))
    placed = refs.join(nodes.where("lon is not null and lat is not null"), "node_id")
    points = F.transform(F.array_sort(F.collect_list(F.struct("pos", "lon", "lat"))), lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
    return placed.groupBy("way_id").agg(points.alias("geometry")).where(F.size("geometry") >= 2)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def rings(segments: DataFrame) -> DataFrame:
    """Closed rings of a polygon's member lines: ``polygon_id``, ``ring`` (array of lon, lat), from rows of ``polygon_id``, ``seq``, ``line``.

    Lines are joined end to end within a polygon, reversed where needed; lines that close no ring are left out.
    """
    import pandas as pd

    def join(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("seq")
        lines = [[(p["lon"], p["lat"]) for p in x] for x in part["line"] if x is not None and len(x) >= 2]
        found = []
        while lines:
            ring = lines.pop(0)
            while ring[0] != ring[-1]:
                for i, line in enumerate(lines):
                    if line[0] == ring[-1] or line[-1] == ring[-1]:
                        ring = ring + (line if line[0] == ring[-1] else line[::-1])[1:]
                        lines.pop(i)
                        break
                else:
                    break
            if ring[0] == ring[-1] and len(ring) >= 4:
                found.append([{"lon": a, "lat": b} for a, b in ring])
        return pd.DataFrame({"polygon_id": [part["polygon_id"].iloc[0]] * len(found), "ring": found})

    return segments.groupBy("polygon_id").applyInPandas(join, "polygon_id long, ring array<struct<lon:double,lat:double>>")
