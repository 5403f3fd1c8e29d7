"""Vector tiles: features cut to tiles, put on a whole-number grid and encoded.

Each feature is cut before the shuffle, so a tile's task gets only the piece that lies in it.
Points and lines always stay; polygons smaller than ``min_area`` grid cells may be left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.operators.tiling import feature_tiles

EXTENT, BUFFER = 4096, 64
#: Fixed values of the format: geometry kinds.
KINDS = {"point": 1, "line": 2, "polygon": 3}
_PIECE = "z int, x int, y int, layer string, id long, kind int, parts array<array<int>>, props map<string,string>"


def number(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def block(field: int, data: bytes) -> bytes:
    return number(field << 3 | 2) + number(len(data)) + data


def on_grid(points: list[tuple[float, float]], z: int, x: int, y: int) -> list[tuple[float, float]]:
    """Degrees as grid coordinates of a tile, y downwards."""
    n = 1 << z
    made = []
    for lon, lat in points:
        s = math.sin(math.radians(max(-85.05112878, min(85.05112878, lat))))
        made.append((((lon + 180) / 360 * n - x) * EXTENT, ((0.5 - math.log((1 + s) / (1 - s)) / (4 * math.pi)) * n - y) * EXTENT))
    return made


def cut_line(points: list[tuple[float, float]], low: float, high: float) -> list[list[tuple[float, float]]]:
    """The parts of a line inside the square: each step is limited by the four sides in turn."""
    parts: list[list[tuple[float, float]]] = []
    for (ax, ay), (bx, by) in zip(points, points[1:], strict=False):
        t0, t1 = 0.0, 1.0
        for start, way in ((ax, bx - ax), (ay, by - ay)):
            if way == 0:
                if not low <= start <= high:
                    t0, t1 = 1.0, 0.0
                continue
            near, far = sorted(((low - start) / way, (high - start) / way))
            t0, t1 = max(t0, near), min(t1, far)
        if t0 > t1:
            continue
        a, b = (ax + t0 * (bx - ax), ay + t0 * (by - ay)), (ax + t1 * (bx - ax), ay + t1 * (by - ay))
        if parts and t0 == 0 and parts[-1][-1] == a:
            parts[-1].append(b)
        else:
            parts.append([a, b])
    return parts


def cut_ring(points: list[tuple[float, float]], low: float, high: float) -> list[tuple[float, float]]:
    """A closed ring inside the square, one side after another; without the closing point."""
    ring = points[:-1] if points and points[0] == points[-1] else points
    for axis, edge, keep_low in ((0, low, False), (0, high, True), (1, low, False), (1, high, True)):
        inside = (lambda p, a=axis, e=edge: p[a] <= e) if keep_low else (lambda p, a=axis, e=edge: p[a] >= e)
        made = []
        for p, q in zip(ring, ring[1:] + ring[:1], strict=True):
            if inside(p):
                made.append(p)
            if inside(p) != inside(q):
                t = (edge - p[axis]) / (q[axis] - p[axis])
                made.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        ring = made
    return ring


def area(ring: list[tuple[int, int]]) -> float:
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def _steps(points: list[tuple[float, float]]) -> list[tuple[int, int]]:
    made: list[tuple[int, int]] = []
    for p in points:
        at = (round(p[0]), round(p[1]))
        if not made or made[-1] != at:
            made.append(at)
    return made


def shape(kind: str, points: list[tuple[float, float]], min_area: float) -> list[list[tuple[int, int]]]:
    """The whole-number parts of a feature in a tile; none if it lies outside."""
    low, high = -BUFFER, EXTENT + BUFFER
    if kind == "point":
        return [[p] for p in _steps([q for q in points if 0 <= q[0] < EXTENT and 0 <= q[1] < EXTENT])]
    if kind == "line":
        # A line shorter than a grid cell stays, as one step.
        return [p if len(p) > 1 else [p[0], (p[0][0] + 1, p[0][1])] for p in map(_steps, cut_line(points, low, high))]
    ring = _steps(cut_ring(points, low, high))
    ring = ring[:-1] if len(ring) > 1 and ring[0] == ring[-1] else ring
    if len(ring) < 3 or abs(area(ring)) < max(min_area, 0.5):
        return []
    return [ring if area(ring) > 0 else ring[::-1]]


def commands(kind: int, parts: list[list[tuple[int, int]]]) -> list[int]:
    """Drawing commands: moves, lines and closings with folded differences."""
    fold = lambda v: v << 1 if v >= 0 else (-v << 1) - 1
    out, x, y = [], 0, 0
    if kind == 1:
        parts = [[p[0] for p in parts]]
    for part in parts:
        heads = len(part) if kind == 1 else 1
        for i, (px, py) in enumerate(part):
            if i == 0:
                out.append(heads << 3 | 1)
            elif i == heads:
                out.append((len(part) - 1) << 3 | 2)
            out += [fold(px - x), fold(py - y)]
            x, y = px, py
        if kind == 3:
            out.append(1 << 3 | 7)
    return out


def encode_layer(name: str, features: list[tuple[int, int, list[int], dict[str, str]]]) -> bytes:
    """A layer of (id, kind, commands, properties)."""
    keys: dict[str, int] = {}
    values: dict[str, int] = {}
    body = b""
    for i, kind, drawn, props in features:
        tags = b"".join(number(keys.setdefault(k, len(keys))) + number(values.setdefault(v, len(values))) for k, v in sorted(props.items()) if v is not None)
        own = (number(1 << 3) + number(i) if i is not None and i >= 0 else b"") + (block(2, tags) if tags else b"")
        body += block(2, own + number(3 << 3) + number(kind) + block(4, b"".join(map(number, drawn))))
    tables = b"".join(block(3, k.encode()) for k in keys) + b"".join(block(4, block(1, v.encode())) for v in values)
    return block(3, number(15 << 3) + number(2) + block(1, name.encode()) + body + tables + number(5 << 3) + number(EXTENT))


def pieces(features: DataFrame, zoom: Column, min_area: float = 0.0) -> DataFrame:
    """Features (``layer``, ``id``, ``kind``, ``geometry`` of lon and lat, ``props``) cut to the tiles of a zoom: drawing commands by part."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                points = [(p["lon"], p["lat"]) for p in r["geometry"] or [] if p and p["lon"] is not None and p["lat"] is not None]
                # The buffer reaches into neighbours; each tile is met by its own row.
                parts = shape(r["kind"], on_grid(points, r["z"], r["x"], r["y"]), min_area)
                if parts:
                    rows.append({**{k: r[k] for k in ("z", "x", "y", "layer", "id", "props")}, "kind": KINDS[r["kind"]], "parts": [[c for p in part for c in p] for part in parts]})
            schema = pa.schema([("z", pa.int32()), ("x", pa.int32()), ("y", pa.int32()), ("layer", pa.string()), ("id", pa.int64()), ("kind", pa.int32()), ("parts", pa.list_(pa.list_(pa.int32()))), ("props", pa.map_(pa.string(), pa.string()))])
            yield pa.RecordBatch.from_pylist([{**r, "props": list((dict(r["props"]) if r["props"] else {}).items())} for r in rows], schema=schema)

    named = features.where(F.col("kind").isin(*KINDS)).select("layer", F.col("id").cast("long").alias("id"), "kind", "geometry", "props")
    met = feature_tiles(named, zoom).select(F.col("z").cast("int").alias("z"), F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), "layer", "id", "kind", "geometry", "props")
    return met.mapInArrow(cut, _PIECE)


def vector_tiles(features: DataFrame, zoom: Column, min_area: float = 0.0) -> DataFrame:
    """Encoded tiles: ``z``, ``x``, ``y``, ``n`` (features), ``data``.  Features within a tile go by layer and id.

    Rows without geometry, or of a kind other than point, line and polygon, draw nothing; null
    properties are left out; an empty table gives an empty table.
    """
    each = F.struct("layer", "id", "kind", "parts", F.array_sort(F.map_entries("props")).alias("props"))
    tiles = pieces(features, zoom, min_area).groupBy("z", "x", "y").agg(F.array_sort(F.collect_list(each)).alias("f"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, data = [], []
            for found in batch.column(3).to_pylist():
                layers: dict[str, list] = {}
                for f in found:
                    parts = [list(zip(p[::2], p[1::2], strict=True)) for p in f["parts"]]
                    layers.setdefault(f["layer"] or "", []).append((f["id"], f["kind"], commands(f["kind"], parts), {e["key"]: e["value"] for e in f["props"] or []}))
                counts.append(len(found))
                data.append(b"".join(encode_layer(k, v) for k, v in layers.items()))
            yield pa.record_batch([*batch.columns[:3], pa.array(counts, pa.int32()), pa.array(data, pa.binary())], names=["z", "x", "y", "n", "data"])

    return tiles.mapInArrow(encode, "z int, x int, y int, n int, data binary")
