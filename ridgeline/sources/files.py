"""Readers and writers of tile trees, point files, rasters and feature files."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def png(pixels: bytes, width: int, height: int, channels: int = 3) -> bytes:
    """A PNG file of 8-bit RGB or RGBA pixels."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    row = width * channels
    rows = b"".join(b"\0" + pixels[i * row : (i + 1) * row] for i in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 6 if channels == 4 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows, 6)) + chunk(b"IEND", b"")


def png_tiles(pixels: DataFrame, side: int, channels: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    """Tiles (z, x, y, data) of pixel rows (z, x, y, px from 0, channels); missing pixels are 0.  A tile's pixels are bounded by its side."""
    packed = F.array_sort(F.collect_list(F.struct("px", *channels)))
    tiles = pixels.groupBy("z", "x", "y").agg(packed.alias("p"))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = []
            for cells in batch["p"]:
                raw = bytearray(side * side * len(channels))
                for cell in cells:
                    for k, c in enumerate(channels):
                        raw[cell["px"] * len(channels) + k] = cell[c] or 0
                data.append(png(bytes(raw), side, side, len(channels)))
            yield pd.DataFrame({"z": batch["z"], "x": batch["x"], "y": batch["y"], "data": data})

    return tiles.mapInPandas(draw, "z int, x int, y int, data binary")


def write_mbtiles(tiles: DataFrame, path: str, name: str, description: str = "") -> int:
    """Writes tiles (z, x, y, data) to an MBTiles file on the driver, streaming a partition at a time; a later equal tile wins."""
    import sqlite3

    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE IF NOT EXISTS metadata (name TEXT PRIMARY KEY, value TEXT)")
        db.execute("CREATE TABLE IF NOT EXISTS tiles (zoom_level INTEGER, tile_column INTEGER, tile_row INTEGER, tile_data BLOB, PRIMARY KEY (zoom_level, tile_column, tile_row))")
        n = 0
        for t in tiles.toLocalIterator(prefetchPartitions=False):
            db.execute("INSERT OR REPLACE INTO tiles VALUES (?, ?, ?, ?)", (t.z, t.x, (1 << t.z) - 1 - t.y, bytes(t.data)))
            n += 1
        low, high = db.execute("SELECT min(zoom_level), max(zoom_level) FROM tiles").fetchone()
        about = {"name": name, "format": "png", "type": "overlay", "description": description, "minzoom": low, "maxzoom": high}
        db.executemany("INSERT OR REPLACE INTO metadata VALUES (?, ?)", [(k, str(v)) for k, v in about.items() if v is not None])
    return n


def tile_files(spark: SparkSession, folder: str) -> DataFrame:
    """Tiles of a tree z/x/y.png with their bytes; empty markers included."""
    from ridgeline.operators.tiling import parsed_paths

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return parsed_paths(files).join(files.select("path", "length", "content"), "path")


def las_points(spark: SparkSession, folder: str) -> DataFrame:
    """Points of uncompressed LAS files (formats 0 to 10): tile, x, y, z, cls, return_number, number_of_returns."""
    import numpy as np

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"], strict=True):
                if data[:4] != b"LASF":
                    raise ValueError(f"{path} isn't a LAS file")
                start, kind, size, n = struct.unpack_from("<I", data, 96)[0], data[104] & 0x3F, *struct.unpack_from("<HI", data, 105)
                if data[25] >= 4 and struct.unpack_from("<Q", data, 247)[0]:
                    n = struct.unpack_from("<Q", data, 247)[0]
                scale, shift = np.array(struct.unpack_from("<3d", data, 131)), np.array(struct.unpack_from("<3d", data, 155))
                raw = np.frombuffer(data, dtype=np.uint8, count=n * size, offset=start).reshape(n, size)
                xyz = raw[:, :12].copy().view("<i4") * scale + shift
                wide = kind >= 6
                flags = raw[:, 14].astype(int)
                yield pd.DataFrame({
                    "tile": path.rsplit("/", 1)[-1].rsplit(".", 1)[0], "x": xyz[:, 0], "y": xyz[:, 1], "z": xyz[:, 2],
                    "cls": raw[:, 16].astype(int) if wide else raw[:, 15].astype(int) & 31,
                    "return_number": flags & (15 if wide else 7), "number_of_returns": flags >> (4 if wide else 3) & (15 if wide else 7),
                })

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.las").load(folder).select("path", "content")
    return files.mapInPandas(read, "tile string, x double, y double, z double, cls int, return_number int, number_of_returns int")


def write_features(features: DataFrame, folder: str) -> None:
    """GeoJSON features (layer, feature) as text, one folder a layer; layers without features have none."""
    features.select("layer", "feature").write.mode("overwrite").partitionBy("layer").text(folder)


def write_collections(features: DataFrame, folder: str, size: int = 10_000) -> None:
    """GeoJSON feature collections of up to about ``size`` features (``layer``, ``feature``), one a file, one folder a
    layer; layers without features have none."""
    n = features.where("feature is not null").groupBy("layer").count().withColumnRenamed("count", "n")
    cut = features.where("feature is not null").join(n, "layer").withColumn("part", F.pmod(F.xxhash64("feature"), F.ceil(F.col("n") / size)))
    joined = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.sort_array(F.collect_list("feature")), ","), F.lit("]}"))
    whole = cut.groupBy("layer", "part").agg(joined.alias("value")).select("layer", "value")
    whole.write.mode("overwrite").option("maxRecordsPerFile", 1).option("lineSep", "\n").partitionBy("layer").text(folder)


def byte_range(data: Column, first: Column, last: Column) -> Column:
    """Bytes first to last of a binary, both included."""
    return F.substring(data, first + 1, F.least(last, F.octet_length(data) - 1) - first + 1)


def requested_range(header: Column, size: Column) -> Column:
    """Struct of ``status``, ``first`` and ``last`` for a range request (``bytes=first-last``) of a file: 206 with the part
    that exists, 416 if none does, 400 for other units, 500 for numbers that can't be read, 200 with all of it without a header.
    A missing first byte is the file's first, a missing last one its last."""
    a, b = (F.regexp_extract(header, r"^bytes=\s*(\d*)-(\d*)\s*$", i) for i in (1, 2))
    zero = F.lit(0).cast("long")
    first, last = F.when(a == "", zero).otherwise(a.cast("long")), F.when(b == "", size - 1).otherwise(F.least(b.cast("long"), size - 1))
    status = F.when(header.isNull(), 200).when(~header.startswith("bytes="), 400).when(~header.rlike(r"^bytes=\s*\d*-\d*\s*$"), 500).when((first >= size) | (first > last), 416).otherwise(206)
    return F.struct(status.alias("status"), F.when(status == 206, first).when(status == 200, zero).alias("first"), F.when(status == 206, last).when(status == 200, size - 1).alias("last"))


def coverage(west: float, south: float, east: float, north: float) -> str:
    """GeoJSON of the world with the covered box cut out, and the box's border."""
    import json

    world = [[-180, -85], [180, -85], [180, 85], [-180, 85], [-180, -85]]
    box = [[west, south], [east, south], [east, north], [west, north], [west, south]]
    shape = lambda kind, at, role: {"type": "Feature", "properties": {"role": role}, "geometry": {"type": kind, "coordinates": at}}
    return json.dumps({"type": "FeatureCollection", "features": [shape("Polygon", [world, box], "mask"), shape("LineString", box, "border")]})
