"""Single-file tile archives (public format, version 3) and what to upload of a folder.

Tiles are put in order of their place on the Hilbert curve by Spark; the driver streams them into
the file a partition at a time and keeps a few numbers for each tile.
"""

from __future__ import annotations

import gzip
import json
import os
import shutil
import struct
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format: size of the head, of head and root directory together, codes of compressions and kinds.
HEAD, ROOT_END = 127, 16384
PLAIN, GZIP = 1, 2
TILE_KINDS = {"mvt": 1, "png": 2, "jpg": 3, "webp": 4}


def tile_number(z: Column, x: Column, y: Column) -> Column:
    """Place of a tile in the archive: tiles of lower zooms, then the distance along the zoom's Hilbert curve."""
    side = F.call_function("shiftleft", F.lit(1).cast("long"), z)

    def step(a: Column, bit: Column) -> Column:
        s = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
        rx, ry = F.call_function("shiftright", a["x"], bit) % 2, F.call_function("shiftright", a["y"], bit) % 2
        d = a["d"] + s * s * (3 * rx).bitwiseXOR(ry)
        turned, flip = ry == 0, (ry == 0) & (rx == 1)
        u, v = F.when(flip, side - 1 - a["x"]).otherwise(a["x"]), F.when(flip, side - 1 - a["y"]).otherwise(a["y"])
        return F.struct(F.when(turned, v).otherwise(u).alias("x"), F.when(turned, u).otherwise(v).alias("y"), d.alias("d"))

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))
    bits = F.when(z > 0, F.sequence(z.cast("int") - 1, F.lit(0))).otherwise(F.array().cast("array<int>"))
    lower = F.expr("0L") + F.aggregate(F.when(z > 0, F.sequence(F.lit(0), z.cast("int") - 1)).otherwise(F.array().cast("array<int>")), F.lit(0).cast("long"), lambda a, k: a + F.call_function("shiftleft", F.lit(1).cast("long"), 2 * k))
    return lower + F.aggregate(bits, start, step, lambda a: a["d"])


def _number(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def directory(entries: list[tuple[int, int, int, int]]) -> bytes:
    """Compressed columns of (tile, offset, length, run)."""
    out, last = bytearray(_number(len(entries))), 0
    for tile, *_ in entries:
        out += _number(tile - last)
        last = tile
    for column in (3, 2):
        for entry in entries:
            out += _number(entry[column])
    end = None
    for _, offset, length, _ in entries:
        out += _number(0 if offset == end else offset + 1)
        end = offset + length
    return gzip.compress(bytes(out), mtime=0)


def directories(entries: list[tuple[int, int, int, int]]) -> tuple[bytes, bytes]:
    """The root directory, and the leaves it points to where it can't hold all entries."""
    root = directory(entries)
    size = 4096
    leaves = b""
    while len(root) > ROOT_END - HEAD:
        parts, leaves = [], b""
        for i in range(0, len(entries), size):
            leaf = directory(entries[i : i + size])
            parts.append((entries[i][0], len(leaves), len(leaf), 0))
            leaves += leaf
        root, size = directory(parts), size * 2
    return root, leaves


def write_archive(tiles: DataFrame, path: str, kind: str = "png", about: dict | None = None, box: tuple[float, float, float, float] = (-180.0, -85.0, 180.0, 85.0), packed: bool = False) -> int:
    """Writes tiles (z, x, y, data) to one file and returns their number.

    Empty and null tiles are left out; of repeated ones the largest data stays.  Equal data that
    occurs more than once is stored once, and neighbours that share it become one entry.
    """
    kept = tiles.where("data is not null and octet_length(data) > 0").groupBy("z", "x", "y").agg(F.max("data").alias("data")).withColumn("digest", F.sha2("data", 256))
    repeated = kept.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest", F.lit(True).alias("shared"))
    ordered = kept.join(repeated, "digest", "left").withColumn("tile", tile_number(F.col("z"), F.col("x"), F.col("y"))).sort("tile")
    entries: list[tuple[int, int, int, int]] = []
    stored: dict[str, int] = {}
    n = at = contents = 0
    low, high = 99, 0
    with tempfile.TemporaryFile(dir=os.path.dirname(os.path.abspath(path))) as body:
        for t in ordered.select("tile", "z", "digest", "shared", "data").toLocalIterator():
            n, low, high = n + 1, min(low, t.z), max(high, t.z)
            known = stored.get(t.digest) if t.shared else None
            if known is None:
                known, contents = at, contents + 1
                body.write(t.data)
                at += len(t.data)
                if t.shared:
                    stored[t.digest] = known
            if entries and entries[-1][1] == known and entries[-1][0] + entries[-1][3] == t.tile:
                entries[-1] = (*entries[-1][:3], entries[-1][3] + 1)
            else:
                entries.append((t.tile, known, len(t.data), 1))
        root, leaves = directories(entries)
        text = gzip.compress(json.dumps(about or {}).encode(), mtime=0)
        starts = [HEAD, HEAD + len(root), HEAD + len(root) + len(text), HEAD + len(root) + len(text) + len(leaves)]
        places = [v for start, length in zip(starts, (len(root), len(text), len(leaves), at), strict=True) for v in (start, length)]
        degrees = [round(v * 1e7) for v in box]
        low = low if n else 0
        head = b"PMTiles\x03" + struct.pack("<11Q", *places, n, len(entries), contents) + struct.pack("<6B", 1, GZIP, GZIP if packed else PLAIN, TILE_KINDS[kind], low, high)
        head += struct.pack("<4iB2i", *degrees, low, (degrees[0] + degrees[2]) // 2, (degrees[1] + degrees[3]) // 2)
        attempt = f"{path}.part"
        with open(attempt, "wb") as file:
            file.write(head + root + text + leaves)
            body.seek(0)
            shutil.copyfileobj(body, file)
        os.replace(attempt, path)
    return n


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """``name`` (path within the folder), ``size`` and ``digest`` of all files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    base = folder.rstrip("/").split("://", 1)[-1].removeprefix("file:")
    return files.select(F.expr("substr(path, instr(path, base) + length(base) + 1)".replace("base", "'" + base.replace("'", "\\'") + "'")).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("digest"))


def to_upload(here: DataFrame, there: DataFrame) -> DataFrame:
    """Files that the other side lacks or holds with other contents."""
    return here.join(there.select("name", "digest").distinct(), ["name", "digest"], "left_anti")
