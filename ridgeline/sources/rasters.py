"""Rasters as GeoTIFF files: one band, tiled or striped, plain or deflated.

Reading takes two steps.  A file's header, read by byte ranges, gives one row for each of its blocks;
then each block is read where its row lies.  No task holds a whole raster, and blocks outside a
window are never read.  Writing deflates each block in its own row and joins only the deflated ones.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.sources.elements import _open

#: Field types of the format: code of struct, bytes.
TYPES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 6: ("b", 1), 8: ("h", 2), 9: ("i", 4), 11: ("f", 4), 12: ("d", 8), 16: ("Q", 8)}
SAMPLES = {1: "u", 2: "i", 3: "f"}
PLAIN, DEFLATED, NO_PREDICTOR, DIFFERENCES, FLOAT_BYTES = 1, (8, 32946), 1, 2, 3

META = "path string, tile string, cols int, rows int, kind string, nodata double, epsg int, x0 double, y1 double, res_x double, res_y double"
PIECES = f"{META}, row0 int, col0 int, height int, width int, at long, size long, packing int, predictor int"


def fields(file) -> tuple[str, dict[int, tuple]]:
    """Byte order and the fields of a file's first image, large files (64-bit offsets) included."""
    file.seek(0)
    start = file.read(16)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    version = struct.unpack_from(f"{order}H", start, 2)[0] if order else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    large = version == 43
    file.seek(struct.unpack_from(f"{order}{'Q' if large else 'I'}", start, 8 if large else 4)[0])
    (n,) = struct.unpack(f"{order}{'Q' if large else 'H'}", file.read(8 if large else 2))
    entry, found = 20 if large else 12, {}
    table = file.read(n * entry)
    for k in range(n):
        tag, kind = struct.unpack_from(f"{order}HH", table, k * entry)
        if kind not in TYPES:
            continue
        (count,) = struct.unpack_from(f"{order}{'Q' if large else 'I'}", table, k * entry + 4)
        code, size = TYPES[kind]
        room = 8 if large else 4
        data = table[(k + 1) * entry - room : (k + 1) * entry]
        if count * size > room:
            file.seek(struct.unpack(f"{order}{'Q' if large else 'I'}", data)[0])
            data = file.read(count * size)
        found[tag] = (data[:count],) if code == "s" else struct.unpack_from(f"{order}{count * len(code)}{code[0]}", data)
    return order, found


def described(path: str) -> tuple[dict, list[dict]]:
    """What the header says of a raster, and of each of its blocks.  A block without bytes is empty and left out."""
    with _open(path) as file:
        order, f = fields(file)
    one = lambda tag, default=None: f.get(tag, (default,))[0]
    if one(277, 1) != 1 or one(259, PLAIN) not in (PLAIN, *DEFLATED):
        raise ValueError(f"{path}: only one band, plain or deflated")
    cols, rows = one(256), one(257)
    scale, tie = f.get(33550, (1.0, 1.0, 0.0)), f.get(33922, (0.0, 0.0, 0.0, 0.0, 0.0, 0.0))
    keys = f.get(34735, ())
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    nodata = one(42113, b"").split(b"\0")[0].strip()
    about = {
        "path": path, "tile": path.rsplit("/", 1)[-1].rsplit(".", 1)[0], "cols": cols, "rows": rows, "kind": f"{order}{SAMPLES[one(339, 1)]}{one(258, 1) // 8}",
        "nodata": float(nodata) if nodata else None, "epsg": codes.get(3072, codes.get(2048)),
        "x0": tie[3] - tie[0] * scale[0], "y1": tie[4] + tie[1] * scale[1], "res_x": scale[0], "res_y": scale[1],
    }
    width, height = (one(322), one(323)) if 322 in f else (cols, min(one(278, rows), rows))
    at, size = (f[324], f[325]) if 322 in f else (f[273], f[279])
    across = -(-cols // width)
    pieces = [
        {"row0": k // across * height, "col0": k % across * width, "height": height if 322 in f else min(height, rows - k * height), "width": width,
         "at": a, "size": b, "packing": one(259, PLAIN), "predictor": one(317, NO_PREDICTOR)}
        for k, (a, b) in enumerate(zip(at, size, strict=True)) if b
    ]
    return about, pieces


def unpacked(data: bytes, kind: str, height: int, width: int, packing: int, predictor: int) -> np.ndarray:
    raw = zlib.decompress(data) if packing in DEFLATED else data
    size = int(kind[2:])
    if predictor == FLOAT_BYTES:
        planes = np.cumsum(np.frombuffer(raw, np.uint8, height * width * size).reshape(height, width * size), axis=1, dtype=np.uint8)
        return np.ascontiguousarray(planes.reshape(height, size, width).transpose(0, 2, 1)).view(f">{kind[1:]}")[:, :, 0]
    grid = np.frombuffer(raw, kind, height * width).reshape(height, width)
    return np.cumsum(grid, axis=1, dtype=kind[1:]) if predictor == DIFFERENCES else grid


def _listed(spark: SparkSession, folder: str, names: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", "true").load(folder).select("path")


def raster_meta(spark: SparkSession, folder: str, names: str = "*.tif") -> DataFrame:
    """One row per raster: path, tile, size, kind, nodata, epsg and its corner and cell size, with ``west``, ``south``, ``east`` and ``north``."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [described(p)[0] for p in batch["path"]]
            yield pd.DataFrame(found, columns=[c.split()[0] for c in META.split(", ")]).astype({"epsg": "Int32"})

    found = _listed(spark, folder, names).mapInPandas(read, META)
    return found.selectExpr("*", "x0 AS west", "y1 - rows * res_y AS south", "x0 + cols * res_x AS east", "y1 AS north")


def raster_cells(spark: SparkSession, folder: str, box: tuple[float, float, float, float] | None = None, names: str = "*.tif") -> DataFrame:
    """Cells that hold a value: ``tile``, ``rows``, ``cols``, ``row``, ``col``, ``x`` and ``y`` (centre), ``v``.

    With a box (west, south, east, north) only blocks that meet it are read, and only cells whose centre it holds are returned.
    """

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                about, pieces = described(path)
                yield pd.DataFrame([about | p for p in pieces], columns=[c.split()[0] for c in PIECES.split(", ")]).astype({"epsg": "Int32"})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, group in batch.groupby("path", sort=False):
                with _open(path) as file:
                    for p in group.itertuples():
                        file.seek(p.at)
                        grid = unpacked(file.read(p.size), p.kind, p.height, p.width, p.packing, p.predictor)
                        grid = grid[: p.rows - p.row0, : p.cols - p.col0].astype(np.float64)
                        nodata = np.float64(np.dtype(p.kind).type(p.nodata)) if p.kind[1] == "f" and not pd.isna(p.nodata) else p.nodata
                        row, col = np.nonzero(~np.isnan(grid) & (grid != (math.nan if pd.isna(nodata) else nodata)))
                        yield pd.DataFrame({
                            "tile": p.tile, "rows": p.rows, "cols": p.cols, "row": row + p.row0, "col": col + p.col0,
                            "x": p.x0 + (col + p.col0 + 0.5) * p.res_x, "y": p.y1 - (row + p.row0 + 0.5) * p.res_y, "v": grid[row, col],
                        })

    blocks = _listed(spark, folder, names).mapInPandas(listed, PIECES)
    if box:
        west, south, east, north = box
        meets = "x0 + col0 * res_x <= {2} AND x0 + (col0 + width) * res_x >= {0} AND y1 - row0 * res_y >= {1} AND y1 - (row0 + height) * res_y <= {3}"
        blocks = blocks.where(meets.format(*(f"{float(v)!r}D" for v in box)))
    cells = blocks.repartition("path", "row0", "col0").mapInPandas(read, "tile string, rows int, cols int, row int, col int, x double, y double, v double")
    return cells.where(F.col("x").between(west, east) & F.col("y").between(south, north)) if box else cells


def geotiff(blocks: dict[tuple[int, int], bytes], rows: int, cols: int, side: int, kind: str, x0: float, y1: float, res: float, epsg: int, nodata: float | None) -> bytes:
    """A file of deflated blocks by (block row, block column); blocks that are missing have no bytes."""
    order = [blocks.get((r, c), b"") for r in range(-(-rows // side)) for c in range(-(-cols // side))]
    sample = {v: k for k, v in SAMPLES.items()}[kind[0]]
    degrees = 4000 <= epsg < 5000
    model = (1, 1, 0, 3, 1024, 0, 1, 2 if degrees else 1, 1025, 0, 1, 1, 2048 if degrees else 3072, 0, 1, epsg)
    values = [
        (256, "I", (cols,)), (257, "I", (rows,)), (258, "H", (int(kind[1:]) * 8,)), (259, "H", (DEFLATED[0],)), (262, "H", (1,)), (277, "H", (1,)), (322, "I", (side,)), (323, "I", (side,)),
        (324, "I", (0,) * len(order)), (325, "I", tuple(map(len, order))), (339, "H", (sample,)), (33550, "d", (res, res, 0.0)), (33922, "d", (0.0, 0.0, 0.0, x0, y1, 0.0)), (34735, "H", model),
    ]
    if nodata is not None:
        values.append((42113, "s", (f"{nodata:.17g}".encode() + b"\0",)))
    code = {"H": 3, "I": 4, "d": 12, "s": 2}
    body = lambda c, v: v[0] if c == "s" else struct.pack(f"<{len(v)}{c}", *v)
    spill = 8 + 2 + 12 * len(values) + 4
    first = spill + sum(len(b) + len(b) % 2 for b in (body(c, v) for _, c, v in values) if len(b) > 4)
    if first + sum(map(len, order)) >= 1 << 32:
        raise ValueError("a raster above 4 GB: write it in more than one tile")
    starts = np.cumsum([first, *map(len, order[:-1])]) if order else []
    values = [(t, c, tuple(int(s) if b else 0 for s, b in zip(starts, order, strict=True)) if t == 324 else v) for t, c, v in values]
    table, rest = struct.pack("<H", len(values)), b""
    for tag, c, v in values:
        data = body(c, v)
        table += struct.pack("<HHI", tag, code[c], len(data) if c == "s" else len(v))
        table += data.ljust(4, b"\0") if len(data) <= 4 else struct.pack("<I", spill + len(rest))
        rest += data + b"\0" * (len(data) % 2) if len(data) > 4 else b""
    return b"".join([b"II*\0", struct.pack("<I", 8), table, bytes(4), rest, *order])


def raster_files(cells: DataFrame, value: str, *, x0: float = 0.0, y1: float = 0.0, res: float = 1.0, epsg: int = 3006, kind: str = "f4", nodata: float | None = -9999.0, side: int = 256) -> DataFrame:
    """Cells (tile, rows, cols, row, col, value) as one GeoTIFF for each tile: ``tile``, ``data``.

    Columns ``x0`` and ``y1`` of cells, where they exist, place each tile.  Cells without a row or a
    value become nodata, or 0 without one.  Values are rounded to the kind's numbers, not clipped.
    """
    west, north = (F.col(c) if c in cells.columns else F.lit(v) for c, v in (("x0", x0), ("y1", y1)))
    place = cells.select("tile", "rows", "cols", west.cast("double").alias("x0"), north.cast("double").alias("y1"), F.expr(f"row div {side}").alias("brow"), F.expr(f"col div {side}").alias("bcol"),
                         F.expr(f"cast((row % {side}) * {side} + col % {side} AS int)").alias("pos"), F.col(value).cast("double").alias("v"))
    keys = ["tile", "rows", "cols", "x0", "y1", "brow", "bcol"]
    filled = place.groupBy(*keys).agg(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("pos", "v"))).alias("held")).selectExpr(*keys, "held.pos AS pos", "held.v AS v")

    def deflated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = []
            for pos, v in zip(batch["pos"], batch["v"], strict=True):
                grid = np.full(side * side, 0 if nodata is None else nodata, dtype=np.float64)
                grid[np.asarray(pos, dtype=int)] = np.asarray(v, dtype=float)
                data.append(zlib.compress((grid if kind[0] == "f" else np.rint(grid)).astype(f"<{kind}").tobytes(), 6))
            yield batch[keys].assign(data=data)

    packed = filled.mapInPandas(deflated, "tile string, rows int, cols int, x0 double, y1 double, brow int, bcol int, data binary")
    tiles = packed.groupBy("tile", "rows", "cols", "x0", "y1").agg(F.collect_list(F.struct("brow", "bcol", "data")).alias("blocks"))

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [geotiff({(b["brow"], b["bcol"]): bytes(b["data"]) for b in t.blocks}, t.rows, t.cols, side, kind, t.x0, t.y1, res, epsg, nodata) for t in batch.itertuples()]
            yield pd.DataFrame({"tile": batch["tile"], "data": made})

    return tiles.mapInPandas(joined, "tile string, data binary")


def write_files(made: DataFrame, folder: str, ending: str = ".tif") -> int:
    """Writes ``data`` to folder/``tile``ending from the tasks, under another name first, so that a lost or
    repeated task leaves no part of a file.  Folder: one that executors share.  Returns the number of files."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, plain = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
        system.create_dir(plain, recursive=True)
        for batch in batches:
            for tile, data in zip(batch["tile"], batch["data"], strict=True):
                part = f"{plain}/.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(data)
                system.move(part, f"{plain}/{tile}{ending}")
            yield pd.DataFrame({"n": [len(batch)]})

    return made.mapInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0
