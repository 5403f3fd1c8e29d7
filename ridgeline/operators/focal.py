"""Neighbourhood operations on grids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OFFSETS = [(r, c) for r in (-1, 0, 1) for c in (-1, 0, 1)]


def fill_round(cells: DataFrame, value: str) -> DataFrame:
    """Each empty cell with a neighbour becomes the mean of its 3 x 3 window, whose edge cells repeat beyond the border.

    Cells send their value to their neighbours, weighted by how often the clamped window meets
    them; one aggregation with combining before the shuffle, no join.  Columns: tile, rows, cols, row, col, value.
    """
    weight = lambda a, d, n: F.lit(1) + F.when(F.lit(d == 0) & (F.col(a) == 0), 1).otherwise(0) + F.when(F.lit(d == 0) & (F.col(a) == F.col(n) - 1), 1).otherwise(0)
    sent = F.array(*[
        F.struct((F.col("row") + r).alias("row"), (F.col("col") + c).alias("col"), (weight("row", r, "rows") * weight("col", c, "cols")).alias("w"), F.lit((r, c) == (0, 0)).alias("own"))
        for r, c in OFFSETS
    ])
    out = cells.where(F.col(value).isNotNull()).select("tile", "rows", "cols", F.col(value).alias("v"), F.explode(sent).alias("s")).select("tile", "rows", "cols", "v", "s.*")
    out = out.where("row >= 0 and col >= 0 and row < rows and col < cols").groupBy("tile", "rows", "cols", "row", "col")
    total = out.agg(F.max(F.when(F.col("own"), F.col("v"))).alias("own"), F.sum(F.col("v") * F.col("w")).alias("s"), F.sum("w").alias("w"))
    return total.select("tile", "rows", "cols", "row", "col", F.coalesce("own", F.col("s") / F.col("w")).alias(value))


def fill_gaps(cells: DataFrame, value: str, rounds: int = 5, block: int = 512) -> DataFrame:
    """``rounds`` simultaneous rounds of :func:`fill_round`, then :func:`fill_nearest`; all cells of a tile with any data have a value.

    Cells are dealt to blocks once, with as many cells around each as there are rounds, and all rounds
    are made there.
    """
    import json

    kinds = {f.name: f.dataType.simpleString() for f in cells.schema}
    out = f"tile {kinds['tile']}, rows {kinds['rows']}, cols {kinds['cols']}, row {kinds['row']}, col {kinds['col']}, {value} double"
    present = cells.where(F.col(value).isNotNull()).withColumn("size", F.to_json(F.struct("rows", "cols")))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        _, size, brow, bcol = key
        rows, cols = (json.loads(size)[k] for k in ("rows", "cols"))
        top, left = max(0, brow * block - rounds), max(0, bcol * block - rounds)
        grid = np.full((min(rows, (brow + 1) * block + rounds) - top, min(cols, (bcol + 1) * block + rounds) - left), np.nan)
        grid[part["row"] - top, part["col"] - left] = part[value].astype(float)
        grid = grow(grid, rounds)
        r, c = np.nonzero(~np.isnan(grid))
        own = ((r + top) // block == brow) & ((c + left) // block == bcol)
        r, c = r[own], c[own]
        return pd.DataFrame({"tile": key[0], "rows": rows, "cols": cols, "row": r + top, "col": c + left, value: grid[r, c]})

    dealt = halo_blocks(present, value, block, rounds, "size").where(F.col("brow") >= 0).where(F.col("bcol") >= 0)
    filled = dealt.groupBy("tile", "size", "brow", "bcol").applyInPandas(run, out)
    return fill_nearest(filled, value)


def grow(grid: np.ndarray, rounds: int) -> np.ndarray:
    """Rounds in which each empty cell with a neighbour becomes the mean of its 3 x 3 window; the edge repeats beyond the border."""
    for _ in range(rounds):
        empty = np.isnan(grid)
        if not empty.any():
            break
        padded = np.pad(grid, 1, mode="edge")
        full = ~np.isnan(padded)
        padded[~full] = 0
        h, w = grid.shape
        shifts = [(slice(r, r + h), slice(c, c + w)) for r in range(3) for c in range(3)]
        total, count = sum(padded[x] for x in shifts), sum(full[x].astype(int) for x in shifts)
        grid = np.where(empty & (count > 0), total / np.maximum(count, 1), grid)
    return grid


#: Columns of a tile that :func:`fill_nearest` looks up and down together.
STRIP = 64


def fill_nearest(cells: DataFrame, value: str) -> DataFrame:
    """What :func:`nearest` does to a whole grid, in rows and then in strips of columns of it.

    In each row every column gets the row's nearest cell with data; in each column every row then
    takes the nearest of those.  Columns: tile, rows, cols, row, col, value.
    """
    schema = cells.where(F.col(value).isNotNull()).select("tile", "rows", "cols", "row", "col", F.col(value).cast("double").alias(value))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.schema)

    def along(part: pd.DataFrame) -> pd.DataFrame:
        part, first = part.sort_values("col"), part.iloc[0]
        have, cols = part["col"].to_numpy(), np.arange(int(first["cols"]))
        take = _nearest_in_row(have, len(cols))
        return pd.DataFrame({"tile": first["tile"], "rows": first["rows"], "cols": first["cols"], "row": first["row"], "col": cols, value: part[value].to_numpy()[take], "away": np.abs(cols - have[take])})

    def across(part: pd.DataFrame) -> pd.DataFrame:
        first, n = part.iloc[0], int(part["rows"].iloc[0])
        have, at = np.unique(part["row"], return_inverse=True)
        left, width = int(part["col"].min()), int(part["col"].max() - part["col"].min()) + 1
        away, own = np.empty((len(have), width), dtype=np.int64), np.empty((len(have), width))
        away[at, part["col"] - left], own[at, part["col"] - left] = part["away"] ** 2, part[value]
        source = _lowest(away, have, n)
        r, c = (x.ravel() for x in np.indices((n, width)))
        return pd.DataFrame({"tile": first["tile"], "rows": n, "cols": first["cols"], "row": r, "col": c + left, value: own[source[r, c], c]})

    wide = schema.groupBy("tile", "row").applyInPandas(along, f"{kinds}, away long").withColumn("strip", F.expr(f"col div {STRIP}"))
    return wide.groupBy("tile", "strip").applyInPandas(lambda part: across(part), kinds)


def _nearest_in_row(have: np.ndarray, n: int) -> np.ndarray:
    """For each of n places the number of the nearest of the ascending places that have data, the smaller of two equally near."""
    places = np.arange(n)
    at = np.searchsorted(have, places)
    left, right = np.maximum(at - 1, 0), np.minimum(at, len(have) - 1)
    return np.where(np.abs(places - have[left]) <= np.abs(have[right] - places), left, right)


def _lowest(height: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """For each of n rows and each column the number k for which height[k] + (row - rows[k])**2 is least, the smallest of equal ones.

    The least of parabolas is kept as a stack for each column: which ones show, and from which row on.
    A later one shows from the first row in which it is strictly less, and hides those that would show
    later still.  Every parabola is pushed and popped once, so the work goes by the cells.
    """
    k_rows, width = height.shape
    columns = np.arange(width)
    lifted = height + (rows.astype(np.int64) ** 2)[:, None]
    stack, since = np.zeros((k_rows, width), dtype=np.int64), np.zeros((k_rows, width), dtype=np.int64)
    top = np.full(width, -1)

    def shows(k: int, over: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (lifted[k, at] - lifted[over, at]) // (2 * (rows[k] - rows[over])) + 1

    for k in range(k_rows):
        first, left = np.zeros(width, dtype=np.int64), columns if k else columns[:0]
        while len(left):
            start = shows(k, stack[top[left], left], left)
            hidden = start <= since[top[left], left]
            first[left[~hidden]] = start[~hidden]
            top[left[hidden]] -= 1
            left = left[hidden]
            first[left[top[left] < 0]] = 0
            left = left[top[left] >= 0]
        top += 1
        stack[top, columns], since[top, columns] = k, np.maximum(first, 0)
    out, at = np.empty((n, width), dtype=np.int64), np.zeros(width, dtype=np.int64)
    for r in range(n):
        left = columns
        while len(left):
            more = left[(at[left] < top[left])]
            left = more[since[at[more] + 1, more] <= r]
            at[left] += 1
        out[r] = stack[at, columns]
    return out


def dilate(cells: DataFrame, rounds: int = 1) -> DataFrame:
    """A mask's cells and their four neighbours, ``rounds`` times, inside the grid."""
    steps = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((0, 0), (0, 1), (1, 0), (0, -1), (-1, 0))])
    for _ in range(rounds):
        cells = cells.select("tile", "rows", "cols", "row", "col", F.explode(steps).alias("s")).select("tile", "rows", "cols", (F.col("row") + F.col("s.r")).alias("row"), (F.col("col") + F.col("s.c")).alias("col"))
        cells = cells.where("row >= 0 and col >= 0 and row < rows and col < cols").distinct()
    return cells


def gradients(cells: DataFrame, value: str, res: float = 1.0) -> DataFrame:
    """``gx`` and ``gy`` of a full grid: central differences, one-sided at the borders."""
    out = cells
    for name, along, across in (("gx", "col", "row"), ("gy", "row", "col")):
        order = Window.partitionBy("tile", across).orderBy(along)
        ahead, behind, own = F.lead(value).over(order), F.lag(value).over(order), F.col(value)
        slope = F.when(ahead.isNotNull() & behind.isNotNull(), (ahead - behind) / (2 * res)).when(ahead.isNotNull(), (ahead - own) / res).when(behind.isNotNull(), (own - behind) / res).otherwise(0.0)
        out = out.withColumn(name, slope)
    return out


def hillshade(cells: DataFrame, value: str, res: float = 1.0, azimuth: float = 315.0, altitude: float = 45.0) -> DataFrame:
    """Adds ``shade`` from 0 to 1."""
    sun, height = np.radians(360.0 - azimuth + 90.0), np.radians(altitude)
    shaded = gradients(cells, value, res)
    slope = F.atan(F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")))
    aspect = F.atan2(-F.col("gx"), F.col("gy"))
    light = F.lit(float(np.sin(height))) * F.cos(slope) + F.lit(float(np.cos(height))) * F.sin(slope) * F.cos(F.lit(float(sun)) - aspect)
    return shaded.withColumn("shade", F.greatest(F.least(light, F.lit(1.0)), F.lit(0.0)))


def nearest(grid: np.ndarray) -> np.ndarray:
    """Empty cells take the nearest cell with data; of equally near ones the smallest row, then column.  All empty: stays empty.

    An exact distance transform in two passes, first along rows and then along columns.
    """
    full = ~np.isnan(grid)
    if not full.any() or full.all():
        return grid
    rows = np.flatnonzero(full.any(axis=1))
    columns = np.arange(grid.shape[1])
    near = np.empty((len(rows), len(columns)), dtype=np.int64)
    for k, r in enumerate(rows):
        have = np.flatnonzero(full[r])
        near[k] = have[_nearest_in_row(have, len(columns))]
    source = _lowest((near - columns) ** 2, rows, len(grid))
    return grid[rows[source], near[source, columns]]


def kernel(sigma: float) -> np.ndarray:
    """Weights of a Gaussian up to four sigmas."""
    radius = int(4 * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return weights / weights.sum()


def gaussian(grid: np.ndarray, sigma: float) -> np.ndarray:
    """Separable smoothing; the kernel ends at four sigmas and the border is mirrored."""
    weights = kernel(sigma)
    radius = len(weights) // 2
    for axis in (0, 1):
        n = grid.shape[axis]
        around = np.arange(-radius, n + radius) % (2 * n)
        padded = np.take(grid, np.where(around < n, around, 2 * n - 1 - around), axis=axis)
        grid = sum(k * np.take(padded, np.arange(i, i + n), axis=axis) for i, k in enumerate(weights))
    return grid


def relief(grid: np.ndarray, sigma: float = 50.0, limit: float = 3.0) -> np.ndarray:
    """Local relief as bytes: the surface less its smoothed self; 128 is level, and empty cells are 128."""
    empty = np.isnan(grid)
    if empty.all():
        return np.full(grid.shape, 128, dtype=np.uint8)
    filled = nearest(grid)
    scaled = np.rint((np.clip((filled - gaussian(filled, sigma)) / limit, -1, 1) + 1) * 127.5).astype(np.uint8)
    scaled[empty] = 128
    return scaled


def map_blocks(blocks: DataFrame, made, schema: str, height: int, width: int) -> DataFrame:
    """Applies a function of numpy arrays to each row's block (``id``, ``data`` array of height * width, nulls empty), batch by batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grids = [np.array([np.nan if v is None else v for v in d], dtype=np.float64).reshape(height, width) for d in batch["data"]]
            yield pd.DataFrame({"id": batch["id"], "data": [made(g).ravel().tolist() for g in grids]})

    return blocks.select("id", "data").mapInPandas(run, schema)


def halo_blocks(cells: DataFrame, value: str, block: int, halo: int, *others: str) -> DataFrame:
    """Cells dealt to every block whose halo they lie in: ``tile``, ``brow``, ``bcol``, ``row``, ``col``, value, ``inside`` and other columns."""
    span = lambda c: F.sequence(F.floor((F.col(c) - halo) / block).cast("int"), F.floor((F.col(c) + halo) / block).cast("int"))
    dealt = cells.withColumn("brow", F.explode(span("row"))).withColumn("bcol", F.explode(span("col")))
    inside = (F.col("brow") == F.floor(F.col("row") / block)) & (F.col("bcol") == F.floor(F.col("col") / block))
    return dealt.select("tile", "brow", "bcol", "row", "col", F.col(value).alias(value), inside.alias("inside"), *others)


def relief_blocks(cells: DataFrame, value: str, sigma: float, limit: float = 3.0, block: int = 4096) -> DataFrame:
    """Local relief of a large grid in blocks with a halo of four sigmas: ``tile``, ``row``, ``col``, ``relief``."""
    halo = int(4 * sigma + 0.5)

    def run(key, part: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = part["row"].min(), part["col"].min()
        grid = np.full((part["row"].max() - r0 + 1, part["col"].max() - c0 + 1), np.nan)
        grid[part["row"] - r0, part["col"] - c0] = part[value].astype(float)
        own = part[part["inside"]]
        return pd.DataFrame({"tile": own["tile"], "row": own["row"], "col": own["col"], "relief": relief(grid, sigma, limit)[own["row"] - r0, own["col"] - c0].astype("int32")})

    return halo_blocks(cells, value, block, halo).groupBy("tile", "brow", "bcol").applyInPandas(run, "tile string, row int, col int, relief int")
