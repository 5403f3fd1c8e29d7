"""All named queries of the terrain and trail engine with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.functions import encode, geo, style, text, tiles
from ridgeline.operators import features, focal, grid, spatial, tiling, trails
from ridgeline.plans import standins as S
from ridgeline.sources import archive, files, vector_tiles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _r(c, digits: int = 6):
    return F.round(c, digits)


# Grids


@query(f"WITH {S.POINTS} SELECT tile, row, col, round(dtm, 6) AS dtm FROM cells WHERE dtm IS NOT NULL")
def grid_dtm_mean(spark, d):
    return grid.surfaces(S.points(spark, d)).where("dtm is not null").select("tile", "row", "col", _r(F.col("dtm")).alias("dtm"))


@query(f"WITH {S.POINTS} SELECT tile, row, col, dsm FROM cells")
def grid_dsm_max(spark, d):
    return grid.surfaces(S.points(spark, d)).select("tile", "row", "col", "dsm")


@query(f"WITH {S.POINTS} SELECT tile, row, col, round(density, 6) AS density, water FROM cells")
def grid_density(spark, d):
    return grid.surfaces(S.points(spark, d)).select("tile", "row", "col", _r(F.col("density")).alias("density"), "water")


@query(f"WITH {S.POINTS} SELECT tile, row, col, round(CASE WHEN dtm IS NULL THEN NULL WHEN greatest(dsm - dtm, 0) < 0.5 THEN 0 ELSE greatest(dsm - dtm, 0) END, 6)::DOUBLE AS chm FROM cells")
def grid_chm(spark, d):
    cells = grid.surfaces(S.points(spark, d))
    return cells.select("tile", "row", "col", _r(grid.canopy(F.col("dsm"), F.col("dtm"))).alias("chm"))


#: Means of few whole numbers often end right between two roundings, where the last bit of a sum decides; off by this they don't.
_OFF = 0.00017
_WINDOW = "(SELECT a AS dr, b AS dc FROM range(-1, 2) x(a), range(-1, 2) y(b))"


def _filled(value: str, rounds: int = 5) -> str:
    """Tables up to ``filled`` (tile, row, col, v): rounds of window means, then the nearest cell with data."""
    steps = [f"""r0 AS MATERIALIZED (SELECT g.tile, g.rows, g.cols, g.row, g.col, {value} AS v FROM (
  SELECT tile, rows, cols, unnest(range(rows))::INT AS row, col FROM (SELECT DISTINCT tile, rows, cols, unnest(range(cols))::INT AS col FROM cells)) g LEFT JOIN cells USING (tile, row, col))"""]
    for k in range(1, rounds + 1):
        steps.append(f"""n{k} AS MATERIALIZED (SELECT c.*, least(greatest(c.row + o.dr, 0), c.rows - 1)::INT AS nrow, least(greatest(c.col + o.dc, 0), c.cols - 1)::INT AS ncol FROM r{k - 1} c, {_WINDOW} o),
r{k} AS MATERIALIZED (SELECT c.tile, c.rows, c.cols, c.row, c.col, coalesce(max(c.v), avg(n.v)) AS v FROM n{k} c JOIN r{k - 1} n ON n.tile = c.tile AND n.row = c.nrow AND n.col = c.ncol GROUP BY ALL)""")
    # The nearest cell of each row for every column first, then the nearest of those for every row.
    steps.append(f"""rowwise AS MATERIALIZED (
  SELECT tile, row, col, CASE WHEN before IS NULL THEN after WHEN after IS NULL OR col - before.c <= after.c - col THEN before ELSE after END AS pick FROM (
    SELECT tile, row, col, last_value(CASE WHEN v IS NOT NULL THEN {{'c': col, 'v': v}} END IGNORE NULLS) OVER (PARTITION BY tile, row ORDER BY col ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before,
      first_value(CASE WHEN v IS NOT NULL THEN {{'c': col, 'v': v}} END IGNORE NULLS) OVER (PARTITION BY tile, row ORDER BY col ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after FROM r{rounds})),
filled AS (SELECT a.tile, a.row, a.col, min_by(b.pick.v, {{'d': (b.row - a.row) ** 2 + (b.pick.c - a.col) ** 2, 'r': b.row}}) AS v
  FROM r{rounds} a JOIN rowwise b ON b.tile = a.tile AND b.col = a.col AND b.pick IS NOT NULL GROUP BY a.tile, a.row, a.col)""")
    return ", ".join(steps)


@query(f"WITH {S.POINTS}, {_filled('dsm - dtm')} SELECT tile, row, col, round(CASE WHEN v < 0.5 THEN 0 ELSE v END - {_OFF}, 3)::DOUBLE + 0.0::DOUBLE AS chm FROM filled")
def grid_chm_filled(spark, d):
    cells = grid.surfaces(S.points(spark, d)).select("tile", "rows", "cols", "row", "col", "dsm", "dtm")
    return grid.filled_canopy(cells).select("tile", "row", "col", (_r(F.col("chm") - _OFF, 3) + 0.0).alias("chm"))


@query(f"WITH {S.POINTS} SELECT tile, cols, rows, count(*)::BIGINT AS cells, count(dtm)::BIGINT AS ground, bool_and(dtm IS NOT NULL) AS whole FROM cells GROUP BY ALL")
def grid_states(spark, d):
    cells = grid.surfaces(S.points(spark, d))
    return cells.groupBy("tile", "cols", "rows").agg(F.count("*").alias("cells"), F.count("dtm").alias("ground"), F.bool_and(F.col("dtm").isNotNull()).alias("whole"))


@query(f"WITH {S.POINTS} SELECT tile, (row // 4)::INT AS row, (col // 4)::INT AS col, round(avg(dsm), 4) AS dsm FROM cells GROUP BY ALL")
def grid_overview(spark, d):
    return grid.overview(grid.surfaces(S.points(spark, d)), 4, "dsm").withColumn("dsm", _r(F.col("dsm"), 4))


@query(f"WITH {S.POINTS} " + " UNION ALL ".join(f"SELECT {f} AS factor, tile, (row // {f})::INT AS row, (col // {f})::INT AS col, round(avg(dsm), 4) AS dsm FROM cells GROUP BY ALL" for f in (2, 4, 8, 16, 32, 64, 128, 256)))
def grid_pyramid(spark, d):
    return grid.pyramid(grid.surfaces(S.points(spark, d)), "dsm").withColumn("dsm", _r(F.col("dsm"), 4))


@query(f"WITH {S.POINTS} SELECT row, col, max_by(tile, tile) AS tile, max_by(dsm, tile) AS dsm FROM cells GROUP BY ALL")
def grid_mosaic(spark, d):
    cells = grid.surfaces(S.points(spark, d)).select("tile", "row", "col", "dsm")
    return grid.mosaic(*[cells.where(F.col("tile") == t) for t in ("A", "N", "R")]).select("row", "col", "tile", "dsm")


_NEAR = "(SELECT unnest([0, 0, 1, 0, -1]) AS dr, unnest([0, 1, 0, -1, 0]) AS dc)"


@query(f"""WITH {S.POINTS}, one AS (SELECT DISTINCT tile, rows, cols, row + dr AS row, col + dc AS col FROM cells, {_NEAR} WHERE water AND row + dr BETWEEN 0 AND rows - 1 AND col + dc BETWEEN 0 AND cols - 1)
SELECT DISTINCT tile, (row + dr)::INT AS row, (col + dc)::INT AS col FROM one, {_NEAR} WHERE row + dr BETWEEN 0 AND rows - 1 AND col + dc BETWEEN 0 AND cols - 1""")
def water_mask_dilate(spark, d):
    cells = grid.surfaces(S.points(spark, d)).where("water").select("tile", "rows", "cols", "row", "col")
    return focal.dilate(cells, 2).select("tile", "row", "col")


_OFFSETS = "(SELECT a AS dr, b AS dc FROM range(-1, 2) x(a), range(-1, 2) y(b))"


@query(f"""WITH {S.BLOCKS}, near AS (SELECT c.tile, c.row, c.col, c.v AS own, n.v FROM bl c, {_OFFSETS} o
  JOIN bl n ON n.tile = c.tile AND n.row = least(greatest(c.row + o.dr, 0), 7) AND n.col = least(greatest(c.col + o.dc, 0), 7))
SELECT tile, row, col, round(coalesce(max(own), avg(v)), 6) AS v FROM near GROUP BY tile, row, col HAVING coalesce(max(own), avg(v)) IS NOT NULL""")
def focal_fill_once(spark, d):
    return focal.fill_round(S.block_cells(spark, d), "v").select("tile", "row", "col", _r(F.col("v")).alias("v"))


@query(f"WITH {S.POINTS}, {_filled('dtm')} SELECT tile, row, col, round(v - {_OFF}, 3) AS dtm FROM filled")
def focal_fill_five(spark, d):
    cells = grid.surfaces(S.points(spark, d)).select("tile", "rows", "cols", "row", "col", "dtm")
    return focal.fill_gaps(cells, "dtm").select("tile", "row", "col", _r(F.col("dtm") - _OFF, 3).alias("dtm"))


@query(f"""WITH {S.BLOCKS}, pairs AS (SELECT c.tile, c.row, c.col, n.v, row_number() OVER (PARTITION BY c.tile, c.row, c.col ORDER BY (n.row - c.row) ** 2 + (n.col - c.col) ** 2, n.row, n.col) AS k
  FROM bl c JOIN bl n ON n.tile = c.tile AND n.v IS NOT NULL)
SELECT tile, row, col, v FROM pairs WHERE k = 1""")
def nearest_fill(spark, d):
    filled = focal.map_blocks(S.blocks(spark, d), focal.nearest, "id long, data array<double>", 8, 8)
    return filled.select(F.col("id").alias("tile"), F.posexplode("data").alias("pos", "v")).selectExpr("tile", "cast(pos div 8 AS int) AS row", "cast(pos % 8 AS int) AS col", "v")


def _relief_sql() -> str:
    """Relief of the 8 x 8 blocks: nearest fill, times ten, less a Gaussian of one cell with a mirrored border."""
    kernel = focal.kernel(1.0)
    weights = ", ".join(f"({k - 4}, {w!r}::DOUBLE)" for k, w in enumerate(kernel.tolist()))
    mirrored = lambda c: f"CASE WHEN ({c} + 16) % 16 < 8 THEN ({c} + 16) % 16 ELSE 15 - ({c} + 16) % 16 END"
    return f"""WITH {S.BLOCKS}, weights(k, w) AS (VALUES {weights}),
pairs AS (SELECT c.tile, c.row, c.col, n.v, row_number() OVER (PARTITION BY c.tile, c.row, c.col ORDER BY (n.row - c.row) ** 2 + (n.col - c.col) ** 2, n.row, n.col) AS k
  FROM bl c JOIN bl n ON n.tile = c.tile AND n.v IS NOT NULL),
whole AS MATERIALIZED (SELECT tile, row, col, v * 10 AS v FROM pairs WHERE k = 1),
down AS MATERIALIZED (SELECT a.tile, a.row, a.col, sum(w * b.v) AS v FROM whole a, weights JOIN whole b ON b.tile = a.tile AND b.col = a.col AND b.row = {mirrored('a.row + k')} GROUP BY ALL),
smooth AS (SELECT a.tile, a.row, a.col, sum(w * b.v) AS v FROM down a, weights JOIN down b ON b.tile = a.tile AND b.row = a.row AND b.col = {mirrored('a.col + k')} GROUP BY ALL)
SELECT tile, (row * 8 + col)::INT AS pos, CASE WHEN bl.v IS NULL THEN 128 ELSE round_even((greatest(least((whole.v - smooth.v) / 3, 1), -1) + 1) * 127.5::DOUBLE, 0)::INT END AS relief
FROM bl JOIN whole USING (tile, row, col) JOIN smooth USING (tile, row, col)"""


@query(_relief_sql())
def lrm_u8(spark, d):
    made = focal.map_blocks(S.blocks(spark, d), lambda g: focal.relief(g * 10, 1.0, 3.0).astype(int), "id long, data array<int>", 8, 8)
    return made.select(F.col("id").alias("tile"), F.posexplode("data").alias("pos", "relief"))


@query(f"""WITH full_b AS (SELECT vec_id AS tile, (i // 8)::INT AS row, (i % 8)::INT AS col, embedding[i + 1]::DOUBLE AS v FROM embeddings, range(64) r(i)),
g AS (SELECT tile, row, col,
  CASE WHEN lag(v) OVER x IS NULL THEN lead(v) OVER x - v WHEN lead(v) OVER x IS NULL THEN v - lag(v) OVER x ELSE (lead(v) OVER x - lag(v) OVER x) / 2 END AS gx,
  CASE WHEN lag(v) OVER y IS NULL THEN lead(v) OVER y - v WHEN lead(v) OVER y IS NULL THEN v - lag(v) OVER y ELSE (lead(v) OVER y - lag(v) OVER y) / 2 END AS gy
  FROM full_b WINDOW x AS (PARTITION BY tile, row ORDER BY col), y AS (PARTITION BY tile, col ORDER BY row))
SELECT tile, row, col, round(gx, 6) AS gx, round(gy, 6) AS gy,
  round(greatest(least(sin(radians(45)) * cos(atan(sqrt(gx * gx + gy * gy))) + cos(radians(45)) * sin(atan(sqrt(gx * gx + gy * gy))) * cos(radians(135) - atan2(-gx, gy)), 1), 0), 5) AS shade FROM g""")
def gradient_hillshade(spark, d):
    cells = S.blocks(spark, d, gaps=False).select("id", F.posexplode("data").alias("pos", "v")).selectExpr("id AS tile", "cast(pos div 8 AS int) AS row", "cast(pos % 8 AS int) AS col", "v")
    return focal.hillshade(cells, "v").select("tile", "row", "col", _r(F.col("gx")).alias("gx"), _r(F.col("gy")).alias("gy"), _r(F.col("shade"), 5).alias("shade"))


# Encodings


@query("""SELECT o_orderkey AS id, (c >> 16)::INT AS r, ((c >> 8) & 255)::INT AS g, (c & 255)::INT AS b FROM (
  SELECT o_orderkey, greatest(least(round_even((((o_totalprice / 100)::FLOAT + 10000::FLOAT)::FLOAT / 0.1::FLOAT)::FLOAT::DOUBLE, 0), 16777215), 0)::BIGINT AS c FROM orders)""")
def terrain_rgb(spark, d):
    made = encode.terrain_rgb(F.col("o_totalprice") / 100)
    return S.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), *[v.alias(k) for k, v in made.items()])


@query("""SELECT p_partkey AS id, greatest(least(round_even((((p_size::FLOAT / 35::FLOAT)::FLOAT * 255::FLOAT)::FLOAT)::DOUBLE, 0), 255), 0)::INT AS canopy,
  greatest(least(round_even(((p_size * 2)::FLOAT * 2.55::FLOAT)::FLOAT::DOUBLE, 0), 255), 0)::INT AS wetness,
  round_even((greatest(least((p_size - 25) / 10.0::DOUBLE / 3.0::DOUBLE, 1), -1) + 1) * 127.5::DOUBLE, 0)::INT AS relief FROM part""")
def chm_wet_u8(spark, d):
    return S.table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), encode.canopy_byte(F.col("p_size")).alias("canopy"), encode.wetness_byte(F.col("p_size") * 2).alias("wetness"), encode.relief_byte((F.col("p_size") - 25) / 10.0).alias("relief"))


# Tiles

_TX = "trunc((lon + 180) / 360 * pow(2, {z}))::INT"
_TY = "trunc((1 - ln(tan(radians({lat})) + 1 / cos(radians({lat}))) / pi()) / 2 * pow(2, {z}))::INT"


@query(f"SELECT id, {_TX.format(z=14)} AS x, {_TY.format(lat='lat', z=14)} AS y, ((1 << 14) - 1 - {_TY.format(lat='lat', z=14)})::INT AS tms FROM {S.place_sql('customer', 'c_custkey')}")
def tile_of_point(spark, d):
    z = F.lit(14)
    y = tiles.lat_to_y(F.col("lat"), z)
    return S.places(spark, d, "customer", "c_custkey").select("id", tiles.lon_to_x(F.col("lon"), z).alias("x"), y.alias("y"), tiles.tms_row(y, z).cast("int").alias("tms"))


_COVER = f"""boxes AS (SELECT id, lon, lat FROM {S.place_sql('supplier', 's_suppkey')}),
ranges AS (SELECT id, {_TX.format(z=11)} AS x0, trunc((lon + 0.3 + 180) / 360 * pow(2, 11))::INT AS x1, {_TY.format(lat='(lat + 0.2)', z=11)} AS y0, {_TY.format(lat='lat', z=11)} AS y1 FROM boxes),
covered AS (SELECT id, 11 AS z, x::INT AS x, y::INT AS y FROM ranges, range(x0, x1 + 1) a(x), range(y0, y1 + 1) b(y))"""


def _cover(spark, d):
    boxes = S.places(spark, d, "supplier", "s_suppkey").selectExpr("id", "11 AS z", "lon AS west", "lat AS south", "lon + 0.3D AS east", "lat + 0.2D AS north")
    return tiles.cover(boxes).select("id", "z", "x", "y")


@query(f"WITH {_COVER} SELECT * FROM covered")
def tile_cover(spark, d):
    return _cover(spark, d)


@query(f"""WITH {_COVER} SELECT id, x, y, round(x * (40075016.6855784 / 2048) - 20037508.3427892, 4) AS west, round(20037508.3427892 - (y + 1) * (40075016.6855784 / 2048), 4) AS south FROM covered""")
def tile_bounds(spark, d):
    at = tiles.bounds(F.col("x"), F.col("y"), F.col("z"))
    return _cover(spark, d).select("id", "x", "y", _r(at["west"], 4).alias("west"), _r(at["south"], 4).alias("south"))


@query(f"""WITH {_COVER}, n AS (SELECT DISTINCT z, y, x FROM covered), k AS (SELECT *, ((row_number() OVER (PARTITION BY z, y ORDER BY x) - 1) // 4)::INT AS strip FROM n)
SELECT z, y, strip, count(*)::INT AS n, min(x) AS first, max(x) AS last FROM k GROUP BY ALL""")
def strip_chunks(spark, d):
    made = tiles.strips(_cover(spark, d), 4)
    return made.select("z", "y", "strip", F.size("columns").alias("n"), F.array_min("columns").alias("first"), F.array_max("columns").alias("last"))


@query(f"WITH {_COVER} SELECT DISTINCT x, y FROM covered WHERE NOT ((x + y) % 3 = 0 AND x % 2 = 1)")
def tiles_todo(spark, d):
    work = _cover(spark, d).select("x", "y").distinct()
    done = work.where("(x + y) % 3 = 0").withColumn("size", F.expr("x % 2"))
    return tiling.remaining(work, done, "x", "y")


@query(f"""WITH {_COVER}, s AS (SELECT DISTINCT z, x, y FROM covered) SELECT z, count(*) FILTER ((x + y) % 2 = 0)::BIGINT AS written, count(*) FILTER ((x + y) % 2 = 1)::BIGINT AS present, count(*)::BIGINT AS tiles FROM s GROUP BY ROLLUP (z)""")
def tile_totals(spark, d):
    states = _cover(spark, d).select("z", "x", "y").distinct().withColumn("state", F.when((F.col("x") + F.col("y")) % 2 == 0, "written").otherwise("present"))
    return tiling.totals(states)


@query(f"""SELECT max(lon) AS west, max(lat) AS south, min(lon + 6) AS east, min(lat + 3) AS north FROM {S.place_sql('supplier', 's_suppkey')} HAVING max(lon) < min(lon + 6) AND max(lat) < min(lat + 3)""")
def extent_intersection(spark, d):
    return tiling.common_extent(S.places(spark, d, "supplier", "s_suppkey").selectExpr("lon AS west", "lat AS south", "lon + 6 AS east", "lat + 3 AS north"))


@query("""SELECT z::INT AS z, x::INT AS x, y::INT AS y, e AS empty FROM (SELECT DISTINCT 11 AS z, o_orderkey % 50 AS x, o_custkey % 40 AS y, o_orderkey % 2 = 0 AS e FROM orders)""")
def tile_paths(spark, d):
    paths = S.table(spark, d, "orders").selectExpr("concat('/t/11/', o_orderkey % 50, '/', o_custkey % 40, CASE WHEN o_orderkey % 2 = 0 THEN '.empty' ELSE '.png' END) AS path").distinct()
    return tiling.parsed_paths(paths.union(spark.createDataFrame([("/t/x/1/2.png",), ("/t/a.txt",)], "path string"))).drop("path")


@query(f"""WITH {S.BLOCKS}, a AS (SELECT tile AS z, row AS x, col AS y, v * 100 AS v FROM bl WHERE v IS NOT NULL), b AS (SELECT tile AS z, row AS x, col AS y, abs(v) * 100 AS v FROM bl WHERE (row + col) % 3 = 0 AND v IS NOT NULL)
SELECT coalesce(a.z, b.z) AS z, coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y, 0 AS r, 0 AS g,
  coalesce(greatest(least(round_even((((a.v::FLOAT / 35::FLOAT)::FLOAT * 255::FLOAT)::FLOAT)::DOUBLE, 0), 255), 0)::INT, 0) AS b,
  coalesce(greatest(least(round_even((b.v::FLOAT * 2.55::FLOAT)::FLOAT::DOUBLE, 0), 255), 0)::INT, 0) AS a
FROM a FULL JOIN b ON a.z = b.z AND a.x = b.x AND a.y = b.y""")
def overlay_stack(spark, d):
    cells = S.block_cells(spark, d).where("v is not null").selectExpr("tile AS z", "row AS x", "col AS y", "0 AS px", "v * 100 AS v")
    made = encode.overlay_channels(F.col("canopy"), F.col("wetness"))
    both = tiling.stacked(cells, cells.where("(x + y) % 3 = 0").withColumn("v", F.abs("v")))
    return both.select("z", "x", "y", *[v.alias(k) for k, v in made.items()])


# Features


@query(f"WITH {S.ROUTES} SELECT way_id, route_type, route_name, route_relation_id, memberships FROM best")
def route_priority(spark, d):
    return features.best_routes(S.relations(spark, d), S.members(spark, d))


@query(f"WITH {S.ROUTES} SELECT p_partkey AS way_id, route_type, route_name, route_relation_id FROM part LEFT JOIN best ON p_partkey = way_id")
def way_route_left(spark, d):
    return features.with_routes(S.ways(spark, d).select("way_id"), features.best_routes(S.relations(spark, d), S.members(spark, d)))


@query(f"""WITH refs AS (SELECT o_orderkey AS way_id, i AS pos, (o_orderkey * 7 + i * 13) % 1700 AS node_id FROM orders, range(5) r(i)),
n AS (SELECT * FROM {S.place_sql('customer', 'c_custkey')})
SELECT way_id, count(*)::INT AS n, round(sum(lon * (pos + 1)), 6) AS lon_sum, arg_min(lat, pos) AS first_lat, arg_max(lat, pos) AS last_lat FROM refs JOIN n ON id = node_id GROUP BY way_id HAVING count(*) >= 2""")
def way_geometry(spark, d):
    ways = S.table(spark, d, "orders").selectExpr("o_orderkey AS way_id", "transform(sequence(0, 4), i -> (o_orderkey * 7 + i * 13) % 1700) AS refs")
    nodes = S.places(spark, d, "customer", "c_custkey").withColumnRenamed("id", "node_id")
    lines = features.way_lines(ways, nodes)
    # The position of a point among those found differs from its place in refs; weigh by the place.
    weighed = ways.select("way_id", F.posexplode("refs").alias("pos", "node_id")).join(nodes, "node_id").groupBy("way_id").agg(_r(F.sum(F.col("lon") * (F.col("pos") + 1))).alias("lon_sum"))
    return lines.join(weighed, "way_id").select("way_id", F.size("geometry").alias("n"), "lon_sum", F.element_at("geometry", 1)["lat"].alias("first_lat"), F.element_at("geometry", -1)["lat"].alias("last_lat"))


def _in(column: str, values: list[str]) -> str:
    return f"\"{column}\" IN ({', '.join(repr(v) for v in values)})"


_LAYER = f"""CASE WHEN {_in('highway', features.ROADS)} THEN 'roads' WHEN {_in('highway', features.TRACKS)} THEN 'tracks' WHEN {_in('highway', features.PATHS)} THEN 'paths'
 WHEN waterway <> '' THEN 'waterways' WHEN {_in('railway', features.RAILS)} THEN 'railways' WHEN power = 'line' THEN 'powerlines' WHEN {_in('natural', features.NATURAL_LINES)} THEN 'natural_lines' END"""
_IS_LINE = f"(highway <> '' OR waterway <> '' OR railway <> '' OR power = 'line' OR {_in('natural', features.NATURAL_LINES)})"


@query(f"WITH {S.WAYS} SELECT way_id, {_LAYER} AS layer FROM ways WHERE {_IS_LINE} AND {_LAYER} IS NOT NULL")
def layer_cascade(spark, d):
    ways = S.ways(spark, d).where(features.is_line(F.col("tags")))
    return ways.select("way_id", features.line_layer(F.col("tags")).alias("layer")).where("layer is not null")


@query(f"WITH {S.WAYS} SELECT way_id, CASE WHEN {_in('natural', features.PEAKS)} THEN 'peaks' ELSE 'places' END AS layer FROM ways WHERE {_in('natural', features.PEAKS)} OR {_in('place', features.PLACES)}")
def point_layers(spark, d):
    return S.ways(spark, d).select("way_id", features.point_layer(F.col("tags")).alias("layer")).where("layer is not null")


@query(f"""WITH {S.WAYS} SELECT way_id, 'water' AS layer FROM ways WHERE {_in('natural', features.WATER_NATURAL)} OR {_in('landuse', features.WATER_LANDUSE)}
UNION ALL SELECT way_id, 'landuse' FROM ways WHERE {_in('landuse', features.LANDUSE)} OR {_in('natural', features.LANDCOVER)} UNION ALL SELECT way_id, 'buildings' FROM ways WHERE building <> ''""")
def layer_multilabel(spark, d):
    tags = F.col("tags")
    return S.ways(spark, d).select("way_id", F.explode(features.polygon_layers(features.tag(tags, "natural"), features.tag(tags, "landuse"), features.tag(tags, "building"))).alias("layer"))


@query(f"WITH {S.WAYS} SELECT {_LAYER} AS layer, count(*)::BIGINT AS n FROM ways WHERE {_LAYER} IS NOT NULL GROUP BY ROLLUP (1)")
def layer_rollup(spark, d):
    layered = S.ways(spark, d).select(features.line_layer(F.col("tags")).alias("layer")).where("layer is not null")
    return layered.rollup("layer").agg(F.count("*").alias("n"))


@query(f"WITH {S.WAYS} SELECT highway, waterway FROM ways WHERE {_in('highway', features.KEPT_HIGHWAYS)} OR {_in('waterway', features.KEPT_WATERWAYS)}")
def export_filter(spark, d):
    tags = F.col("tags")
    return features.kept_rows(S.ways(spark, d).select(*[features.tag(tags, k).alias(k) for k in ("highway", "waterway", "power")]))


@query("""WITH e AS (SELECT p_partkey AS id, i AS pos, CASE (p_partkey + i) % 4 WHEN 0 THEN 'A:b' WHEN 1 THEN 'a-b' WHEN 2 THEN 'A B' ELSE 'c' END AS key FROM part, range(4) r(i)),
k AS (SELECT *, lower(translate(key, ':- ', '___')) AS n, row_number() OVER (PARTITION BY id, lower(translate(key, ':- ', '___')) ORDER BY pos) - 1 AS nth FROM e)
SELECT id, pos::INT AS pos, key, CASE WHEN nth = 0 THEN n ELSE n || '_' || nth END AS plain FROM k""")
def tag_sanitize(spark, d):
    entries = S.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("pos"))
    keyed = entries.withColumn("key", F.expr("CASE (id + pos) % 4 WHEN 0 THEN 'A:b' WHEN 1 THEN 'a-b' WHEN 2 THEN 'A B' ELSE 'c' END"))
    return features.plain_keys(keyed, "id", "pos", "key")


@query("SELECT p_type AS value, count(*)::BIGINT AS n FROM part WHERE p_type IS NOT NULL GROUP BY 1")
def tag_value_counts(spark, d):
    return features.value_counts(S.table(spark, d, "part").select(F.col("p_type").alias("value")), "value")


@query(f"""SELECT id FROM {S.place_sql('customer', 'c_custkey')} WHERE lon BETWEEN 13 AND 15.5 AND lat BETWEEN 60 AND 61.25""")
def bbox_filter(spark, d):
    return S.places(spark, d, "customer", "c_custkey").where(features.in_box(F.col("lon"), F.col("lat"), (13.0, 60.0, 15.5, 61.25))).select("id")


_SPOT = "'[' || lon || ',' || lat || ']'"
_EAST = "'[' || (lon + 0.01::DOUBLE) || ',' || lat || ']'"
_NORTH = "'[' || lon || ',' || (lat + 0.01::DOUBLE) || ']'"


@query(f"""SELECT id, '{{"type":"Feature","geometry":' || CASE id % 3
    WHEN 0 THEN '{{"type":"Point","coordinates":' || {_SPOT} || '}}'
    WHEN 1 THEN '{{"type":"LineString","coordinates":[' || {_SPOT} || ',' || {_EAST} || ']}}'
    ELSE '{{"type":"Polygon","coordinates":[[' || {_SPOT} || ',' || {_EAST} || ',' || {_NORTH} || ',' || {_SPOT} || ']]}}' END
  || ',"properties":{{"name":"s' || id || '"}}}}' AS feature FROM {S.place_sql('supplier', 's_suppkey')}""")
def geojson_feature(spark, d):
    here, east, north = F.struct("lon", "lat"), F.struct((F.col("lon") + 0.01).alias("lon"), F.col("lat")), F.struct(F.col("lon"), (F.col("lat") + 0.01).alias("lat"))
    props = F.create_map(F.lit("name"), F.concat(F.lit("s"), F.col("id")), F.lit("none"), F.lit(None).cast("string"))
    shapes = (geo.point_geometry(here), geo.line_geometry(F.array(here, east)), geo.polygon_geometry(F.array(F.array(here, east, north, here))))
    made = [geo.feature_json(shape, props) for shape in shapes]
    return S.places(spark, d, "supplier", "s_suppkey").select("id", F.when(F.col("id") % 3 == 0, made[0]).when(F.col("id") % 3 == 1, made[1]).otherwise(made[2]).alias("feature"))


# Trails


@query("SELECT user_id AS trail_id, event_id AS id, event_type AS entry_type, props AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_status(spark, d):
    return trails.latest(S.history(spark, d), "trail_id").select("trail_id", "id", "entry_type", "value")


@query("SELECT c_custkey AS trail_id FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey AND event_type = 'error')")
def trails_without_status(spark, d):
    entries = S.history(spark, d).withColumn("entry_type", F.when(F.col("entry_type") == "error", "status").otherwise(F.col("entry_type")))
    return trails.without_status(S.table(spark, d, "customer").select(F.col("c_custkey").alias("trail_id")), entries)


@query("SELECT event_id AS id FROM events WHERE (event_type = 'click' AND event_id % 5 = 2) OR (event_type = 'view' AND event_id % 5 <> 2)")
def check_value_shapes(spark, d):
    kind = F.when(F.col("entry_type") == "click", "status").when(F.col("entry_type") == "view", "comment").otherwise("other")
    value = F.expr("""CASE id % 5 WHEN 0 THEN '{"status":"clear"}' WHEN 1 THEN '{"status":"overgrown"}' WHEN 2 THEN '{"status":"x","text":"t"}' ELSE '{}' END""")
    rows = S.history(spark, d).select("id", kind.alias("kind"), value.alias("value"))
    return trails.violations(rows, trails.value_rule(F.col("kind"), F.col("value"))).select("id")


@query("SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem WHERE l_linenumber <> 3 GROUP BY ALL HAVING count(*) > 1")
def unique_nulls_distinct(spark, d):
    rows = S.table(spark, d, "lineitem").select("l_orderkey", F.when(F.col("l_linenumber") != 3, F.col("l_linenumber")).alias("l_linenumber"))
    return trails.repeated_keys(rows, "l_orderkey", "l_linenumber")


@query("SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'F' OR (o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0))")
def check_osm_reference(spark, d):
    rows = S.table(spark, d, "orders").selectExpr("o_orderkey", "o_orderstatus = 'F' AS is_draft", "CASE WHEN o_orderkey % 3 <> 0 THEN 'way' END AS osm_type", "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS osm_id")
    return trails.violations(rows, trails.osm_reference_rule()).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)")
def foreign_key_orphans(spark, d):
    return trails.orphans(S.table(spark, d, "orders"), S.table(spark, d, "customer").where("c_custkey % 7 <> 0"), "o_custkey", "c_custkey").select("o_orderkey")


@query("SELECT event_id FROM events WHERE user_id % 4 <> 0")
def cascade_delete(spark, d):
    gone = S.table(spark, d, "customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("user_id"))
    events = S.table(spark, d, "events")
    return trails.cascade(events, gone.union(events.where("user_id % 4 = 0").select("user_id")).distinct(), "user_id").select("event_id")


@query("""SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN 'new2' ELSE 'old' END AS v FROM part""")
def upsert_last_wins(spark, d):
    old = S.table(spark, d, "part").selectExpr("p_partkey AS k", "'old' AS v", "0 AS version")
    new = old.where("k % 3 = 0").selectExpr("k", "explode(array('new1', 'new2')) AS v").withColumn("version", F.expr("cast(substr(v, 4) AS int)"))
    return trails.upsert(old, new, "k").select("k", "v")


@query("""SELECT p_partkey AS k, 'old' AS v FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'new' FROM part WHERE p_partkey % 2 = 1""")
def insert_if_absent(spark, d):
    new = S.table(spark, d, "part").selectExpr("p_partkey AS k", "'new' AS v")
    return trails.insert_absent(new.where("k % 2 = 0").withColumn("v", F.lit("old")), new, "k")


@query("SELECT user_id AS trail_id, event_id AS id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)::INT AS nth FROM events")
def history_recent_first(spark, d):
    return trails.recent_first(S.history(spark, d), "trail_id").select("trail_id", "id", "nth")


# Places

_HAVERSINE = "2 * 6371008.8 * asin(sqrt(least(pow(sin(radians(k.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(k.lat)) * pow(sin(radians(k.lon - p.lon) / 2), 2), 1)))"


@query(f"""SELECT p.id AS probe_id, k.id AS known_id, round({_HAVERSINE}, 3) AS metres FROM {S.place_sql('customer', 'c_custkey')} p, {S.place_sql('supplier', 's_suppkey')} k
WHERE {_HAVERSINE} <= 15000 QUALIFY row_number() OVER (PARTITION BY p.id ORDER BY {_HAVERSINE}, k.id) = 1""")
def nearest_within(spark, d):
    probes = S.places(spark, d, "customer", "c_custkey").withColumnRenamed("id", "probe_id")
    known = S.places(spark, d, "supplier", "s_suppkey").withColumnRenamed("id", "known_id")
    return spatial.nearest_within(probes, known, 15_000.0).withColumn("metres", _r(F.col("metres"), 3))


@query(f"""WITH {S.POINTS}, p AS (SELECT c_custkey AS id, c_custkey % 120 + 0.5 AS x, (c_custkey * 7) % 100 + 0.5 AS y, CASE WHEN c_custkey % 4 = 0 THEN '777' END AS ele FROM customer),
c AS (SELECT row, col, max_by(dsm, tile) AS dsm FROM cells GROUP BY ALL)
SELECT p.id, coalesce(p.ele, round_even(c.dsm, 0)::BIGINT::VARCHAR) AS ele FROM p LEFT JOIN c ON c.col = floor(p.x)::INT AND c.row = floor(100 - p.y)::INT""")
def peak_elevation(spark, d):
    peaks = S.table(spark, d, "customer").selectExpr("c_custkey AS id", "c_custkey % 120 + 0.5D AS x", "(c_custkey * 7) % 100 + 0.5D AS y", "CASE WHEN c_custkey % 4 = 0 THEN '777' ELSE '' END AS ele")
    return spatial.fill_elevation(peaks, _mosaic(spark, d), 0.0, 100.0, 1.0).select("id", "ele")


_MOSAIC = "mos AS MATERIALIZED (SELECT row, col, max_by(dsm, tile) AS v FROM cells GROUP BY ALL)"


def _mosaic(spark, d):
    cells = grid.surfaces(S.points(spark, d)).select("tile", "row", "col", F.col("dsm").alias("v"))
    return grid.mosaic(*[cells.where(F.col("tile") == t) for t in ("A", "N", "R")]).select("row", "col", "v")


def _between(keys: str, digits: int = 3) -> str:
    """Values between the four cell centres around (fx, fy) of ``asked``, by its keys."""
    return f"""corners AS (SELECT {keys}, (floor(fy) + j)::INT AS row, (floor(fx) + i)::INT AS col, abs(fx - floor(fx) - (1 - i)) * abs(fy - floor(fy) - (1 - j)) AS w
  FROM asked, range(2) a(i), range(2) b(j))
SELECT {keys}, round(sum(v * w) / sum(w) FILTER (v IS NOT NULL), {digits}) AS v FROM corners LEFT JOIN mos USING (row, col) WHERE w > 0 GROUP BY {keys}"""


@query(f"""WITH {S.POINTS}, {_MOSAIC},
asked AS (SELECT c_custkey AS id, (c_custkey * 31) % 1000 / 10.0::DOUBLE - 0.5::DOUBLE AS fx, 100 - (c_custkey * 17) % 1000 / 10.0::DOUBLE - 0.5::DOUBLE AS fy FROM customer), {_between("id")}""")
def bilinear_warp(spark, d):
    targets = S.table(spark, d, "customer").selectExpr("c_custkey AS id", "(c_custkey * 31) % 1000 / 10.0D AS x", "(c_custkey * 17) % 1000 / 10.0D AS y")
    return spatial.bilinear(targets, _mosaic(spark, d), 0.0, 100.0, 1.0).select("id", _r(F.col("v"), 3).alias("v"))


def _grid_sql(lon: str, lat: str) -> tuple[str, str]:
    """Easting and northing of degrees by the forward series; ``t``, ``xi`` and ``eta`` are lateral columns of the query."""
    _, forward, _ = geo._series()
    terms = lambda sine, hyper: " + ".join(f"{a!r}::DOUBLE * {sine}({2 * k} * xi) * {hyper}({2 * k} * eta)" for k, a in enumerate(forward, 1))
    radius = geo._series()[0]
    return f"500000 + 0.9996::DOUBLE * {radius!r}::DOUBLE * (eta + {terms('cos', 'sinh')})", f"0.9996::DOUBLE * {radius!r}::DOUBLE * (xi + {terms('sin', 'cosh')})"


def _projected(source: str) -> str:
    """Tables up to ``projected``: the columns of ``source`` (lon, lat) with east and north."""
    n = geo.FLATTENING / (2 - geo.FLATTENING)
    e = 2 * n**0.5 / (1 + n)
    east, north = _grid_sql("lon", "lat")
    return f"""bent AS (SELECT *, sinh(0.5::DOUBLE * ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) - {e!r}::DOUBLE * 0.5::DOUBLE * ln((1 + {e!r}::DOUBLE * sin(radians(lat))) / (1 - {e!r}::DOUBLE * sin(radians(lat))))) AS t, radians(lon - 15) AS across FROM {source}),
turned AS (SELECT *, atan2(t, cos(across)) AS xi, 0.5::DOUBLE * ln((1 + sin(across) / sqrt(1 + t * t)) / (1 - sin(across) / sqrt(1 + t * t))) AS eta FROM bent),
projected AS (SELECT *, {east} AS east, {north} AS north FROM turned)"""


_WARPED = [(8, x, y) for x in (136, 137, 138) for y in (73, 74, 75)]


@query(f"""WITH {S.POINTS}, {_MOSAIC}, chosen(z, x, y) AS (VALUES {", ".join(map(str, _WARPED))}),
pixels AS (SELECT z, x, y, px::INT AS px, py::INT AS py, degrees((x + (px + 0.5::DOUBLE) / 32) * (2 * pi() / 256) - pi()) AS lon, degrees(atan(sinh(pi() - (y + (py + 0.5::DOUBLE) / 32) * (2 * pi() / 256)))) AS lat
  FROM chosen, range(32) a(px), range(32) b(py)), {_projected("pixels")},
asked AS (SELECT z, x, y, px, py, (east - 400000) / 1000 - 0.5::DOUBLE AS fx, (6700000 - north) / 1000 - 0.5::DOUBLE AS fy FROM projected), found AS ({"WITH " + _between("z, x, y, px, py", 1)}) SELECT * FROM found WHERE v IS NOT NULL""")
def warped_tiles(spark, d):
    asked = spark.createDataFrame(_WARPED, "z int, x int, y int")
    return spatial.warped_tiles(asked, _mosaic(spark, d), 400_000.0, 6_700_000.0, 1000.0, 32).withColumn("v", _r(F.col("v"), 1))


_APART = "2 * 6371008.8 * asin(sqrt(least(pow(sin(radians(p.lat - k.lat) / 2), 2) + cos(radians(k.lat)) * cos(radians(p.lat)) * pow(sin(radians(p.lon - k.lon) / 2), 2), 1)))"


def _placed_sql(known: str) -> str:
    """Places found or created one after the other, from a list of those that exist."""
    return f"""WITH RECURSIVE asked AS (SELECT row_number() OVER (ORDER BY id) AS n, * FROM {S.place_sql('customer', 'c_custkey')}),
steps AS (
  SELECT 0::BIGINT AS n, {known} AS places, NULL::BIGINT AS id, NULL::BIGINT AS place_id, false AS created
  UNION ALL SELECT n, CASE WHEN met.d <= 400 THEN places ELSE list_append(places, {{'id': id, 'lon': lon, 'lat': lat}}) END, id, CASE WHEN met.d <= 400 THEN met.id ELSE id END, coalesce(met.d > 400, true)
  FROM (SELECT p.n, s.places, p.id, p.lon, p.lat, list_min(list_transform(s.places, lambda k: {{'d': {_APART}, 'id': k.id}})) AS met FROM steps s JOIN asked p ON p.n = s.n + 1))
SELECT id, place_id, created FROM steps WHERE n > 0"""


@query(_placed_sql("[]::STRUCT(id BIGINT, lon DOUBLE, lat DOUBLE)[]"))
def find_or_create_places(spark, d):
    points = S.places(spark, d, "customer", "c_custkey").withColumn("created_at", F.col("id"))
    return spatial.find_or_create(points, 400.0)


@query(_placed_sql(f"(SELECT list({{'id': -id, 'lon': lon, 'lat': lat}}) FROM {S.place_sql('supplier', 's_suppkey')})"))
def find_among_existing_places(spark, d):
    points = S.places(spark, d, "customer", "c_custkey").withColumn("created_at", F.col("id"))
    places = S.places(spark, d, "supplier", "s_suppkey").selectExpr("-id AS place_id", "lon", "lat")
    return spatial.find_or_create(points, 400.0, places)


@query(f"""WITH places AS (SELECT * FROM {S.place_sql('customer', 'c_custkey')}), {_projected("places")}
SELECT id, round(east, 3) AS east, round(north, 3) AS north, 0.0::DOUBLE AS dlon, 0.0::DOUBLE AS dlat FROM projected""")
def crs_round_trip(spark, d):
    placed = S.places(spark, d, "customer", "c_custkey")
    east, north = geo.to_grid(F.col("lon"), F.col("lat"))
    lon, lat = geo.to_degrees(F.col("east"), F.col("north"))
    moved = placed.withColumns({"east": east, "north": north})
    return moved.select("id", _r(F.col("east"), 3).alias("east"), _r(F.col("north"), 3).alias("north"), (_r(lon - F.col("lon"), 8) + 0.0).alias("dlon"), (_r(lat - F.col("lat"), 8) + 0.0).alias("dlat"))


@query(f"""WITH boxes AS (SELECT id, lon AS west, lat AS south, lon + 0.3::DOUBLE AS east_end, lat + 0.2::DOUBLE AS north_end FROM {S.place_sql('supplier', 's_suppkey')}),
edges AS (SELECT id, unnest([west + (east_end - west) * t, west + (east_end - west) * t, west, east_end]) AS lon, unnest([south, north_end, south + (north_end - south) * t, south + (north_end - south) * t]) AS lat
  FROM (SELECT *, k / 20.0::DOUBLE AS t FROM boxes, range(21) r(k))), {_projected("edges")}
SELECT id, round(min(east), 3) AS west, round(min(north), 3) AS south, round(max(east), 3) AS east, round(max(north), 3) AS north FROM projected GROUP BY id""")
def grid_bounds(spark, d):
    made = geo.grid_bounds(F.col("lon"), F.col("lat"), F.col("lon") + 0.3, F.col("lat") + 0.2)
    return S.places(spark, d, "supplier", "s_suppkey").select("id", made.alias("b")).select("id", *[_r(F.col(f"b.{c}"), 3).alias(c) for c in ("west", "south", "east", "north")])


@query("""SELECT c_custkey AS id, 20 + (c_custkey % 5) BETWEEN 20 AND 23 AND (c_custkey % 7) BETWEEN 0 AND 4 AS inside FROM customer""")
def inside_ring(spark, d):
    ring = F.array(*[F.struct(F.lit(a).alias("lon"), F.lit(b).alias("lat")) for a, b in ((19.5, -0.5), (23.5, -0.5), (23.5, 4.5), (19.5, 4.5), (19.5, -0.5))])
    return S.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), spatial.inside(20.0 + F.col("c_custkey") % 5, (F.col("c_custkey") % 7).cast("double"), ring).alias("inside"))


# Styles and text


def _slope_sql(k: int) -> str:
    stops = style.SLOPE_STOPS
    steps = " ".join(f"WHEN s <= {d1!r}::DOUBLE THEN {c0[k]} + {c1[k] - c0[k]} * (s - {d0!r}::DOUBLE) / ({d1!r}::DOUBLE - {d0!r}::DOUBLE)" for (d0, c0), (d1, c1) in zip(stops, stops[1:], strict=False))
    return f"round_even(CASE WHEN s <= 0 THEN {stops[0][1][k]} {steps} ELSE {stops[-1][1][k]} END, 0)::INT"


@query(f"SELECT id, {_slope_sql(0)} AS r, {_slope_sql(1)} AS g, {_slope_sql(2)} AS b FROM (SELECT p_partkey AS id, (p_partkey % 600 / 10.0::DOUBLE)::DOUBLE AS s FROM part)")
def slope_color(spark, d):
    made = style.slope_colour(F.col("s"))
    return S.table(spark, d, "part").selectExpr("p_partkey AS id", "p_partkey % 600 / 10.0D AS s").select("id", *[v.alias(k) for k, v in made.items()])


_STATES = ["clear", "overgrown", "partially_blocked", "fully_blocked", "other"]


@query("SELECT event_id AS id, ['#4caf50', '#e0b400', '#e0791e', '#d43d3d', NULL][event_id % 5 + 1] AS colour FROM events")
def status_color(spark, d):
    state = F.element_at(F.array(*[F.lit(s) for s in _STATES]), (F.col("event_id") % 5 + 1).cast("int"))
    return S.table(spark, d, "events").select(F.col("event_id").alias("id"), style.lookup(state, style.STATUS).alias("colour"))


@query(f"WITH {S.WAYS} SELECT way_id, CASE WHEN landuse IN ('forest') THEN '#2d4a2d' ELSE '#333' END AS colour FROM ways")
def landuse_color(spark, d):
    return S.ways(spark, d).select("way_id", style.lookup(features.tag(F.col("tags"), "landuse"), style.LANDUSE, "#333").alias("colour"))


@query("SELECT p_partkey AS id, round_even(168 + (27 - 168) * (p_size / 50.0::DOUBLE), 0)::INT AS r, round_even(138 + (79 - 138) * (p_size / 50.0::DOUBLE), 0)::INT AS g, round_even(91 + (114 - 91) * (p_size / 50.0::DOUBLE), 0)::INT AS b FROM part")
def wetness_ramp(spark, d):
    made = style.ramp(F.col("p_size") / 50.0, "wetness")
    return S.table(spark, d, "part").select(F.col("p_partkey").alias("id"), *[v.alias(k) for k, v in made.items()])


@query("""SELECT p_partkey AS id, CASE WHEN s >= 3600 THEN printf('%dh %02dm %02ds', s // 3600, s % 3600 // 60, s % 60) WHEN s >= 60 THEN printf('%dm %02ds', s // 60, s % 60) ELSE printf('%ds', s) END AS took
FROM (SELECT p_partkey, p_partkey * 7 % 9000 AS s FROM part)""")
def duration_text(spark, d):
    return S.table(spark, d, "part").select(F.col("p_partkey").alias("id"), text.duration(F.col("p_partkey") * 7 % 9000).alias("took"))


# Formats and triggers


_TILES = "SELECT c_custkey AS id, 11 AS z, c_custkey * 37 % 2048 AS x, c_custkey * 53 % 2048 AS y FROM customer"


@query(f"""WITH RECURSIVE s AS (SELECT id, x AS ox, y AS oy, x, y, 10 AS bit, 0::BIGINT AS d FROM ({_TILES})
UNION ALL SELECT id, ox, oy,
  CASE WHEN y >> bit & 1 = 1 THEN x WHEN x >> bit & 1 = 1 THEN 2047 - y ELSE y END, CASE WHEN y >> bit & 1 = 1 THEN y WHEN x >> bit & 1 = 1 THEN 2047 - x ELSE x END,
  bit - 1, d + (1::BIGINT << (2 * bit)) * xor(3 * (x >> bit & 1), y >> bit & 1) FROM s WHERE bit >= 0)
SELECT id, ox AS x, oy AS y, d + 1398101 AS tile FROM s WHERE bit = -1""")
def archive_order(spark, d):
    tiles = S.table(spark, d, "customer").selectExpr("c_custkey AS id", "11 AS z", "c_custkey * 37 % 2048 AS x", "c_custkey * 53 % 2048 AS y")
    return tiles.select("id", "x", "y", archive.tile_number(F.col("z"), F.col("x"), F.col("y")).alias("tile"))


@query("""SELECT id, status, CASE WHEN status = 206 THEN a END AS first, CASE WHEN status = 206 THEN least(b, 999) END AS last FROM (
SELECT o_orderkey AS id, o_orderkey % 1200 AS a, o_custkey % 1500 AS b,
  CASE WHEN o_orderkey % 7 = 0 THEN 400 WHEN o_orderkey % 1200 >= 1000 OR o_orderkey % 1200 > least(o_custkey % 1500, 999) THEN 416 ELSE 206 END AS status FROM orders)""")
def range_requests(spark, d):
    header = F.expr("concat(if(o_orderkey % 7 = 0, 'rows=', 'bytes='), o_orderkey % 1200, '-', o_custkey % 1500)")
    made = files.requested_range(header, F.lit(1000).cast("long"))
    return S.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), made.alias("r")).select("id", "r.*")


@query("""SELECT event_id AS id, user_id AS track_id FROM (
SELECT event_id, user_id, event_id * 37 % 101 - 50.5 AS x, lag(event_id * 37 % 101 - 50.5) OVER (PARTITION BY user_id ORDER BY ts) AS px FROM events) WHERE (x < 0) <> (px < 0)""")
def track_crossings(spark, d):
    fixes = S.table(spark, d, "events").selectExpr("event_id AS id", "user_id AS track_id", "ts AS at", "event_id * 37 % 101 - 50.5D AS lon", "event_id % 11 / 2.0D AS lat")
    line = F.array(*[F.struct(F.lit(0.0).alias("lon"), F.lit(b).alias("lat")) for b in (-1000.0, 1000.0)])
    return spatial.crossings(fixes, line).select("id", "track_id")


@query(f"WITH {S.WAYS} SELECT way_id FROM ways WHERE \"natural\" = 'peak'")
def metadata_filter(spark, d):
    return S.ways(spark, d).where(features.tag(F.col("tags"), "natural") == "peak").select("way_id")


@query()
def vector_tile_layers(spark, d):
    places = S.places(spark, d, "customer", "c_custkey")
    ends = F.array(F.struct("lon", "lat"), F.struct((F.col("lon") + 0.3).alias("lon"), (F.col("lat") + 0.2).alias("lat")))
    drawn = places.select(
        F.when(F.col("id") % 2 == 0, "paths").otherwise("peaks").alias("layer"), "id", F.when(F.col("id") % 2 == 0, "line").otherwise("point").alias("kind"),
        F.when(F.col("id") % 2 == 0, ends).otherwise(F.slice(ends, 1, 1)).alias("geometry"), F.create_map(F.lit("name"), F.concat(F.lit("P"), F.col("id") % 9)).alias("props"))
    return vector_tiles.vector_tiles(drawn, F.lit(11)).select("z", "x", "y", "n", F.sha2("data", 256).alias("digest"))


def _spheroid_sql(rounds: int = 8) -> str:
    """Nearest supplier of each customer on the spheroid, by rounds of the inverse formula over all pairs of close degrees."""
    axis, f = 6378137.0, 1 / 298.257223563
    minor = axis * (1 - f)
    reduced = lambda c: f"atan({1 - f!r}::DOUBLE * tan(radians({c})))"
    steps = [f"""q0 AS (SELECT p.id AS probe_id, k.id AS known_id, sin({reduced('p.lat')}) AS s1, cos({reduced('p.lat')}) AS c1, sin({reduced('k.lat')}) AS s2, cos({reduced('k.lat')}) AS c2,
  radians(k.lon - p.lon) AS l, radians(k.lon - p.lon) AS x FROM {S.place_sql('customer', 'c_custkey')} p JOIN {S.place_sql('supplier', 's_suppkey')} k ON abs(p.lat - k.lat) < 0.2 AND abs(p.lon - k.lon) < 0.4)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS (SELECT *, sqrt(pow(c2 * sin(x), 2) + pow(c1 * s2 - s1 * c2 * cos(x), 2)) AS sine, s1 * s2 + c1 * c2 * cos(x) AS cosine FROM q{i}),
b{i} AS (SELECT *, CASE WHEN sine = 0 THEN 0 ELSE c1 * c2 * sin(x) / sine END AS tilt, atan2(sine, cosine) AS arc FROM a{i}),
d{i} AS (SELECT *, 1 - tilt * tilt AS flat, CASE WHEN 1 - tilt * tilt <= 0 THEN 0 ELSE cosine - 2 * s1 * s2 / (1 - tilt * tilt) END AS m FROM b{i})""")
        if i < rounds:
            c = f"({f / 16!r}::DOUBLE * flat * (4 + {f!r}::DOUBLE * (4 - 3 * flat)))"
            steps.append(f"q{i + 1} AS (SELECT probe_id, known_id, s1, c1, s2, c2, l, l + (1 - {c}) * {f!r}::DOUBLE * tilt * (arc + {c} * sine * (m + {c} * cosine * (2 * m * m - 1))) AS x FROM d{i})")
    return f"""WITH {", ".join(steps)},
u AS (SELECT *, flat * {(axis**2 - minor**2) / minor**2!r}::DOUBLE AS u FROM d{rounds}),
v AS (SELECT *, 1 + u / 16384 * (4096 + u * (u * (320 - 175 * u) - 768)) AS big, u / 1024 * (256 + u * (u * (74 - 47 * u) - 128)) AS small FROM u),
w AS (SELECT probe_id, known_id, {minor!r}::DOUBLE * big * (arc - small * sine * (m + small / 4 * (cosine * (2 * m * m - 1) - small / 6 * m * (4 * sine * sine - 3) * (4 * m * m - 3)))) AS metres FROM v)
SELECT probe_id, known_id, round(metres, 3) AS metres FROM w WHERE metres <= 15000 QUALIFY row_number() OVER (PARTITION BY probe_id ORDER BY metres, known_id) = 1"""


@query(_spheroid_sql())
def nearest_on_spheroid(spark, d):
    probes = S.places(spark, d, "customer", "c_custkey").withColumnRenamed("id", "probe_id")
    known = S.places(spark, d, "supplier", "s_suppkey").withColumnRenamed("id", "known_id")
    return spatial.nearest_within(probes, known, 15_000.0, distance=geo.spheroid_distance).withColumn("metres", _r(F.col("metres"), 3))
