"""Deterministic geodata derived from the driver's tables with whole-number arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag AS tile", "((l_partkey * 7919 + l_linenumber * 104729) % 100000) / 1000.0D AS x",
        "((l_orderkey * 6101 + l_suppkey * 31) % 100000) / 1000.0D AS y", "round(l_extendedprice * 100) AS z",
        "CASE WHEN l_linenumber <= 2 THEN 2 WHEN l_linenumber = 3 THEN 9 ELSE 5 END AS cls")


POINTS = """points AS (SELECT l_returnflag AS tile, ((l_partkey * 7919 + l_linenumber * 104729) % 100000) / 1000.0::DOUBLE AS x,
  ((l_orderkey * 6101 + l_suppkey * 31) % 100000) / 1000.0::DOUBLE AS y, round(l_extendedprice * 100) AS z,
  CASE WHEN l_linenumber <= 2 THEN 2 WHEN l_linenumber = 3 THEN 9 ELSE 5 END AS cls FROM lineitem),
extents AS (SELECT tile, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, ceil(max(x) - min(x))::INT AS cols, ceil(max(y) - min(y))::INT AS rows FROM points GROUP BY tile),
placed AS (SELECT p.tile, e.rows, e.cols, trunc(e.y1 - p.y)::INT AS row, trunc(p.x - e.x0)::INT AS col, p.z, p.cls FROM points p JOIN extents e USING (tile)),
cells AS (SELECT tile, rows, cols, row, col, CASE WHEN count(*) FILTER (cls = 2) > 0 THEN sum(z) FILTER (cls = 2) / count(*) FILTER (cls = 2) END AS dtm,
  max(z) AS dsm, (count(*) - count(*) FILTER (cls = 2)) / count(*) AS density, bool_or(cls = 9) AS water FROM placed
  WHERE row >= 0 AND row < rows AND col >= 0 AND col < cols GROUP BY ALL)"""


def blocks(spark: SparkSession, sf_dir: str, gaps: bool = True) -> DataFrame:
    """8 x 8 rasters: every seventh cell is empty."""
    data = F.transform("embedding", lambda v, i: F.when((i % 7 != 0) if gaps else F.lit(True), v.cast("double")))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), data.alias("data"))


def block_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = blocks(spark, sf_dir).select("id", F.posexplode("data").alias("pos", "v"))
    return cells.selectExpr("id AS tile", "8 AS rows", "8 AS cols", "cast(pos div 8 AS int) AS row", "cast(pos % 8 AS int) AS col", "v")


BLOCKS = """bl AS (SELECT vec_id AS tile, (i // 8)::INT AS row, (i % 8)::INT AS col, CASE WHEN i % 7 <> 0 THEN embedding[i + 1]::DOUBLE END AS v
  FROM embeddings, range(64) r(i))"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id AS id", "user_id AS trail_id", "event_type AS entry_type", "props AS value", "ts AS created_at")


def places(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return table(spark, sf_dir, name).selectExpr(f"{key} AS id", f"12 + (({key} * 37) % 5000) / 1000.0D AS lon", f"59.7D + (({key} * 53) % 2500) / 1000.0D AS lat")


def place_sql(name: str, key: str) -> str:
    return f"(SELECT {key} AS id, 12 + (({key} * 37) % 5000) / 1000.0::DOUBLE AS lon, 59.7::DOUBLE + (({key} * 53) % 2500) / 1000.0::DOUBLE AS lat FROM {name})"


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as ways; their tags come from small codes."""
    return table(spark, sf_dir, "part").selectExpr("p_partkey AS way_id", f"{TAGS} AS tags", "p_size", "p_name", "p_type")


KEYS = ("highway", "waterway", "railway", "power", "natural", "place", "landuse", "building")
# Tag values by position; a part takes one of each by its key.
VALUES = {
    "highway": ["", "primary", "track", "path", "construction", "", ""], "waterway": ["", "stream", "", "", ""], "railway": ["", "rail", "abandoned"],
    "power": ["", "line", "pole", ""], "natural": ["", "cliff", "peak", "wetland", "wood", "water", ""], "place": ["", "town", "", "farm"],
    "landuse": ["", "forest", "reservoir", ""], "building": ["", "yes", "", "", ""],
}


def value_sql(key: str) -> str:
    options = VALUES[key]
    step = 3 + len(key)
    return "CASE " + " ".join(f"WHEN (p_partkey * {step}) % {len(options)} = {i} THEN '{v}'" for i, v in enumerate(options)) + " END"


TAGS = "map_filter(map(" + ", ".join(f"'{k}', {value_sql(k)}" for k in KEYS) + "), (k, v) -> v <> '')"
WAYS = "ways AS (SELECT p_partkey AS way_id, " + ", ".join(f'{value_sql(k)} AS "{k}"' for k in KEYS) + " FROM part)"


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as route relations; their kinds by the priority's first figure, a tenth of them without a name."""
    kinds = "element_at(array('mtb', 'bicycle', 'ski', 'hiking', 'foot'), cast(substr(o_orderpriority, 1, 1) AS int))"
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey AS relation_id", "o_orderkey % 1000 AS seq", f"{kinds} AS route", "CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE concat('R', o_orderkey % 97) END AS name")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS relation_id", "l_partkey AS way_id", "element_at(array('w', 'w', 'w', 'w', 'w', 'n', 'r'), l_linenumber) AS type")


ROUTES = """routed AS (SELECT l_partkey AS way_id, o_orderkey AS relation_id, o_orderkey % 1000 AS seq,
  ['mtb', 'bicycle', 'ski', 'hiking', 'foot'][left(o_orderpriority, 1)::INT] AS route, left(o_orderpriority, 1)::INT AS rank,
  CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'R' || (o_orderkey % 97) END AS name FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber <= 5),
best AS (SELECT way_id, route AS route_type, name AS route_name, relation_id AS route_relation_id, count(*) OVER (PARTITION BY way_id) AS memberships
  FROM routed WHERE name <> '' QUALIFY row_number() OVER (PARTITION BY way_id ORDER BY rank, seq, relation_id) = 1)"""
