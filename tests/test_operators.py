"""Operators of the terrain and trail engine on small hand-worked cases."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import __spark_entry__
from ridgeline.functions import encode, geo, style, text, tiles
from ridgeline.operators import features, focal, grid, spatial, tiling, trails
from ridgeline.sources import files

POINTS = [(0.0, 2.0, 10.0, 2), (0.2, 1.9, 12.0, 2), (0.4, 1.6, 20.0, 5), (1.5, 1.5, 11.0, 2), (1.6, 0.4, 30.0, 5), (2.0, 0.0, 99.0, 2)]


@pytest.fixture(scope="module")
def cells(spark):
    points = spark.createDataFrame([("t", *p) for p in POINTS], "tile string, x double, y double, z double, cls int")
    return grid.surfaces(points)


def by_cell(df, value):
    return {(r.row, r.col): r[value] for r in df.collect() if r[value] is not None}


def test_surfaces_drop_the_far_corner(cells):
    assert by_cell(cells, "dtm") == {(0, 0): 11.0, (0, 1): 11.0}
    assert by_cell(cells, "dsm") == {(0, 0): 20.0, (0, 1): 11.0, (1, 1): 30.0}
    assert by_cell(cells, "density") == {(0, 0): pytest.approx(1 / 3), (0, 1): 0.0, (1, 1): 1.0}


def test_fill_repeats_the_border(cells):
    assert by_cell(focal.fill_gaps(cells, "dsm"), "dsm") == {(0, 0): 20.0, (0, 1): 11.0, (1, 1): 30.0, (1, 0): pytest.approx(22.2)}
    assert by_cell(focal.fill_round(cells, "dtm"), "dtm")[1, 1] == 11.0
    assert by_cell(focal.fill_gaps(cells, "density"), "density")[1, 0] == pytest.approx(0.53333, abs=1e-4)


def test_gaps_far_from_data_take_the_nearest_cell(spark):
    draw = np.random.default_rng(3)
    known = {(int(r), int(c)): float(v) for r, c, v in zip(draw.integers(0, 30, 9), draw.integers(0, 41, 9), draw.normal(size=9), strict=True)}
    cells = spark.createDataFrame([("t", 30, 41, r, c, v) for (r, c), v in known.items()] + [("t", 30, 41, 0, 40, None), ("none", 2, 2, 0, 0, None)], "tile string, rows int, cols int, row int, col int, v double")
    whole = np.full((30, 41), np.nan)
    for at, v in known.items():
        whole[at] = v
    assert by_cell(focal.fill_nearest(cells, "v"), "v") == {(r, c): v for (r, c), v in np.ndenumerate(focal.nearest(whole))}
    filled = by_cell(focal.fill_gaps(cells, "v"), "v")
    whole = np.full((30, 41), np.nan)
    near = cells
    for _ in range(5):
        near = focal.fill_round(near, "v")
    near = by_cell(near, "v")
    for at, v in near.items():
        whole[at] = v
    assert len(near) < len(filled) == 30 * 41
    assert filled == pytest.approx({(r, c): v for (r, c), v in np.ndenumerate(focal.nearest(whole))})


def test_the_entry_has_no_gaps(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    rows = __spark_entry__.entry(spark).collect()
    assert rows and all(r.chm is not None for r in rows)


def test_canopy(spark):
    df = spark.createDataFrame([(20.0, 11.0), (11.0, 11.4), (11.4, 11.0), (5.0, None)], "s double, t double")
    assert [r[0] for r in df.select(grid.canopy(F.col("s"), F.col("t"))).collect()] == [9.0, 0.0, 0.0, None]


def test_encodings(spark):
    df = spark.createDataFrame([(0.0,), (123.456,), (-9999.9,), (2104.0,), (-20000.0,), (412.35,)], "e double")
    assert [r[0] for r in df.select(encode.terrain_code(F.col("e"))).collect()] == [100000, 101235, 1, 121040, 0, 104123]
    heights = spark.createDataFrame([(0.0, 0.0, -5.0), (0.6, 50.0, -1.0), (17.5, 90.0, 0.0), (50.0, 100.0, 1.0)], "h double, w double, l double")
    made = heights.select(encode.canopy_byte(F.col("h")), encode.wetness_byte(F.col("w")), encode.relief_byte(F.col("l"))).collect()
    assert [tuple(r) for r in made] == [(0, 0, 0), (4, 128, 85), (128, 230, 128), (255, 255, 170)]


def test_round_trip_of_elevations(spark):
    df = spark.range(1000).select((F.col("id") * 3.37 - 500).alias("e"))
    rgb = encode.terrain_rgb(F.col("e"))
    assert df.select(F.max(F.abs(encode.terrain_elevation(rgb["r"], rgb["g"], rgb["b"]) - F.col("e")))).first()[0] < 0.051


def test_tiles(spark):
    df = spark.createDataFrame([(15.0, 60.5, 12), (12.0, 62.0, 12), (15.0, 60.5, 17), (0.0, 0.0, 1)], "lon double, lat double, z int")
    y = tiles.lat_to_y(F.col("lat"), F.col("z"))
    made = df.select(tiles.lon_to_x(F.col("lon"), F.col("z")), y, tiles.tms_row(y, F.col("z"))).collect()
    assert [tuple(r) for r in made] == [(2218, 1178, 2917), (2184, 1142, 2953), (70997, 37696, 93375), (1, 1, 0)]


def test_relief_of_blocks_is_that_of_the_whole(spark):
    draw = np.random.default_rng(1).random((20, 24)) * 4
    draw[3:5, 6:9] = np.nan
    rows = [("t", r, c, float(v)) for (r, c), v in np.ndenumerate(draw) if not np.isnan(v)]
    df = spark.createDataFrame(rows, "tile string, row int, col int, v double")
    whole = focal.relief(draw, 1.0)
    made = focal.relief_blocks(df, "v", 1.0, block=8).collect()
    inner = [(r.row, r.col, r.relief) for r in made]
    assert len(inner) == len(rows)
    assert all(abs(int(whole[r, c]) - v) <= 1 for r, c, v in inner)
    assert (focal.relief(np.full((3, 3), np.nan)) == 128).all()


def test_nearest_ties_go_to_the_first_row():
    grid_ = np.array([[1.0, np.nan, 2.0], [np.nan, np.nan, np.nan]])
    assert focal.nearest(grid_).tolist() == [[1.0, 1.0, 2.0], [1.0, 1.0, 2.0]]
    assert np.isnan(focal.nearest(np.full((2, 2), np.nan))).all()


def brute_nearest(grid_):
    full = np.argwhere(~np.isnan(grid_))
    out = grid_.copy()
    for r, c in np.argwhere(np.isnan(grid_)):
        out[r, c] = grid_[tuple(full[((full - (r, c)) ** 2).sum(axis=1).argmin()])]  # argmin takes the first in row order
    return out


def test_nearest_matches_brute_force():
    draw = np.random.default_rng(5)
    for height, width, share in ((1, 9, 0.5), (9, 1, 0.5), (17, 23, 0.05), (23, 17, 0.5), (30, 30, 0.95), (40, 12, 0.004)):
        grid_ = np.arange(height * width, dtype=float).reshape(height, width)
        holes = grid_.copy()
        holes[draw.random(grid_.shape) > share] = np.nan
        if np.isnan(holes).all():
            holes[height // 2, width // 2] = 1.0
        assert focal.nearest(holes).tolist() == brute_nearest(holes).tolist()


def test_nearest_and_relief_of_a_large_block():
    draw = np.random.default_rng(6)
    whole = draw.random((1000, 1000)).cumsum(axis=0)
    holes = whole.copy()
    holes[draw.random(whole.shape) < 0.1] = np.nan
    holes[300:700, 200:600] = np.nan  # a lake
    filled = focal.nearest(holes)
    empty = np.argwhere(np.isnan(holes))
    full = ~np.isnan(holes)
    assert not np.isnan(filled).any() and (filled[full] == whole[full]).all()
    # Sampled cells against all cells within the distance of any that is found nearby.
    for r, c in empty[draw.integers(0, len(empty), 60)]:
        reach = 210
        r0, c0 = max(0, r - reach), max(0, c - reach)
        near = np.argwhere(full[r0 : r + reach, c0 : c + reach]) + (r0, c0)
        best = near[((near - (r, c)) ** 2).sum(axis=1).argmin()]
        assert filled[r, c] == whole[tuple(best)]
    scaled = focal.relief(holes, 5.0)
    assert (scaled[~full] == 128).all() and scaled.std() > 0


def test_gaps_fill_alike_in_blocks_and_rounds(spark):
    draw = np.random.default_rng(8)
    rows = [("t", 30, 41, r, c, float(draw.integers(0, 100))) for r in range(30) for c in range(41) if draw.random() < 0.04]
    df = spark.createDataFrame(rows, "tile string, rows int, cols int, row int, col int, v double")
    step = df
    for _ in range(5):
        step = focal.fill_round(step, "v")
    want = {(r.row, r.col): r.v for r in focal.fill_nearest(step, "v").collect()}
    for block in (8, 512):
        got = {(r.row, r.col): r.v for r in focal.fill_gaps(df, "v", block=block).collect()}
        assert len(got) == 30 * 41 and got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_pyramid(spark):
    rows = [("t", r, c, float(r * 50 + c)) for r in range(40) for c in range(50) if (r + c) % 3]
    df = spark.createDataFrame(rows, "tile string, row int, col int, v double")
    made = {(r.factor, r.row, r.col): r.v for r in grid.pyramid(df, "v").collect()}
    for factor in (2, 4, 8, 16, 32, 64, 128, 256):
        cells = {}
        for _, r, c, v in rows:
            cells.setdefault((factor, r // factor, c // factor), []).append(v)
        assert {k: v for k, v in made.items() if k[0] == factor} == {k: pytest.approx(sum(v) / len(v)) for k, v in cells.items()}


def test_layers(spark):
    cases = [({"highway": "track", "waterway": "stream"}, "tracks"), ({"highway": "construction", "waterway": "stream"}, "waterways"), ({"highway": "construction"}, None), ({"railway": "abandoned", "power": "line"}, "powerlines"), ({"natural": "cliff"}, "natural_lines")]
    df = spark.createDataFrame([(t, w) for t, w in cases], "tags map<string,string>, want string")
    assert all(r[0] == r.want for r in df.select(features.line_layer(F.col("tags")), "want").collect())
    peak = spark.createDataFrame([({"natural": "peak", "place": "town"},)], "tags map<string,string>")
    assert peak.select(features.point_layer(F.col("tags"))).first()[0] == "peaks"
    areas = spark.createDataFrame([("wetland", None, None), (None, "reservoir", "yes")], "n string, l string, b string")
    assert [r[0] for r in areas.select(features.polygon_layers(F.col("n"), F.col("l"), F.col("b"))).collect()] == [["water", "landuse"], ["water", "buildings"]]


def test_plain_tags(spark):
    df = spark.createDataFrame([([("A:b", "1"), ("a-b", "2"), ("A B", "3")],)], "e array<struct<key:string,value:string>>")
    assert df.select(features.plain_tags(F.col("e"))).first()[0] == {"a_b": "1", "a_b_1": "2", "a_b_2": "3"}


def test_best_route(spark):
    relations = spark.createDataFrame([(1, 1, "hiking", "H"), (2, 2, "mtb", "M1"), (3, 3, "mtb", "M2"), (4, 4, "mtb", "")], "relation_id long, seq long, route string, name string")
    members = spark.createDataFrame([(i, 7) for i in range(1, 5)], "relation_id long, way_id long")
    assert features.best_routes(relations, members).collect() == [Row(way_id=7, route_type="mtb", route_name="M1", route_relation_id=2, memberships=3)]


def test_way_lines_and_rings(spark):
    ways = spark.createDataFrame([(1, [3, 1, 9, 2]), (2, [9, 1])], "way_id long, refs array<long>")
    nodes = spark.createDataFrame([(1, 1.0, 0.0), (2, 2.0, 0.0), (3, 3.0, 0.0)], "node_id long, lon double, lat double")
    assert [(r.way_id, [p.lon for p in r.geometry]) for r in features.way_lines(ways, nodes).collect()] == [(1, [3.0, 1.0, 2.0])]
    parts = spark.createDataFrame([(1, 1, [(0.0, 0.0), (1.0, 0.0)]), (1, 2, [(1.0, 1.0), (1.0, 0.0)]), (1, 3, [(1.0, 1.0), (0.0, 0.0)]), (1, 4, [(5.0, 5.0), (6.0, 6.0)])], "polygon_id long, seq int, line array<struct<lon:double,lat:double>>")
    assert [[tuple(p) for p in r.ring] for r in features.rings(parts).collect()] == [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]


def test_rules_let_the_unknown_pass(spark):
    cases = [("status", '{"status":"clear"}', True), ("status", '{"status":"x"}', False), ("status", "{}", True), ("comment", "{}", False), ("other", "{}", True)]
    df = spark.createDataFrame(cases, "kind string, value string, ok boolean")
    bad = trails.violations(df, trails.value_rule(F.col("kind"), F.col("value")))
    assert bad.count() == 2 and bad.where("ok").count() == 0
    assert trails.violations(df, trails.value_rule(F.col("kind"), F.col("value"), strict=True)).count() == 3


def test_unique_and_upsert(spark):
    df = spark.createDataFrame([("way", 5), ("way", 5), (None, None), (None, None)], "t string, i int")
    assert [r.n for r in trails.repeated_keys(df, "t", "i").collect()] == [2]
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, version int")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2)], "k int, v string, version int")
    assert {r.k: r.v for r in trails.upsert(old, new, "k").collect()} == {1: "a", 2: "d"}


def test_find_or_create_goes_by_order(spark):
    step = math.degrees(10 / geo.EARTH_RADIUS)
    line = lambda order: spark.createDataFrame([(k, 15.0, 60.0 + m / 10 * step, t) for t, (k, m) in enumerate(order)], "id string, lon double, lat double, created_at int")
    made = lambda order: {r.id: r.place_id for r in spatial.find_or_create(line(order)).collect()}
    assert made([("a", 0), ("b", 10), ("c", 20)]) == {"a": "a", "b": "a", "c": "c"}
    assert made([("b", 10), ("a", 0), ("c", 20)]) == {"a": "b", "b": "b", "c": "b"}


def test_nearest_at_any_latitude(spark):
    draw = np.random.default_rng(11)
    spots = [(float(lon), float(lat)) for lat in (-89.99, -85.0, -60.0, 0.0, 45.0, 76.0, 85.0, 89.5, 89.95) for lon in (-179.95, -60.0, 0.0, 179.98) for _ in range(4)]
    some = lambda: [(i, (lon + draw.normal() * 0.05 / max(0.02, math.cos(math.radians(lat))) + 180) % 360 - 180, max(-90.0, min(90.0, lat + draw.normal() * 0.05))) for i, (lon, lat) in enumerate(spots)]
    probes, known = some(), some()
    got = {r.probe_id: r.known_id for r in spatial.nearest_within(spark.createDataFrame(probes, "probe_id long, lon double, lat double"), spark.createDataFrame(known, "known_id long, lon double, lat double"), 15_000.0).collect()}
    want = {}
    for i, lon, lat in probes:
        near = min((spatial._apart(lon, lat, a, b), k) for k, a, b in known)
        if near[0] <= 15_000:
            want[i] = near[1]
    assert got == want and len(want) > 100


def test_find_among_existing_places(spark):
    step = math.degrees(10 / geo.EARTH_RADIUS)
    points = spark.createDataFrame([("p", 15.0, 60.0, 1), ("q", 15.0, 60.0 + 3 * step, 2), ("r", 179.99999, 10.0, 3), ("s", 15.0, 60.0 + 4 * step, 4), ("t", None, 60.0, 5)], "id string, lon double, lat double, created_at int")
    places = spark.createDataFrame([("old", 15.0, 60.0 + step), ("far", 16.0, 60.0), ("west", -179.99999, 10.0)], "place_id string, lon double, lat double")
    made = {r.id: (r.place_id, r.created) for r in spatial.find_or_create(points, 15.0, places).collect()}
    assert made == {"p": ("old", False), "q": ("q", True), "r": ("west", False), "s": ("q", False)}
    # A second batch finds what the first one made.
    now = places.unionByName(spark.createDataFrame([("q", 15.0, 60.0 + 3 * step)], "place_id string, lon double, lat double"))
    assert {r.id: r.place_id for r in spatial.find_or_create(points.where("id = 'q'").withColumn("id", F.lit("q2")), 15.0, now).collect()} == {"q2": "q"}
    assert spatial.find_or_create(points.limit(0), 15.0, places).count() == 0


def test_collections(spark, tmp_path):
    import glob
    import json

    df = spark.createDataFrame([(i, "a" if i < 25 else "b", float(i)) for i in range(30)], "id long, layer string, lon double").withColumn("lat", F.lit(1.0))
    made = df.select("layer", geo.feature_json(geo.point_geometry(F.struct("lon", "lat")), F.create_map(F.lit("n"), F.col("id").cast("string"), F.lit("none"), F.lit(None).cast("string"))).alias("feature"))
    files.write_collections(made, str(tmp_path / "out"), size=10)
    met = {}
    for path in glob.glob(str(tmp_path / "out/layer=*/*.txt")):
        whole = json.load(open(path))
        assert whole["type"] == "FeatureCollection"
        met.setdefault(path.split("layer=")[1][0], []).extend(f["properties"]["n"] for f in whole["features"])
    assert {k: sorted(map(int, v)) for k, v in met.items()} == {"a": list(range(25)), "b": list(range(25, 30))}


def test_only_ways_are_members(spark):
    relations = spark.createDataFrame([(1, 1, "mtb", "M")], "relation_id long, seq long, route string, name string")
    members = spark.createDataFrame([(1, 7, "w"), (1, 8, "n"), (1, 9, "r")], "relation_id long, way_id long, type string")
    assert [r.way_id for r in features.best_routes(relations, members).collect()] == [7]


def test_water_lies_over_the_shaded_ramp(spark):
    df = spark.createDataFrame([(0.0, 1.0, False), (0.5, 0.5, False), (1.0, 0.0, True)], "t double, s double, w boolean")
    rows = df.select(*[c.alias(k) for k, c in style.shaded(F.col("t"), F.col("s"), F.col("w")).items()]).collect()
    assert tuple(rows[2]) == style.WATER
    assert tuple(rows[0]) == pytest.approx(tuple(0.3 + 0.7 * v / 255 for v in (245, 240, 232)))
    assert tuple(rows[1]) == pytest.approx(tuple(0.15 + 0.7 * v / 255 for v in (116, 184, 110)))
    light = df.select(*[c.alias(k) for k, c in style.light_colours(F.col("t")).items()]).collect()
    assert tuple(light[0]) == ("hsl(240, 15%, 8%)", "hsl(45, 30%, 55%)") and light[2].highlight == "hsl(45, 30%, 90%)"


def test_projection_round_trip(spark):
    df = spark.createDataFrame([(12.0, 60.0), (18.5, 67.3)], "lon double, lat double")
    east, north = geo.to_grid(F.col("lon"), F.col("lat"))
    moved = df.withColumns({"e": east, "n": north})
    lon, lat = geo.to_degrees(F.col("e"), F.col("n"))
    for r in moved.select((lon - F.col("lon")).alias("a"), (lat - F.col("lat")).alias("b")).collect():
        assert abs(r.a) < 1e-9 and abs(r.b) < 1e-9


def test_inside_and_entered(spark):
    ring = F.array(*[F.struct(F.lit(float(a)).alias("lon"), F.lit(float(b)).alias("lat")) for a, b in ((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))])
    track = spark.createDataFrame([("x", t, lon, 2.0) for t, lon in enumerate((-1.0, 1.0, 2.0, 5.0, 3.0))], "track_id string, at int, lon double, lat double")
    assert [r.at for r in spatial.entered(track, ring).orderBy("at").collect()] == [1, 4]


def test_sinks(spark, tmp_path):
    pixels = spark.createDataFrame([(3, 1, 2, p, p, 0, 255) for p in range(4)], "z int, x int, y int, px int, r int, g int, b int")
    made = files.png_tiles(pixels, 2)
    path = str(tmp_path / "t.mbtiles")
    assert files.write_mbtiles(made, path, "terrain") == 1
    import sqlite3

    with sqlite3.connect(path) as db:
        assert db.execute("SELECT tile_row, substr(tile_data, 2, 3) FROM tiles").fetchall() == [(5, b"PNG")]
    for name in ("3/1/2.png", "3/1/3.empty", "x/1/2.png", "notes.txt"):
        f = tmp_path / "tree" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"abc")
    assert {(r.z, r.x, r.y, r.empty) for r in files.tile_files(spark, str(tmp_path / "tree")).collect()} == {(3, 1, 2, False), (3, 1, 3, True)}


def test_resume_style_and_text(spark):
    work = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    done = spark.createDataFrame([(1, 10), (2, 0)], "k int, size int")
    assert {r.k for r in tiling.remaining(work, done, "k").collect()} == {2, 3}
    slopes = spark.createDataFrame([(0.5,), (3.0,), (60.0,)], "s double")
    assert [r[0] for r in slopes.select(style.slope_colour(F.col("s"))["r"]).collect()] == [33, 144, 154]
    assert [r[0] for r in spark.createDataFrame([(3,), (125,), (3725,)], "s int").select(text.duration(F.col("s"))).collect()] == ["3s", "2m 05s", "1h 02m 05s"]


def test_streams(spark, tmp_path):
    from ridgeline.streaming import conditions

    rows = [(1, "a", "status", "clear", "2024-01-01 10:00:00"), (2, "a", "status", "overgrown", "2024-01-01 11:00:00"), (3, "b", "comment", "x", "2024-01-01 12:00:00")]
    spark.createDataFrame(rows, "id int, trail_id string, entry_type string, value string, at string").selectExpr("id", "trail_id", "entry_type", "value", "cast(at AS timestamp) AS created_at").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, trail_id string, entry_type string, value string, created_at timestamp").parquet(str(tmp_path / "in"))
    q = conditions.latest_status(stream).writeStream.outputMode("complete").format("memory").queryName("latest").start()
    q.processAllAvailable()
    q.stop()
    assert [(r.trail_id, r.value) for r in spark.table("latest").collect()] == [("a", "overgrown")]


def test_found_places_match_one_pass(spark):
    draw = np.random.default_rng(3)
    # A long chain of touching cells, and loose points.
    lon = [15 + 0.00012 * i for i in range(150)] + list(15 + draw.random(150) * 0.02)
    lat = [60.0] * 150 + list(60 + draw.random(150) * 0.01)
    rows = [(int(i), float(lon[i]), float(lat[i]), int(t)) for i, t in enumerate(draw.permutation(300))]
    df = spark.createDataFrame(rows, "id long, lon double, lat double, created_at long")
    found = sorted(tuple(r) for r in spatial.find_or_create(df, 15.0).collect())
    ordered = sorted(rows, key=lambda r: (r[3], r[0]))
    places, want = [], []
    for i, lon_, lat_, _ in ordered:
        near = min(((spatial._apart(lon_, lat_, a, b), k) for k, a, b in places), default=(16.0, None))
        new = near[0] > 15
        if new:
            places.append((i, lon_, lat_))
        want.append((i, i if new else near[1], new))
    assert found == sorted(want)
