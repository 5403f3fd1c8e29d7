"""Map elements, vector tiles, archives, ranges and distances against bytes and values made here."""

import gzip
import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline.functions import geo
from ridgeline.operators import spatial
from ridgeline.sources import archive, elements, files, rasters
from ridgeline.sources import vector_tiles as vt


def fold(v):
    return v << 1 if v >= 0 else (-v << 1) - 1


def packed(values, signed=False):
    return b"".join(vt.number(fold(v) if signed else v) for v in values)


def whole(field, value):
    return vt.number(field << 3) + vt.number(value)


def deltas(values):
    return [b - a for a, b in zip([0, *values], values, strict=False)]


def blob(kind, data, squeeze=True):
    body = whole(2, len(data)) + vt.block(3, zlib.compress(data)) if squeeze else vt.block(1, data)
    head = vt.block(1, kind) + whole(3, len(body))
    return struct.pack(">I", len(head)) + head + body


@pytest.fixture()
def map_file(tmp_path):
    texts = [b"", b"natural", b"peak", b"name", "Höjd".encode(), b"highway", b"path", b"outer", b"mtb", b"route"]
    table = vt.block(1, b"".join(vt.block(1, t) for t in texts))
    ids, lats, lons = [5, 3, 1 << 40], [605000000, 605000010, -1], [150000000, 149999990, -1800000000]
    dense = vt.block(1, packed(deltas(ids), True)) + vt.block(8, packed(deltas(lats), True)) + vt.block(9, packed(deltas(lons), True)) + vt.block(10, packed([1, 2, 3, 4, 0, 0, 0]))
    node = whole(1, fold(-7)) + whole(8, fold(10)) + whole(9, fold(20))
    first = table + vt.block(2, vt.block(2, dense)) + vt.block(2, vt.block(1, node))
    way = whole(1, 9) + vt.block(2, packed([5])) + vt.block(3, packed([6])) + vt.block(8, packed(deltas([5, 3, 1 << 40]), True))
    relation = whole(1, 11) + vt.block(2, packed([9])) + vt.block(3, packed([8])) + vt.block(8, packed([7, 0])) + vt.block(9, packed(deltas([9, 5]), True)) + vt.block(10, packed([1, 0]))
    second = table + vt.block(2, vt.block(3, way)) + vt.block(2, vt.block(4, relation)) + whole(17, 1000)
    path = tmp_path / "region.osm.pbf"
    path.write_bytes(blob(b"OSMHeader", b"") + blob(b"OSMData", first) + blob(b"OSMData", second, squeeze=False))
    return str(path)


def test_map_elements(spark, map_file):
    found = {(r.kind, r.id): r for r in elements.elements(spark, map_file).collect()}
    assert set(found) == {("n", 5), ("n", 3), ("n", 1 << 40), ("n", -7), ("w", 9), ("r", 11)}
    assert (found["n", 5].lon, found["n", 5].lat, found["n", 5].tags) == (15.0, 60.5, {"natural": "peak", "name": "Höjd"})
    assert found["n", 3].tags == {} and found["n", 1 << 40].lon == -180.0 and found["n", -7].lat == pytest.approx(1e-6)
    assert found["w", 9].refs == [5, 3, 1 << 40] and found["w", 9].tags == {"highway": "path"}
    assert [tuple(m) for m in found["r", 11].members] == [("w", 9, "outer"), ("n", 5, "")]
    assert found["w", 9].seq > found["n", -7].seq > found["n", 5].seq
    assert [r.id for r in elements.elements(spark, map_file, "w").collect()] == [9]
    reader = elements.ElementReader({"path": map_file, "portion": "1"})
    assert len(reader.partitions()) == 2
    assert elements.packed(packed([0, -1, 1 << 62, -(1 << 62)], True), signed=True).tolist() == [0, -1, 1 << 62, -(1 << 62)]


def read_layer(data):
    (number, layer), *rest = elements.fields(data)
    assert number == 3 and not rest
    return list(elements.fields(layer))


def test_vector_tiles(spark):
    rows = [
        ("paths", 1, "line", [(14.99, 60.5), (15.2, 60.5)], {"name": "A", "none": None}),
        ("peaks", 2, "point", [(15.0, 60.5)], {"name": "A"}),
        ("water", 3, "polygon", [(14.0, 60.0), (16.0, 60.0), (16.0, 61.0), (14.0, 61.0), (14.0, 60.0)], {}),
        ("water", 4, "polygon", [(15.0, 60.5), (15.00001, 60.5), (15.00001, 60.50001), (15.0, 60.5)], {}),
        ("empty", 5, "line", [], {}), ("paths", 6, "line", [(15.0, 60.5), (15.0000001, 60.5)], None),
    ]
    df = spark.createDataFrame(rows, "layer string, id long, kind string, geometry array<struct<lon:double,lat:double>>, props map<string,string>")
    tiles = {(r.x, r.y): r for r in vt.vector_tiles(df, F.lit(12)).collect()}
    home = tiles[2218, 1178]
    assert home.n == 4
    layers = {bytes(dict(f)[1]).decode(): f for f in ([*elements.fields(v)] for _, v in elements.fields(home.data))}
    assert list(layers) == ["paths", "peaks", "water"]
    peak = next(dict(elements.fields(v)) for k, v in layers["peaks"] if k == 2)
    drawn = elements.packed(peak[4]).tolist()
    assert (peak[1], peak[3], drawn[0]) == (2, 1, 1 << 3 | 1)
    x, y = vt.on_grid([(15.0, 60.5)], 12, 2218, 1178)[0]
    assert drawn[1:] == [fold(round(x)), fold(round(y))]
    sea = [dict(elements.fields(v)) for k, v in layers["water"] if k == 2]
    assert [f[1] for f in sea] == [3] and elements.packed(sea[0][4]).tolist()[-1] == 1 << 3 | 7
    assert [bytes(v) for k, v in layers["paths"] if k == 3] == [b"name"]
    # Every tile the long line meets has a piece, and the pieces end at the buffer.
    assert {x for x, y in tiles if y == 1178} >= set(range(2218, 2221))
    assert vt.cut_line([(-200.0, 5.0), (9000.0, 5.0)], -64, 4160) == [[(-64.0, 5.0), (4160.0, 5.0)]]
    assert len(vt.cut_line([(0.0, 0.0), (9000.0, 0.0), (9000.0, 10.0), (0.0, 10.0)], -64, 4160)) == 2
    assert abs(vt.area(vt.cut_ring([(-500.0, -500.0), (500.0, -500.0), (500.0, 500.0), (-500.0, 500.0)], -64, 4160))) == 564**2
    assert vt.vector_tiles(df.where("false"), F.lit(12)).count() == 0


def hilbert(z, x, y):
    d, s = 0, (1 << z) >> 1
    while s:
        rx, ry = int(bool(x & s)), int(bool(y & s))
        d += s * s * (3 * rx ^ ry)
        if not ry:
            if rx:
                x, y = s - 1 - (x & (s - 1)), s - 1 - (y & (s - 1))
            x, y = y, x
        s >>= 1
    return (4**z - 1) // 3 + d


def test_tile_numbers(spark):
    rows = [(0, 0, 0), (1, 0, 0), (1, 0, 1), (1, 1, 1), (1, 1, 0), (2, 0, 0), (12, 3423, 1763), (17, 70997, 37696), (30, (1 << 30) - 1, 12345)]
    found = spark.createDataFrame(rows, "z int, x int, y int").select(archive.tile_number(F.col("z"), F.col("x"), F.col("y"))).collect()
    assert [r[0] for r in found] == [hilbert(*r) for r in rows]
    assert [r[0] for r in found[:7]] == [0, 1, 2, 3, 4, 5, 19078479]


def test_archive(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "ROOT_END", 400)
    tiles = [(6, x, y, b"sea" if x % 2 else f"{x}:{y}".encode()) for x in range(64) for y in range(64)]
    df = spark.createDataFrame([*tiles, (6, 0, 0, b""), (6, 0, 0, None)], "z int, x int, y int, data binary")
    path = str(tmp_path / "a.pmtiles")
    assert archive.write_archive(df, path, about={"name": "t"}) == len(tiles)
    data = open(path, "rb").read()
    assert data[:8] == b"PMTiles\x03"
    root, root_n, text, text_n, leaf, leaf_n, body, body_n, addressed, entries, contents = struct.unpack_from("<11Q", data, 8)
    assert (addressed, contents, body + body_n, root_n <= 400 - 127, leaf_n > 0) == (len(tiles), 64 * 32 + 1, len(data), True, True)
    assert gzip.decompress(data[text : text + text_n]) == b'{"name": "t"}'

    def listed(start, length):
        raw = elements.packed(gzip.decompress(data[start : start + length])).tolist()
        n, raw = raw[0], raw[1:]
        tile = offset = 0
        previous = None
        for i in range(n):
            tile += raw[i]
            run, size, given = raw[n + i], raw[2 * n + i], raw[3 * n + i]
            offset = previous if given == 0 else given - 1
            previous = offset + size
            yield tile, offset, size, run

    held, count = {}, 0
    for _, at, size, run in listed(root, root_n):
        assert run == 0
        for tile, offset, length, times in listed(leaf + at, size):
            count += 1
            held.update({tile + k: data[body + offset : body + offset + length] for k in range(times)})
    assert count == entries
    assert held == {hilbert(z, x, y): d for z, x, y, d in tiles}
    assert archive.write_archive(df.where("false"), path) == 0


def test_uploads(spark, tmp_path):
    for side, held in (("a", {"x/1.txt": "1", "2.txt": "2", "3.txt": "3"}), ("b", {"x/1.txt": "1", "2.txt": "other"})):
        for name, value in held.items():
            (tmp_path / side / name).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / side / name).write_text(value)
    here, there = (archive.checksums(spark, str(tmp_path / s)) for s in "ab")
    assert sorted(r["name"] for r in archive.to_upload(here, there).collect()) == ["2.txt", "3.txt"]
    assert archive.to_upload(here, here).count() == 0 and "x/1.txt" in {r["name"] for r in here.collect()}


def test_ranges(spark):
    rows = [("bytes=0-9",), ("bytes=90-",), ("bytes=95-200",), ("bytes=100-",), ("bytes=-5",), ("bytes=9-5",), ("rows=1-2",), ("bytes=a-b",), (None,)]
    found = spark.createDataFrame(rows, "h string").select(files.requested_range(F.col("h"), F.lit(100).cast("long")).alias("r")).select("r.*").collect()
    assert [tuple(r) for r in found] == [
        (206, 0, 9), (206, 90, 99), (206, 95, 99), (416, None, None), (206, 0, 5), (416, None, None), (400, None, None), (500, None, None), (200, 0, 99)]


def test_spheroid(spark):
    # A published pair of survey points on GRS 80, a quarter meridian piece and an equator piece of WGS 84.
    dms = lambda d, m, s: math.copysign(abs(d) + m / 60 + s / 3600, d)
    rows = [(dms(144, 25, 29.5244), dms(-37, 57, 3.7203), dms(143, 55, 35.3839), dms(-37, 39, 10.1561))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    columns = [F.col(c) for c in "abcd"]
    assert df.select(geo.spheroid_distance(*columns, flattening=1 / 298.257222101)).first()[0] == pytest.approx(54972.271, abs=0.002)
    places = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (15.0, 60.0, 15.0, 60.0), (0.0, 0.0, 0.0, 90.0), (15.0, 60.0, 15.0001, 60.0001)], "a double, b double, c double, d double")
    found = [r[0] for r in places.select(geo.spheroid_distance(*columns)).collect()]
    assert found[0] == pytest.approx(6378137 * math.pi / 180, abs=1e-3) and found[1] == 0.0
    assert found[2] == pytest.approx(10001965.729, abs=0.01) and found[3] == pytest.approx(12.46, abs=0.05)
    probes = spark.createDataFrame([(1, 15.0, 60.0)], "probe_id long, lon double, lat double")
    known = spark.createDataFrame([(7, 15.0001, 60.0001), (8, 15.0, 61.0)], "known_id long, lon double, lat double")
    near = spatial.nearest_within(probes, known, 15.0, distance=geo.spheroid_distance).collect()
    assert [(r.known_id, round(r.metres, 6)) for r in near] == [(7, round(found[3], 6))]


def test_crossings(spark):
    line = F.array(*[F.struct(F.lit(a).alias("lon"), F.lit(b).alias("lat")) for a, b in ((0.0, 0.0), (0.0, 2.0), (2.0, 2.0))])
    track = spark.createDataFrame([(1, 0, -1.0, 1.0), (1, 1, 1.0, 1.0), (1, 2, 1.0, 1.5), (1, 3, 1.0, 3.0), (2, 0, -1.0, 5.0), (2, 1, 1.0, 5.0)], "track_id int, at int, lon double, lat double")
    assert [(r.track_id, r["at"]) for r in spatial.crossings(track, line).collect()] == [(1, 1), (1, 3)]


def test_rasters_keep_cells_and_places(spark, tmp_path):
    wanted = {("a", r, c): r * 100.0 + c + 0.5 for r in range(40) for c in range(53) if (r * 53 + c) % 5} | {("b", 0, 0): 7.0, ("b", 0, 1): None}
    rows = [(t, 40 if t == "a" else 1, 53 if t == "a" else 2, r, c, 5000.0 if t == "a" else 0.0, 900.0, v) for (t, r, c), v in wanted.items()]
    cells = spark.createDataFrame(rows, "tile string, rows int, cols int, row int, col int, x0 double, y1 double, v double")
    folder = f"file://{tmp_path}/out"
    assert rasters.write_files(rasters.raster_files(cells, "v", side=16, res=2.0), folder) == 2
    meta = {r.tile: r for r in rasters.raster_meta(spark, folder).collect()}
    a = meta["a"]
    assert (a.cols, a.rows, a.kind, a.nodata, a.epsg, a.west, a.south, a.east, a.north) == (53, 40, "<f4", -9999.0, 3006, 5000.0, 820.0, 5106.0, 900.0)
    got = rasters.raster_cells(spark, folder).collect()
    assert {(r.tile, r.row, r.col): r.v for r in got} == {k: v for k, v in wanted.items() if v is not None} and len(got) == len(wanted) - 1
    box = (5010.0, 850.0, 5030.0, 870.0)
    part = rasters.raster_cells(spark, folder, box).collect()
    assert {(r.row, r.col) for r in part} == {(r.row, r.col) for r in got if 5010 <= r.x <= 5030 and 850 <= r.y <= 870} and len(part) > 50
    assert rasters.write_files(rasters.raster_files(cells.where("false"), "v"), folder) == 0


def strips(order, kind, grid, packing, predictor, rows_each):
    """A striped file made by hand."""
    parts = []
    for k in range(0, len(grid), rows_each):
        part = grid[k : k + rows_each].astype(order + kind)
        if predictor == 2:
            part = np.concatenate([part[:, :1], np.diff(part, axis=1)], axis=1).astype(order + kind)
        data = part.tobytes()
        if predictor == 3:
            planes = part.astype(">" + kind).view(np.uint8).reshape(*part.shape, -1).transpose(0, 2, 1).reshape(len(part), -1)
            data = np.concatenate([planes[:, :1], np.diff(planes, axis=1)], axis=1).astype(np.uint8).tobytes()
        parts.append(zlib.compress(data) if packing == 8 else data)
    n = len(parts)
    at = np.cumsum([8, *map(len, parts)])
    lists = int(at[-1])
    tags = [(256, 4, 1, grid.shape[1]), (257, 4, 1, grid.shape[0]), (258, 4, 1, int(kind[1]) * 8), (259, 4, 1, packing), (273, 4, n, lists), (278, 4, 1, rows_each), (279, 4, n, lists + 4 * n),
            (317, 4, 1, predictor), (339, 4, 1, {"u": 1, "i": 2, "f": 3}[kind[0]])]
    pack = lambda f, *v: struct.pack(order + f, *v)
    ends = b"".join(pack("I", int(v)) for v in [*at[:-1], *map(len, parts)])
    table = pack("H", len(tags)) + b"".join(pack("HHII", *t) for t in tags) + pack("I", 0)
    return (b"II" if order == "<" else b"MM") + pack("HI", 42, lists + 8 * n) + b"".join(parts) + ends + table


@pytest.mark.parametrize(("order", "kind", "packing", "predictor"), [("<", "u1", 1, 1), (">", "i2", 8, 2), (">", "f4", 1, 1), ("<", "f4", 8, 3), ("<", "u2", 8, 2)])
def test_rasters_of_others(spark, tmp_path, order, kind, packing, predictor):
    grid = (np.arange(7 * 9).reshape(7, 9) * 3 % 200).astype(kind)
    (tmp_path / "made.tif").write_bytes(strips(order, kind, grid, packing, predictor, 3))
    got = rasters.raster_cells(spark, str(tmp_path)).collect()
    assert {(r.row, r.col): r.v for r in got} == {(r, c): float(grid[r, c]) for r in range(7) for c in range(9)}


def test_files_that_are_no_rasters(tmp_path):
    (tmp_path / "x.tif").write_bytes(b"II*")
    with pytest.raises((ValueError, struct.error)):
        rasters.described(str(tmp_path / "x.tif"))
    (tmp_path / "y.tif").write_bytes(b"no raster at all")
    with pytest.raises(ValueError, match="not a TIFF"):
        rasters.described(str(tmp_path / "y.tif"))
