"""Map elements (nodes, ways, relations) from the public binary exchange format, as a Python data source.

A file is a row of blobs, each with a small header.  Planning reads the headers only and deals
the blobs out in portions of about ``portion`` bytes; every portion is a partition that can be
read again alone.  Numbers are decoded in bulk with numpy, rows leave as Arrow batches.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "kind string, id long, seq long, lon double, lat double, tags map<string,string>, refs array<long>, members array<struct<type:string,ref:long,role:string>>"
#: Fixed values of the format: member kinds in order.
MEMBER_KINDS = ("n", "w", "r")
_TEXTS = pa.map_(pa.string(), pa.string())
_MEMBERS = pa.list_(pa.struct([("type", pa.string()), ("ref", pa.int64()), ("role", pa.string())]))
_ARROW = pa.schema([("kind", pa.string()), ("id", pa.int64()), ("seq", pa.int64()), ("lon", pa.float64()), ("lat", pa.float64()), ("tags", _TEXTS), ("refs", pa.list_(pa.int64())), ("members", _MEMBERS)])


def varint(data, at: int) -> tuple[int, int]:
    """A base-128 number and the position behind it."""
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def fields(data) -> Iterator[tuple[int, int | memoryview]]:
    """(number, value) of a message's fields: whole numbers, or the bytes of the others."""
    data, at = memoryview(data), 0
    while at < len(data):
        key, at = varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = varint(data, at)
        elif kind == 2:
            size, at = varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"field of unknown kind {kind}")
        yield key >> 3, value


def packed(data, signed: bool = False) -> np.ndarray:
    """All numbers of a packed field; signed ones are folded."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    values = np.add.reduceat((raw & 127).astype(np.uint64) << (7 * place).astype(np.uint64), starts)
    return unfold(values) if signed else values.astype(np.int64)


def unfold(values: np.ndarray) -> np.ndarray:
    """Signed numbers of folded ones (0, -1, 1, -2, ...)."""
    return (values >> np.uint64(1)).astype(np.int64) ^ -(values & np.uint64(1)).astype(np.int64)


def _one(value: int) -> int:
    return (value >> 1) ^ -(value & 1)


def _number(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def unpack_blob(blob) -> bytes:
    for number, value in fields(blob):
        if number == 1:
            return bytes(value)
        if number == 3:
            return zlib.decompress(value)
        if number == 7:
            import zstandard

            return zstandard.ZstdDecompressor().decompressobj().decompress(bytes(value))
        if number in (4, 5, 6):
            raise ValueError(f"blob compression {number} isn't supported")
    raise ValueError("blob without data")


class _Block:
    """One block's elements as rows."""

    def __init__(self, data: bytes, first: int):
        self.first, self.texts, self.groups = first, [], []
        self.step, self.lat0, self.lon0 = 100, 0, 0
        for number, value in fields(data):
            if number == 1:
                self.texts = [bytes(t).decode() for n, t in fields(value) if n == 1]
            elif number == 2:
                self.groups.append(value)
            elif number == 17:
                self.step = value
            elif number == 19:
                self.lat0 = _number(value)
            elif number == 20:
                self.lon0 = _number(value)

    def tags(self, keys, values) -> list[tuple[str, str]]:
        return list({self.texts[k]: self.texts[v] for k, v in zip(keys, values, strict=True)}.items())

    def degrees(self, lon, lat):
        return (self.lon0 + self.step * lon) / 1e9, (self.lat0 + self.step * lat) / 1e9

    def rows(self, kinds: set[str]) -> Iterator[dict]:
        n = self.first
        for group in self.groups:
            for number, value in fields(group):
                made = {1: self.node, 2: self.dense, 3: self.way, 4: self.relation}.get(number)
                kind = {1: "n", 2: "n", 3: "w", 4: "r"}.get(number)
                if made and kind in kinds:
                    for row in made(value):
                        yield {"kind": kind, "seq": n, **row}
                        n += 1

    def node(self, data) -> Iterator[dict]:
        f = dict(fields(data))
        lon, lat = self.degrees(_one(f.get(9, 0)), _one(f.get(8, 0)))
        yield {"id": _one(f.get(1, 0)), "lon": lon, "lat": lat, "tags": self.tags(packed(f.get(2, b"")), packed(f.get(3, b"")))}

    def dense(self, data) -> Iterator[dict]:
        f = dict(fields(data))
        ids, lats, lons = (np.cumsum(packed(f.get(k, b""), signed=True)) for k in (1, 8, 9))
        lon, lat = self.degrees(lons, lats)
        pairs, at = packed(f.get(10, b"")).tolist(), 0
        for i in range(len(ids)):
            end = pairs.index(0, at) if at < len(pairs) else at
            yield {"id": int(ids[i]), "lon": float(lon[i]), "lat": float(lat[i]), "tags": self.tags(pairs[at:end:2], pairs[at + 1 : end : 2])}
            at = end + 1

    def way(self, data) -> Iterator[dict]:
        f = dict(fields(data))
        yield {"id": _number(f.get(1, 0)), "tags": self.tags(packed(f.get(2, b"")), packed(f.get(3, b""))), "refs": np.cumsum(packed(f.get(8, b""), signed=True)).tolist()}

    def relation(self, data) -> Iterator[dict]:
        f = dict(fields(data))
        refs = np.cumsum(packed(f.get(9, b""), signed=True)).tolist()
        members = [{"type": MEMBER_KINDS[k], "ref": r, "role": self.texts[s]} for k, r, s in zip(packed(f.get(10, b"")), refs, packed(f.get(8, b"")), strict=True)]
        yield {"id": _number(f.get(1, 0)), "tags": self.tags(packed(f.get(2, b"")), packed(f.get(3, b""))), "members": members}


def _open(path: str):
    from pyarrow import fs

    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path.removeprefix("file:"))
    system, plain = fs.FileSystem.from_uri(path)
    return system.open_input_file(plain)


class Portion(InputPartition):
    def __init__(self, blobs: list[tuple[int, int, int]]):
        super().__init__(blobs)


class ElementReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.portion = options["path"], int(options.get("portion", 32 << 20))
        self.kinds = set(options.get("kinds", "n,w,r").split(","))

    def partitions(self) -> list[Portion]:
        found, group, held, at, k = [], [], 0, 0, 0
        with _open(self.path) as file:
            size = file.size()
            while at < size:
                file.seek(at)
                (length,) = struct.unpack(">I", file.read(4))
                head = dict(fields(file.read(length)))
                at += 4 + length
                if bytes(head[1]) == b"OSMData":
                    group.append((k, at, head[3]))
                    held += head[3]
                    k += 1
                at += head[3]
                if held >= self.portion:
                    found.append(Portion(group))
                    group, held = [], 0
        if group or not found:
            found.append(Portion(group))
        return found

    def read(self, partition: Portion) -> Iterator[pa.RecordBatch]:
        if not partition.value:
            return
        with _open(self.path) as file:
            for k, at, size in partition.value:
                file.seek(at)
                rows = list(_Block(unpack_blob(file.read(size)), k << 32).rows(self.kinds))
                for i in range(0, len(rows), 4096):
                    yield pa.RecordBatch.from_pylist(rows[i : i + 4096], schema=_ARROW)


class Elements(DataSource):
    """``spark.read.format("map_elements").option("kinds", "w,r").load(path)``; ``seq`` is the order in the file."""

    @classmethod
    def name(cls) -> str:
        return "map_elements"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ElementReader:
        return ElementReader(self.options)


def elements(spark: SparkSession, path: str, kinds: str = "n,w,r") -> DataFrame:
    """Elements of a file: ``kind`` (n, w or r), ``id``, ``seq``, place, tags, refs, members; fields of other kinds are null."""
    spark.dataSource.register(Elements)
    return spark.read.format("map_elements").option("kinds", kinds).load(path)
