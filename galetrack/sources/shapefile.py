"""Shapefiles as a Spark data source.

``spark.read.format("shapefile").load("land.shp")`` gives a row for each record. The
index file splits the records over tasks by their offsets; without one the records'
lengths are walked through once. Each task opens the file, reads its records only, and
drops those whose box the filters exclude before it decodes any point.

Rows: record (from 0), shape ('null', 'point', 'line', 'polygon', 'points'), the box xmin,
ymin, xmax, ymax, parts (arrays of x, y) and attributes (by field name, trimmed, empty as
null). Heights and measures are left out. With the option ``pushdown`` filters on the box
columns are taken (:func:`read` sets it where ``spark.sql.python.filterPushdown.enabled``
is set); the option ``box`` ("west,
south, east, north": records whose box meets it) always is.

Defined results: null shapes have no box and no parts; deleted table rows keep their
attributes; without a table there are none; a ``.prj`` that is projected or isn't WGS 84
is refused, and without one degrees are assumed; a broken header is an error.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from galetrack.functions.workers import importable

SCHEMA = (
    "record int, shape string, xmin double, ymin double, xmax double, ymax double,"
    " parts array<array<struct<x: double, y: double>>>, attributes map<string, string>"
)
#: Shape types; tens are those with heights or measures.
SHAPES = {0: "null", 1: "point", 3: "line", 5: "polygon", 8: "points"}
MAGIC, HEADER = 9994, 100
BOX = ("xmin", "ymin", "xmax", "ymax")
_TESTS = {LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b}


class ShapefileError(ValueError):
    """A file that isn't a shapefile, or whose positions aren't degrees on WGS 84."""


class Files:
    """The parts of a shapefile, in any file system that Arrow knows."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.system, self.path = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    def open(self, kind: str = "shp"):
        return self.system.open_input_file(f"{self.path[:-3]}{kind}")

    def has(self, kind: str) -> bool:
        from pyarrow import fs

        return self.system.get_file_info(f"{self.path[:-3]}{kind}").type == fs.FileType.File


def offsets(files: Files) -> list[int]:
    """Where each record begins."""
    with files.open() as f:
        head = f.read(HEADER)
        if len(head) < HEADER or struct.unpack(">i", head[:4])[0] != MAGIC:
            raise ShapefileError(f"{files.path} is no shapefile")
        end = 2 * struct.unpack(">i", head[24:28])[0]
        if files.has("shx"):
            with files.open("shx") as x:
                return (np.frombuffer(x.read()[HEADER:], dtype=">i4").reshape(-1, 2)[:, 0].astype(np.int64) * 2).tolist()
        out, at = [], HEADER
        while at + 8 <= end:
            out.append(at)
            f.seek(at)
            at += 8 + 2 * struct.unpack(">ii", f.read(8))[1]
        return out


def check_positions(files: Files) -> None:
    if files.has("prj"):
        with files.open("prj") as f:
            text = f.read().decode("latin-1").upper()
        if "PROJCS" in text or "PROJCRS" in text or not any(n in text for n in ("WGS_1984", "WGS 84", "WGS84")):
            raise ShapefileError(f"{files.path}: positions must be degrees on WGS 84")


def fields(table) -> tuple[int, int, list[tuple[str, int]]]:
    """Length of a table's head, of a row, and its fields with their widths."""
    head = table.read(32)
    start, width = struct.unpack("<HH", head[8:12])
    out = []
    for _ in range((start - 33) // 32):
        one = table.read(32)
        if one[0] == 0x0D:
            break
        out.append((one[:11].split(b"\0")[0].decode("latin-1"), one[16]))
    return start, width, out


def decode(content: bytes, meets) -> tuple | None:
    """shape, box and parts of a record; None if its box isn't wanted."""
    kind = SHAPES.get(struct.unpack("<i", content[:4])[0] % 10)
    if kind is None:
        raise ShapefileError(f"unknown shape type {struct.unpack('<i', content[:4])[0]}")
    if kind == "null":
        return (kind, None, None, None, None, None) if meets is None else None
    if kind == "point":
        x, y = struct.unpack("<dd", content[4:20])
        return (kind, x, y, x, y, [[(x, y)]]) if meets is None or meets((x, y, x, y)) else None
    box = struct.unpack("<4d", content[4:36])
    if meets is not None and not meets(box):
        return None
    if kind == "points":
        n, begin, at = struct.unpack("<i", content[36:40])[0], [0], 40
    else:
        k, n = struct.unpack("<ii", content[36:44])
        begin, at = struct.unpack(f"<{k}i", content[44 : 44 + 4 * k]), 44 + 4 * k
    points = list(map(tuple, np.frombuffer(content, dtype="<f8", count=2 * n, offset=at).reshape(n, 2).tolist()))
    return (kind, *box, [points[a:z] for a, z in zip(begin, [*begin[1:], n])])


class Records(InputPartition):
    def __init__(self, first: int, begin: list[int]):
        self.first, self.begin = first, begin


class ShapefileReader(DataSourceReader):
    def __init__(self, options):
        self.path = options.get("path")
        self.share = int(options.get("records", 2048))
        self.encoding = options.get("encoding", "UTF-8")
        self.tests: list[tuple[int, type, float]] = []
        if options.get("box"):
            west, south, east, north = map(float, options["box"].split(","))
            self.tests = [(0, LessThanOrEqual, east), (1, LessThanOrEqual, north), (2, GreaterThanOrEqual, west), (3, GreaterThanOrEqual, south)]

    def partitions(self):
        files = Files(self.path)
        check_positions(files)
        begin = offsets(files)
        return [Records(a, begin[a : a + self.share]) for a in range(0, len(begin), self.share)] or [Records(0, [])]

    def read(self, partition) -> Iterator[tuple]:
        files, tests = Files(self.path), self.tests
        meets = (lambda box: all(_TESTS[kind](box[i], value) for i, kind, value in tests)) if tests else None
        table = files.open("dbf") if files.has("dbf") else None
        start, width, names = fields(table) if table else (0, 0, [])
        with files.open() as shapes:
            for i, at in enumerate(partition.begin):
                shapes.seek(at)
                found = decode(shapes.read(2 * struct.unpack(">ii", shapes.read(8))[1]), meets)
                if found is None:
                    continue
                values = {}
                if table:
                    table.seek(start + width * (partition.first + i))
                    row, x = table.read(width), 1
                    for name, size in names:
                        values[name] = row[x : x + size].decode(self.encoding, "replace").strip(" \0") or None
                        x += size
                yield (partition.first + i, *found, values)


class PushedReader(ShapefileReader):
    """The same where Spark hands filters down; it refuses a reader that takes them otherwise."""

    def pushFilters(self, filters):
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in BOX:
                self.tests.append((BOX.index(f.attribute[0]), type(f), float(f.value)))
            else:
                yield f


class ShapefileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (PushedReader if self.options.get("pushdown") == "true" else ShapefileReader)(self.options)


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    """The records of a shapefile."""
    importable(spark)
    spark.dataSource.register(ShapefileSource)
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("shapefile").options(pushdown=pushed, **options).load(path)


def read_land(spark: SparkSession, path: str, names: dict[str, str], **options) -> tuple[DataFrame, DataFrame]:
    """(units, edges) of the polygons, as of GeoJSON; units are numbered by record."""
    rows = read(spark, path, **options)
    units = rows.select(F.col("record").alias("unit_id"), *[F.element_at("attributes", F.lit(v)).alias(k) for k, v in names.items()])
    rings = rows.where("shape = 'polygon'").select(F.col("record").alias("unit_id"), F.explode("parts").alias("ring")).where("size(ring) >= 3")
    turn = F.transform(F.sequence(F.lit(1), F.size("ring")), lambda i: F.struct(F.element_at("ring", i).alias("a"), F.element_at("ring", F.when(i == F.size("ring"), 1).otherwise(i + 1)).alias("b")))
    edges = rings.select("unit_id", F.explode(turn).alias("e")).select("unit_id", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))
    return units, edges.where("x1 != x2 or y1 != y2")


def read_gates(spark: SparkSession, path: str, **options) -> DataFrame:
    """Gates from lines: fields gate_id, gate_name and region; a line's ends are its first and last point."""
    rows = read(spark, path, **options).where("shape = 'line'")
    whole, field = F.flatten("parts"), lambda n: F.element_at("attributes", F.lit(n)).alias(n)
    first, last = F.element_at(whole, 1), F.element_at(whole, -1)
    return rows.select(field("gate_id"), field("gate_name"), field("region"), F.col("record").alias("sort_order"), first["x"].alias("x1"), first["y"].alias("y1"), last["x"].alias("x2"), last["y"].alias("y2"))
