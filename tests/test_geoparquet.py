"""Well-known binary against struct, GeoParquet files against Arrow's own reader."""

import json
import math
import random
import struct

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from galetrack.functions import wkb
from galetrack.operators import rings
from galetrack.sources import geoparquet as geo

NUMBERS = [0.0, -0.0, 1.0, -1.0, 0.1, 2.0, 3.999999999999999, 4.0, 180.0, -179.99999999999997, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf, 1e-7, 2.0**-1022, 2.0**1023]
RINGS = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (1.5, 1.0), (1.0, 1.25), (1.0, 1.0)]]


def ring(points, end):
    return struct.pack(end + "I", len(points)) + b"".join(struct.pack(end + "dd", *p) for p in points)


def binary(kind, value, end=">"):
    head = struct.pack(end + "BI", end == "<", kind)
    if kind == wkb.POINT:
        return head + struct.pack(end + "dd", *value)
    if kind == wkb.LINE:
        return head + ring(value, end)
    if kind == wkb.POLYGON:
        return head + struct.pack(end + "I", len(value)) + b"".join(ring(r, end) for r in value)
    return head + struct.pack(end + "I", len(value)) + b"".join(binary(wkb.POLYGON, p, end) for p in value)


def test_bits(spark):
    numbers = NUMBERS + [random.Random(1).uniform(-180, 180) for _ in range(300)] + [s * math.nextafter(2.0**e, d) for e in range(-60, 60) for d in (-math.inf, math.inf) for s in (1, -1)] + [2.0**e for e in range(-1022, 1024)]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)] + [(-1, None), (-2, math.nan)], "i int, n double")
    got = {r[0]: r[1] for r in rows.select("i", wkb.bits(F.col("n"))).collect()}
    assert got.pop(-1) is None
    assert got.pop(-2) == 0x7FF8000000000000
    assert [got[i] for i in range(len(numbers))] == [struct.unpack(">q", struct.pack(">d", n))[0] for n in numbers]


def test_both_ways(spark):
    spots, poly = "array<struct<x: double, y: double>>", [RINGS, RINGS[:1]]
    rows = spark.createDataFrame([(1.5, -2.25, RINGS[0], RINGS, poly), (None, 1.0, [], [], []), (1.0, 1.0, None, None, None), (-0.0, 1e-300, [(None, 1.0)], [[]], [[]])], f"x double, y double, l {spots}, p array<{spots}>, m array<array<{spots}>>")
    made = rows.select(wkb.point(F.col("x"), F.col("y")).alias("x"), wkb.line(F.col("l")).alias("l"), wkb.polygon(F.col("p")).alias("p"), wkb.polygons(F.col("m")).alias("m"))
    one, empty, null, partial = [[None if v is None else bytes(v) for v in r] for r in made.collect()]
    assert one == [binary(1, (1.5, -2.25)), binary(2, RINGS[0]), binary(3, RINGS), binary(6, poly)]
    assert empty == [None] * 4
    assert null == [binary(1, (1.0, 1.0)), None, None, None]
    assert partial == [binary(1, (-0.0, 1e-300)), None, None, None]
    for end in "><":
        given = [(k, bytearray(binary(k, v, end))) for k, v in ((1, (1.5, -1e-300)), (2, RINGS[0]), (3, RINGS), (6, poly))] + [(0, None)]
        back = spark.createDataFrame(given, "k int, g binary").select("k", wkb.kind(F.col("g")), wkb.as_point(F.col("g")), wkb.as_line(F.col("g")), wkb.as_polygon(F.col("g")), wkb.as_polygons(F.col("g"))).collect()
        plain = lambda v: tuple(v) if hasattr(v, "x") else [plain(e) for e in v]
        for k, seen, *values in back:
            assert (seen or 0) == k
            want = {1: (1.5, -1e-300), 2: RINGS[0], 3: RINGS, 6: poly}
            for own, v in zip((1, 2, 3, 6), values):
                assert v is None if own != k else plain(v) == want[k]


def test_files(spark, tmp_path, capsys):
    path = str(tmp_path / "points")
    rng = random.Random(5)
    spots = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(4000)] + [(-1, None, 3.0)]
    rows = spark.createDataFrame(spots, "i int, lon double, lat double")
    geo.write(geo.point(rows, "lon", "lat"), path, files=4, group_rows=100)
    files = sorted((tmp_path / "points").glob("*"))
    assert len(files) == 4 and all(f.suffix == ".parquet" for f in files)
    meta = [json.loads(pq.read_metadata(f).metadata[b"geo"]) for f in files]
    assert all(m["version"] == "1.1.0" and m["columns"]["geometry"]["covering"]["bbox"]["xmin"] == ["bbox", "xmin"] for m in meta)
    assert {tuple(m["columns"]["geometry"]["geometry_types"]) for m in meta} == {("Point",)}
    back = geo.read(spark, path)
    assert sorted((r[0], r[1], r[2]) for r in back.select("i", "lon", "lat").collect() if r[0] >= 0) == sorted(spots[:-1])
    assert back.where("i = -1").select("geometry", "bbox").first() == (None, None)
    box = (-100.0, 10.0, -70.0, 30.0)
    inside = geo.read(spark, path, box)
    assert {r[0] for r in inside.select("i").collect()} == {i for i, x, y in spots[:-1] if -100 <= x <= -70 and 10 <= y <= 30}
    capsys.readouterr()
    inside.explain("formatted")
    pushed = next(line for line in capsys.readouterr().out.splitlines() if line.startswith("PushedFilters"))
    assert all(f"bbox.{c}" in pushed for c in geo.BOX)
    # Row groups are compact, so most lie outside the box.
    met = groups = 0
    for f in files:
        for g in range((m := pq.read_metadata(f)).num_row_groups):
            stats = {m.row_group(g).column(c).path_in_schema: m.row_group(g).column(c).statistics for c in range(m.num_columns)}
            groups += 1
            met += stats["bbox.xmin"].min <= box[2] and stats["bbox.xmax"].max >= box[0] and stats["bbox.ymin"].min <= box[3] and stats["bbox.ymax"].max >= box[1]
    assert groups >= 40 and met <= groups / 3
    # Replaced, with lines; what was there goes.
    lines = geo.line(rows.where("lon is not null").groupBy((F.col("i") % 50).alias("k")).agg(F.array_sort(F.collect_list(F.struct("i", F.col("lon").alias("x"), F.col("lat").alias("y")))).alias("s")), F.transform("s", lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y"))))
    geo.write(lines, path, files=2)
    again = geo.read(spark, path).select("k", wkb.as_line(F.col("geometry")).alias("l"), "bbox").collect()
    assert len(again) == 50
    for k, spots_, b in again:
        own = [(x, y) for i, x, y in spots[:-1] if i % 50 == k]
        assert [tuple(s) for s in spots_] == own and b["xmin"] == min(x for x, _ in own) and b["ymax"] == max(y for _, y in own)
    assert geo.described(path)["columns"]["geometry"]["geometry_types"] == ["LineString"]


def test_polygons_of_rings(spark):
    # Two outer rings, the second with two holes; one hole's box lies in both outer boxes.
    def edges(ring, hole, x, y, size):
        at = [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]
        at = at[::-1] if hole else at
        return [(7, ring, hole, i, *at[i], *at[(i + 1) % 4]) for i in range(4)]

    rows = edges(1, False, 20.0, 0.0, 3.0) + edges(2, False, 0.0, 0.0, 10.0) + edges(3, True, 1.0, 1.0, 1.0) + edges(4, True, 5.0, 5.0, 2.0) + edges(5, False, 0.5, 0.5, 0.25)
    made = rings.closed(spark.createDataFrame(rows, "k int, ring int, is_hole boolean, place int, x1 double, y1 double, x2 double, y2 double"), "k").first()["parts"]
    assert [[len(r) for r in p] for p in made] == [[5], [5, 5, 5], [5]]
    assert all(r[0] == r[-1] for p in made for r in p)
    assert tuple(made[1][1][0]) == (1.0, 2.0) and tuple(made[1][2][0]) == (5.0, 7.0)


def test_lost_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).select(F.col("id").cast("double").alias("lon"), F.lit(1.0).alias("lat"))
    geo.write(geo.point(rows, "lon", "lat"), path, files=2)
    before = sorted(f.name for f in (tmp_path / "t").iterdir())
    broken = rows.withColumn("c", F.when(F.col("lon") == 9, F.raise_error(F.lit("broken"))).otherwise(F.lit("")))
    with pytest.raises(Exception, match="broken"):
        geo.write(geo.point(broken, "lon", "lat"), path, files=2)
    assert sorted(f.name for f in (tmp_path / "t").iterdir()) == before
    assert geo.read(spark, path).count() == 10


def test_without_geometry(spark, tmp_path):
    empty = spark.createDataFrame([], "i int, lon double, lat double")
    none = spark.createDataFrame([(1, None, 2.0)], "i int, lon double, lat double")
    for name, rows, n in (("empty", empty, 0), ("none", none, 1)):
        geo.write(geo.point(rows, "lon", "lat"), str(tmp_path / name))
        back = geo.read(spark, str(tmp_path / name))
        assert back.columns == ["i", "lon", "lat"] and back.count() == n
        with pytest.raises(ValueError):
            geo.read(spark, str(tmp_path / name), (0.0, 0.0, 1.0, 1.0))
