"""The shapefile source against files written byte by byte here, and against GeoJSON."""

import json
import struct

import pytest

from galetrack.sources import shapefile, tables


def write(path, records, rows=(), names=(), index=True, prj=None):
    """``records``: None, (x, y), or (type, parts)."""
    body, places = b"", []
    for i, r in enumerate(records):
        if r is None:
            content = struct.pack("<i", 0)
        elif not isinstance(r[1], list):
            content = struct.pack("<idd", 1, *r)
        else:
            kind, parts = r
            points = [p for part in parts for p in part]
            xs, ys = [p[0] for p in points], [p[1] for p in points]
            starts = [sum(len(q) for q in parts[:k]) for k in range(len(parts))]
            content = struct.pack("<i4d", kind, min(xs), min(ys), max(xs), max(ys)) + struct.pack("<ii", len(parts), len(points)) + struct.pack(f"<{len(parts)}i", *starts)
            content += b"".join(struct.pack("<dd", *p) for p in points)
            if kind == 15:  # heights follow
                content += struct.pack("<dd", 0, 0) + struct.pack(f"<{len(points)}d", *[0.0] * len(points))
        places.append((100 + len(body), len(content)))
        body += struct.pack(">ii", i + 1, len(content) // 2) + content
    head = lambda size: struct.pack(">i5ii", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<ii", 1000, 5) + b"\0" * 64
    path.write_bytes(head(100 + len(body)) + body)
    if index:
        path.with_suffix(".shx").write_bytes(head(100 + 8 * len(records)) + b"".join(struct.pack(">ii", a // 2, n // 2) for a, n in places))
    if names:
        cells = [(n.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([12]) + b"\0" * 15) for n in names]
        data = b"".join(b" " + b"".join(v.encode().ljust(12) for v in row) for row in rows)
        path.with_suffix(".dbf").write_bytes(struct.pack("<4BIHH20x", 3, 0, 0, 0, len(rows), 33 + 32 * len(names), 1 + 12 * len(names)) + b"".join(cells) + b"\r" + data)
    if prj:
        path.with_suffix(".prj").write_text(prj)


def square(x, y, size=1.0):
    return [(x, y), (x, y + size), (x + size, y + size), (x + size, y), (x, y)]


LAND = [(5, [square(0.0, 0.0, 4.0), square(1.0, 1.0)[::-1]]), None, (15, [square(10.0, 0.0)]), (5, [square(20.0, 5.0), square(22.0, 5.0)])]
ROWS = [("Ödland", "US"), ("Nothing", ""), ("High", "MX"), ("Two", "US")]


@pytest.mark.parametrize("index", [True, False])
def test_as_from_geojson(spark, tmp_path, index):
    write(tmp_path / "land.shp", LAND, ROWS, ("name", "iso"), index, 'GEOGCS["WGS 84"]')
    features = [{"type": "Feature", "properties": {"name": n, "iso": i or None}, "geometry": None if r is None else {"type": "MultiPolygon", "coordinates": [[ring] for ring in r[1]]}} for r, (n, i) in zip(LAND, ROWS)]
    (tmp_path / "land.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    names = {"admin1_name": "name", "iso_country": "iso"}
    mine, theirs = shapefile.read_land(spark, str(tmp_path / "land.shp"), names, records=2), tables.read_geojson(spark, str(tmp_path / "land.json"), names)
    for a, b in zip(mine, theirs):
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_rows_and_boxes(spark, tmp_path):
    write(tmp_path / "a.shp", [*LAND, (7.5, 8.5)])
    path = str(tmp_path / "a.shp")
    rows = {r["record"]: r for r in shapefile.read(spark, path, records=2).collect()}
    assert [rows[i]["shape"] for i in range(5)] == ["polygon", "null", "polygon", "polygon", "point"]
    assert rows[1]["parts"] is None and rows[4]["xmax"] == 7.5 and rows[0]["attributes"] == {} and len(rows[0]["parts"]) == 2
    assert {r["record"] for r in shapefile.read(spark, path, box="9,-1,21,9").collect()} == {2, 3}
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        found = shapefile.read(spark, path).where("xmin <= 12 and xmax >= 9 and shape = 'polygon'")
        assert {r["record"] for r in found.collect()} == {2}
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_gates(spark, tmp_path):
    write(tmp_path / "g.shp", [(3, [[(0.0, 0.0), (0.5, 0.1), (1.0, 0.0)]]), (3, [[(5.0, 5.0), (6.0, 6.0)]])], [("g1", "west"), ("g2", "east")], ("gate_id", "region"))
    got = shapefile.read_gates(spark, str(tmp_path / "g.shp"))
    tables.validate_gates(got)
    assert [tuple(r) for r in got.orderBy("sort_order").collect()] == [("g1", None, "west", 0, 0.0, 0.0, 1.0, 0.0), ("g2", None, "east", 1, 5.0, 5.0, 6.0, 6.0)]


def test_refused(spark, tmp_path):
    write(tmp_path / "p.shp", LAND, prj='PROJCS["UTM", GEOGCS["WGS 84"]]')
    (tmp_path / "x.shp").write_bytes(b"no such thing" * 20)
    for name, what in (("p.shp", "WGS 84"), ("x.shp", "no shapefile")):
        with pytest.raises(Exception, match=what):
            shapefile.read(spark, str(tmp_path / name)).collect()
    write(tmp_path / "e.shp", [])
    assert shapefile.read(spark, str(tmp_path / "e.shp")).collect() == []
