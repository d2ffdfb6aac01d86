import json
import sqlite3

import pytest

from galetrack.sources import besttrack, sinks, tables

# Invented storms, in the archive's format.
GOOD = """AL072018, QUILL, 3,
20180911, 0600,  , TS, 17.4N,  61.3W,  55,  996, 90, 80, 60, 70, 40, 30, 20, 30, 0, 0, 0, 0, 25
20180911, 0935, L, TS, 17.6N,  61.8W,  60,  993, 90, 80, 60, 70, 40, 30, 20, 30, 0, 0, 0, 0, 20
20180911, 1200,  , TS, 17.7N, 182.2W, -99, -999, 90, 80, 60, 70, 40, 30, 20, 30, 0, 0, 0, 0,
EP041902, UNNAMED, 1,
19020704, 1800,  , HU, 13.5N, 101.1W,  70, -999, -999, -999, -999, -999, -999, -999, -999, -999, -999, -999, -999, -999,
"""


def read(spark, tmp_path, text, strict=True, name="a.txt"):
    (tmp_path / name).write_bytes(text.encode())
    return besttrack.read(spark, str(tmp_path / "*.txt"), strict)


def test_good_file(spark, tmp_path):
    got = read(spark, tmp_path, "<html>\r\n" + GOOD.replace("\n", "\r\n"))
    rows = got.points.orderBy("storm_id", "point_seq").collect()
    assert [(r["storm_id"], r["point_seq"], r["source_line_no"]) for r in rows] == [("AL072018", 0, 3), ("AL072018", 1, 4), ("AL072018", 2, 5), ("EP041902", 0, 7)]
    assert rows[1]["record_identifier"] == "L" and not rows[1]["is_synoptic"] and rows[0]["is_synoptic"] and rows[0]["record_identifier"] is None
    assert rows[2]["longitude"] == pytest.approx(177.8) and rows[2]["max_wind_kt"] is None and rows[2]["min_pressure_mb"] is None and rows[0]["latitude"] == 17.4 and rows[0]["longitude"] == -61.3
    assert rows[0]["radius_max_wind_nm"] == 25 and rows[3]["radius_max_wind_nm"] is None and rows[3]["season"] == 1902 and got.issues.count() == 0
    assert got.provenance.first()["n_bytes"] > 0 and got.storms.count() == 2


@pytest.mark.parametrize(
    "old, new, rule",
    [("QUILL, 3", "QUILL, 4", "row_count"), ("AL072018", "ZZ072018", "basin"), (" TS, 17.6N", " XX, 17.6N", "status"), (" L, TS", " Q, TS", "record_identifier"), ("20180911, 0935", "20181911, 0935", "time"),
     ("17.6N", "17.6X", "latitude"), (" 60,  993", "abc,  993", "number"), ("EP041902", "AL072018", "duplicate_id"), ("0, 25\n20180911, 0935", "0, 25, 9\n20180911, 0935", "field_count"), ("0600,  ,", "1900,  ,", "time_order")],
)
def test_broken_rules(spark, tmp_path, old, new, rule):
    assert old in GOOD
    got = read(spark, tmp_path, GOOD.replace(old, new, 1), strict=False)
    assert rule in {r["rule"] for r in got.issues.collect()}
    if rule != "time_order":
        with pytest.raises(besttrack.BestTrackError, match=r"a\.txt:\d+"):
            read(spark, tmp_path, GOOD.replace(old, new, 1))


def test_geojson_gates_and_sinks(spark, tmp_path):
    box = lambda x: [[x, 0], [x + 1, 0], [x + 1, 1], [x, 1], [x, 0]]
    features = [{"type": "Feature", "properties": {"n": "A", "c": "US"}, "geometry": {"type": "Polygon", "coordinates": [box(0)]}}, {"type": "Feature", "properties": {"n": "B", "c": "MX"}, "geometry": {"type": "MultiPolygon", "coordinates": [[box(2)], [box(4)[:-1]]]}}]
    (tmp_path / "land.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    units, edges = tables.read_geojson(spark, str(tmp_path / "land.json"), {"admin1_name": "n", "iso_country": "c"})
    assert sorted(map(tuple, units.collect())) == [(0, "A", "US"), (1, "B", "MX")] and edges.count() == 12
    (tmp_path / "gates.csv").write_text("gate_id,region,lon1,lat1,lon2,lat2\n7,Texas,1,2,3,4\nb,\"x, y\",5,6,7,8\n")
    gates = tables.read_gates_csv(spark, str(tmp_path / "gates.csv"))
    assert [tuple(r) for r in gates.orderBy("sort_order").collect()] == [("7", None, "Texas", 0, 1.0, 2.0, 3.0, 4.0), ("b", None, "x, y", 1, 5.0, 6.0, 7.0, 8.0)]
    tables.validate_gates(gates)
    for bad in (gates.where("gate_id = 'z'"), gates.union(gates)):
        with pytest.raises(ValueError):
            tables.validate_gates(bad)
    assert len(json.loads(sinks.gates_geojson(gates).first()["value"])["features"]) == 2
    sinks.write_tables({"gates": gates, "none": gates.where("false")}, str(tmp_path / "out"))
    assert tables.read_built(spark, str(tmp_path / "out"), "gates").count() == 2 and tables.read_built(spark, str(tmp_path / "out"), "none").columns == gates.columns
    sinks.write_sqlite({"gates": gates}, str(tmp_path / "x.db"), {"gates": ["gate_id"]}, {"gates": ["region"]})
    with sqlite3.connect(tmp_path / "x.db") as db:
        assert db.execute("select count(*), min(x1) from gates").fetchall() == [(2, 1.0)]
    assert "CREATE TABLE IF NOT EXISTS GATES" in sinks.ddl({"gates": gates}, {"gates": ["region"]})


def test_mean_radii(spark, tmp_path):
    from galetrack.plans import workload

    rows = workload.mean_radii(read(spark, tmp_path, GOOD).points, since=2000).orderBy("point_seq").collect()
    assert [(r["point_seq"], r["mean_r34_nm"], r["radius_max_wind_nm"]) for r in rows] == [(0, 75.0, 25), (1, 75.0, 20)]
