"""Worked cases: two unit squares A (x 0-1) and B (x 2-3), a track along y = 0.5."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from galetrack.operators import landfall
from galetrack.plans import checks, storms
from test_domain import squares

T0 = dt.datetime(2020, 9, 1)
CASES = {
    1: ([0.5], "L"),
    2: ([-1, 0.5], ".."),
    3: ([-1, 4], ".."),
    4: ([-1, 0.5, 1.5, 0.5], "...."),
    5: ([-2, -1], ".L"),
    6: ([-1, 4], ".L"),
    7: ([-1, 4], "LL"),
    8: ([-1.5, -0.5], ".."),
    9: ([-3.0, -2.5], ".."),
}


@pytest.fixture(scope="module")
def built(spark):
    rows = []
    for storm, (xs, flags) in CASES.items():
        for i, (x, f) in enumerate(zip(xs, flags)):
            wind = None if storm == 3 and i == 0 else 60 + i
            rows.append((storm, i, T0 + dt.timedelta(hours=6 * i), float(x), 0.5, "TS", "L" if f == "L" else None, wind, 990, True))
    points = spark.createDataFrame(rows, "storm_id int, point_seq int, timestamp_utc timestamp, longitude double, latitude double, status string, record_identifier string, max_wind_kt int, min_pressure_mb int, is_synoptic boolean")
    seasons = points.select("storm_id").distinct().select("storm_id", F.lit(2020).alias("season"), F.lit("X").alias("name"), F.lit("AL").alias("basin"))
    units = spark.createDataFrame([(1, "A", "Land", "US"), (2, "B", "Land", "US")], "unit_id int, admin1_name string, country_name string, iso_country string")
    gates = spark.createDataFrame([("g1", "west", 0.0, 0.4, 0.0, 0.6), ("g2", "far", 9.0, 9.0, 9.5, 9.0)], "gate_id string, region string, x1 double, y1 double, x2 double, y2 double")
    return storms.build(points, seasons, squares(spark), units, gates, step_km=5.0)


def test_events(built):
    got = {}
    for r in built.landfalls.orderBy("storm_id", "exact_time", "seg", "j").collect():
        got.setdefault(r["storm_id"], []).append((r["landfall_admin1"], r["detection_method"], r["landfall_type"], r["landfall_seq"]))
    one, two = "first_landfall", "subsequent_landfall"
    assert got == {
        2: [("A", "inferred", one, 1)],
        3: [("A", "inferred", one, 1), ("B", "inferred", two, 2)],
        4: [("A", "inferred", one, 1), ("A", "inferred", two, 2)],
        5: [("A", "native", one, 1)],
        6: [("A", "native_confirmed", one, 1), ("B", "inferred", two, 2)],
        7: [("A", "native_confirmed", one, 1), ("B", "native_confirmed", two, 2)],
    }


def test_values(built):
    rows = {(r["storm_id"], r["landfall_seq"]): r for r in built.landfalls.collect()}
    strike = rows[2, 1]
    assert 0 < strike["exact_lon"] < 0.06 and strike["is_attribution_exact"] and strike["landfall_admin_distance_km"] == 0
    assert strike["exact_wind_kt"] == 61 and strike["sixhr_time"] == T0 and 3.9 < strike["hours_from_6hr_to_landfall"] < 4.3
    assert strike["gate_id"] == "g1" and strike["gate_is_crossing"]
    assert rows[3, 1]["exact_wind_kt"] is None and rows[3, 1]["exact_ss_category"] == "UNK"
    native = rows[5, 1]
    assert not native["is_attribution_exact"] and native["landfall_admin_distance_km"] == pytest.approx(111.3, abs=0.1)


def test_near_misses_and_checks(built):
    assert {r["storm_id"]: round(r["bypass_distance_to_coast_km"]) for r in built.bypasses.collect()} == {1: 56, 8: 56}
    found = {r["check"]: r for r in checks.run(built).collect()}
    assert len(found) == 29 and {r["result"] for r in found.values()} == {"PASS"} and found["statuses"]["detail"] == f"0 of {built.track_points.count()}"
    assert {r["storm_id"] for r in built.storms.where("made_landfall").collect()} == {2, 3, 4, 5, 6, 7}


def test_checks_of_spoiled_tables(built):
    """Each check turns red on its own fault, with and without a build's own counts."""
    p, l, s, b, g = built.track_points, built.landfalls, built.storms, built.bypasses, built.landfall_gates
    put = lambda df, c, v, where: df.withColumn(c, F.when(F.expr(where), F.expr(v)).otherwise(F.col(c)))
    spoiled = dataclasses.replace(
        built, observations={},
        storms=put(put(s, "n_track_points", "n_track_points + 1", "storm_id = 2"), "n_landfalls", "9", "storm_id = 3").unionByName(s.where("storm_id = 4")),
        track_points=put(put(put(put(put(p, "status", "'ZZ'", "storm_id = 2"), "max_wind_kt", "-99", "storm_id = 3"), "latitude", "91", "storm_id = 4"), "ss_category", "'4'", "storm_id = 5"), "min_pressure_mb", "700", "storm_id = 6")
        .withColumn("record_identifier", F.lit("Q")).withColumn("min_distance_to_coast_km", F.lit(None).cast("double")).withColumn("longitude", F.lit(200.0)).unionByName(p.where("storm_id = 7")).withColumn("ss_category", F.when(F.col("storm_id") == 7, "X").otherwise(F.col("ss_category"))),
        landfalls=put(put(put(l, "is_landfall", "false", "detection_method = 'native'"), "gate_id", "'none'", "storm_id = 2"), "landfall_seq", "7", "storm_id = 3")
        .withColumn("landfall_admin1", F.lit(None).cast("string")).withColumn("is_attribution_exact", F.lit(False)).unionByName(l.where("storm_id = 7").withColumn("storm_id", F.lit(99))),
        bypasses=b.unionByName(b).unionByName(b.limit(1).withColumn("storm_id", F.lit(2))).unionByName(b.limit(1).withColumn("storm_id", F.lit(98))),
        landfall_gates=g.unionByName(g),
    )
    red = {r["check"] for r in checks.run(spoiled).where("result = 'FAIL'").collect()}
    assert red == {r["check"] for r in checks.run(built).collect()} - {"declared_point_counts", "points_have_storm"}
    assert {r["check"] for r in checks.run(dataclasses.replace(built, observations={})).where("result = 'FAIL'").collect()} == set()
    lost = dataclasses.replace(built, storms=s.withColumn("n_declared", F.lit(77)).where("storm_id <> 2"))
    assert {"declared_point_counts", "points_have_storm"} <= {r["check"] for r in checks.run(lost).where("result = 'FAIL'").collect()}


def test_antimeridian(spark):
    segs = spark.createDataFrame([(1, 0, 179.5, 10.0, -179.5, 10.0)], "storm_id int, seg int, a_longitude double, a_latitude double, b_longitude double, b_latitude double")
    for planar in (True, False):
        lons = [r["lon"] for r in landfall.densify(segs, 10.0, planar).collect()]
        assert len(lons) < 15 and all(abs(x) >= 179.4 for x in lons)
