import random

import pytest
from pyspark.sql import functions as F

from galetrack.functions import domain
from galetrack.functions.geodesy import with_destination, with_geodesic
from galetrack.operators import cover, geometry, landfall


def test_categories(spark):
    # The scale's floors.
    cases = [(0, "TD"), (33, "TD"), (34, "TS"), (63, "TS"), (64, "1"), (82, "1"), (83, "2"), (95, "2"), (96, "3"), (112, "3"), (113, "4"), (136, "4"), (137, "5"), (200, "5"), (None, "UNK"), (-999, "UNK"), (-99, "UNK")]
    rows = spark.createDataFrame(cases, "w int, want string").select("want", domain.ss_category(F.col("w")).alias("got")).collect()
    assert all(r["got"] == r["want"] for r in rows)


def test_flag_eras(spark):
    # The seasons in which the archive flags landfalls.
    years = [(y,) for y in (1850, 1851, 1950, 1951, 1970, 1971, 1990, 1991, 2025)]
    rows = spark.createDataFrame(years, "y int").select("y", domain.flagging_complete(F.col("y"), F.lit(True)).alias("c"), domain.flagging_complete(F.col("y"), F.lit(False)).alias("i")).collect()
    assert {r["y"] for r in rows if r["c"]} == {1851, 1950, 1951, 1970, 1991, 2025}
    assert {r["y"] for r in rows if r["i"]} == {1951, 1970, 1991, 2025}


def test_half_even_and_longitudes(spark):
    r = spark.range(1).select(
        domain.interpolated_int(F.lit(50), F.lit(55), F.lit(0.5)).alias("i"), domain.interpolated_int(F.lit(None).cast("int"), F.lit(55), F.lit(0.5)).alias("n"),
        domain.wrapped_longitude(F.lit(180.0)).alias("a"), domain.wrapped_longitude(F.lit(-180.0)).alias("b"), domain.wrapped_longitude(F.lit(190.0)).alias("c"),
    ).first()
    assert (r["i"], r["n"], r["a"], r["b"], r["c"]) == (52, None, 180.0, -180.0, -170.0)


def test_geodesics(spark):
    rows = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (-71.5, 33.0, -71.5, 33.0), (-71.5, 33.0, -70.0, 34.5), (179.5, 10.0, -179.5, 10.0)], "x1 double, y1 double, x2 double, y2 double")
    got = with_geodesic(rows, "km", "x1", "y1", "x2", "y2", azimuth="az")
    assert [round(r["km"], 2) for r in got.collect()][:2] == [110.57, 0.0]
    assert got.collect()[3]["km"] < 120
    back = with_destination(got, "x", "y", "x1", "y1", "az", "km").collect()
    assert all(abs(r["y"] - r["y2"]) < 1e-9 and abs((r["x"] - r["x2"] + 180) % 360 - 180) < 1e-9 for r in back)


def squares(spark):
    sides = []
    for unit, x in ((1, 0.0), (2, 2.0)):
        corners = [(x, 0.0), (x + 1, 0.0), (x + 1, 1.0), (x, 1.0)]
        sides += [(unit, *a, *b) for a, b in zip(corners, corners[1:] + corners[:1])]
    return spark.createDataFrame(sides, "unit_id int, x1 double, y1 double, x2 double, y2 double")


def test_containment_and_nearest_agree_with_brute_force(spark):
    edges, rng = squares(spark), random.Random(1)
    pts = [(i, rng.uniform(-3, 6), rng.uniform(-2, 3)) for i in range(200)]
    points = spark.createDataFrame(pts, "id int, longitude double, latitude double")
    found = {r["id"]: r["unit_id"] for r in cover.with_unit(points, cover.build(edges)).collect()}
    assert found == {i: 1 if 0 < x < 1 and 0 < y < 1 else 2 if 2 < x < 3 and 0 < y < 1 else None for i, x, y in pts}
    few = {r["id"]: r for r in geometry.nearest_edge(points, ["id"], edges, "unit_id").collect()}
    old, geometry.FEW_EDGES = geometry.FEW_EDGES, 0
    try:
        grid = {r["id"]: r for r in geometry.nearest_edge(points, ["id"], edges, "unit_id").collect()}
    finally:
        geometry.FEW_EDGES = old
    assert few.keys() == grid.keys() == {p[0] for p in pts}
    for i, _, _ in pts:
        assert few[i]["near_degrees"] == pytest.approx(grid[i]["near_degrees"])


def greedy(flags, counts):
    claimed, out = set(), []
    for seg, k in enumerate(counts):
        for _ in range(k):
            hit = next((f for f in (seg, seg + 1) if flags[f] and f not in claimed), None)
            claimed.add(hit)
            out.append(hit)
    return out


def test_flag_matching_is_greedy(spark):
    rng, segs, found, want = random.Random(2), [], [], {}
    for storm in range(300):
        n = rng.randint(1, 7)
        flags, counts = [rng.random() < 0.5 for _ in range(n + 1)], [rng.choice([0, 0, 1, 1, 2, 3]) for _ in range(n)]
        segs += [(storm, i, flags[i], flags[i + 1]) for i in range(n)]
        spots = [(storm, i, o) for i in range(n) for o in range(counts[i])]
        found += spots
        want.update(zip(spots, greedy(flags, counts)))
    got = landfall.match_flags(spark.createDataFrame(segs, "storm_id int, seg int, a_flagged boolean, b_flagged boolean"), spark.createDataFrame(found, "storm_id int, seg int, o int"))
    assert {(r["storm_id"], r["seg"], r["o"]): r["flag_seq"] for r in got.collect()} == want


def test_classes_ask_the_status_first(spark):
    hurricane, storm, depression, other, unknown = domain.CLASSES
    cases = [("HU", 64, hurricane), ("SS", 64, hurricane), ("SD", 20, depression), ("TS", 34, storm), ("EX", 90, other), ("LO", None, other), ("WV", 40, other), (None, 70, other), ("TD", None, unknown)]
    rows = spark.createDataFrame(cases, "s string, w int, want string")
    got = rows.select("s", "w", "want", domain.event_class(F.col("s"), F.col("w")).alias("got"), domain.system_type(F.col("s"), F.col("w")).alias("marker")).collect()
    assert all(r["got"] == r["want"] for r in got)
    assert [r["marker"] for r in got] == ["hurricane", "hurricane", "depression", "tropical", "extratropical", "extratropical", "extratropical", "extratropical", "depression"]


def test_published_labels(spark):
    rows = spark.createDataFrame([("QUILL", 7, 2018), ("UNNAMED", 3, 1902), ("unnamed", 16, 1902)], "n string, k int, s int")
    got = [r[0] for r in rows.select(domain.published_label(F.col("n"), F.col("s"), F.col("k"))).collect()]
    assert got == ["Quill (2018)", "Three (1902)", "16 (1902)"]


def test_partly_shared_borders(spark):
    def ring(unit, x1, y1, x2, y2):
        corners = [(x1, y1), (x2, y1), (x2, y2), (x1, y2)]
        return [(unit, *a, *b) for a, b in zip(corners, corners[1:] + corners[:1])]

    # A tall unit beside two short ones, and one that only touches its corner.
    rows = ring(1, 0.0, 0.0, 1.0, 3.0) + ring(2, 1.0, 0.0, 2.0, 1.0) + ring(3, 1.0, 1.0, 2.5, 2.0) + ring(4, 3.0, 3.0, 4.0, 4.0)
    edges = spark.createDataFrame(rows, "unit_id int, x1 double, y1 double, x2 double, y2 double")
    fine = geometry.split_edges(edges)
    assert {r["unit_id"]: r["root"] for r in geometry.connected_units(fine).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
    coast = geometry.boundary_edges(fine).collect()
    length = sum(abs(r["x2"] - r["x1"]) + abs(r["y2"] - r["y1"]) for r in coast)
    # The outline of the union (11 and a half less the inner borders) and the lone square.
    assert length == pytest.approx(8 + 4 + 5 - 2 * (1 + 1 + 1) + 4)
    assert sum(r[0] for r in geometry.unit_areas(fine).join(geometry.unit_areas(edges).withColumnRenamed("area_km2", "a"), "unit_id").select(F.abs(F.col("area_km2") - F.col("a"))).collect()) < 1e-3
