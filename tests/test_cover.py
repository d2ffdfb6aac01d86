"""The cell cover against plain even-odd tests, and stretches against all samples."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from galetrack.operators import cover, landfall
from galetrack.operators.stage import settle

T0 = dt.datetime(2020, 9, 1)


def ring(unit, x, y, r, n, rng):
    """A star-shaped ring with a rough coast."""
    at = [(x + r * rng.uniform(0.6, 1) * math.cos(2 * math.pi * i / n), y + r * rng.uniform(0.6, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    return [(unit, *a, *b) for a, b in zip(at, at[1:] + at[:1])]


def table(spark, rows):
    return spark.createDataFrame(rows, "unit_id int, x1 double, y1 double, x2 double, y2 double")


def inside(rows, x, y):
    out = {}
    for u, x1, y1, x2, y2 in rows:
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            out[u] = not out.get(u, False)
    return min((u for u, v in out.items() if v), default=None)


def test_points(spark):
    rng = random.Random(3)
    rows = ring(1, 0, 0, 5, 40, rng) + ring(2, 9, 1, 3, 300, rng) + ring(3, -3, 11, 0.4, 12, rng) + ring(4, 1, 1, 6, 25, rng)
    land = settle(cover.build(table(spark, rows)), "test-cover")
    points = [(i, rng.uniform(-9, 13), rng.uniform(-8, 13)) for i in range(1500)] + [(2000 + i, float(i % 30 - 12), float(i // 30 - 8) / 2) for i in range(600)]
    got = {r["id"]: r["unit_id"] for r in cover.with_unit(spark.createDataFrame(points, "id int, longitude double, latitude double"), land).collect()}
    assert got == {i: inside(rows, x, y) for i, x, y in points}
    kinds = {(r["level"], r["kind"]): r["cells"] for r in cover.counts(land).collect()}
    assert kinds[0, "cut"] > 5 and any(k == "land" and level < cover.LEAST_LEVEL for level, k in kinds)


def boxes(spec):
    out = []
    for u, *at in spec:
        xa, ya, xb, yb = map(float, at)
        at = [(xa, ya), (xb, ya), (xb, yb), (xa, yb)]
        out += [(u, *a, *b) for a, b in zip(at, at[1:] + at[:1])]
    return out


def test_sides_corners_and_shared_borders(spark):
    """The union's whole boundary is outside; borders between units are inside, in the smaller id."""
    # 1 and 2 share a side, 3 shares a part of theirs from above, 4 stands alone; 0.5 is a border of cells.
    rows = boxes([(1, 0, 0, 1, 1), (2, 1, 0, 2, 1), (3, 0.5, 1, 1.5, 2), (4, 4.5, 0.5, 5, 1)])
    land = cover.build(table(spark, rows))
    want = {
        (0.0, 0.5): None, (2.0, 0.5): None, (0.5, 0.0): None, (1.0, 0.0): None, (0.0, 0.0): None, (2.0, 1.0): None,
        (1.0, 0.5): 1, (1.0, 1.0): 1, (0.75, 1.0): 1, (1.25, 1.0): 2, (0.25, 1.0): None, (0.5, 1.0): None, (1.5, 1.0): None,
        (0.5, 1.5): None, (1.0, 2.0): None, (1.0, 1.5): 3, (4.5, 0.75): None, (5.0, 0.75): None, (4.75, 0.75): 4, (4.5, 0.5): None, (3.0, 0.5): None,
    }
    points = spark.createDataFrame([(x, y) for x, y in want], "longitude double, latitude double")
    assert {(r["longitude"], r["latitude"]): r["unit_id"] for r in cover.with_unit(points, land).collect()} == want


def sampled(segs, land, step, planar):
    """Crossings from all samples."""
    rows = cover.with_unit(landfall.densify(segs, step, planar), land, "lon", "lat")
    along = Window.partitionBy("storm_id", "seg").orderBy("j")
    rows = rows.withColumns({"was": F.lag("unit_id").over(along), "before_lon": F.lag("lon").over(along), "before_lat": F.lag("lat").over(along), "nth": F.row_number().over(along)})
    rows = rows.where("unit_id is not null and was is null and nth > 1")
    return {(r["storm_id"], r["seg"], r["j"]): (r["unit_id"], r["lon"], r["lat"], r["before_lon"], r["before_lat"]) for r in rows.collect()}


@pytest.mark.parametrize("planar", [True, False])
def test_crossings(spark, planar):
    """The same as from all samples, from a fraction of them; over the antimeridian and near a pole too."""
    rng = random.Random(7)
    rows = ring(1, 0, 20, 5, 60, rng) + ring(2, 9, 22, 2, 90, rng) + ring(3, -176, 30, 3.5, 30, rng) + ring(4, 176, 31, 3.5, 30, rng) + ring(5, 40, 80, 3, 40, rng)
    land = settle(cover.build(table(spark, rows)), "test-cover")
    fixes = []
    for storm in range(70):
        x, y = rng.choice([(rng.uniform(-9, 13), rng.uniform(12, 27)), (rng.uniform(172, 188), rng.uniform(26, 35)), (rng.uniform(30, 50), rng.uniform(75, 83))])
        for i in range(9):
            fixes.append((storm, i, T0 + dt.timedelta(hours=6 * i), (x + 180) % 360 - 180, y, 50, 990, "TS", None))
            x, y = x + rng.uniform(-3, 3), min(84.0, y + rng.uniform(-2, 2))
    points = spark.createDataFrame(fixes, "storm_id int, point_seq int, timestamp_utc timestamp, longitude double, latitude double, max_wind_kt int, min_pressure_mb int, status string, record_identifier string")
    segs = settle(landfall.segments(points), "test-segments")
    got = {(r["storm_id"], r["seg"], r["j"]): (r["unit_id"], r["lon"], r["lat"], r["before_lon"], r["before_lat"]) for r in landfall.crossings(segs, land, 2.0, planar).collect()}
    want = sampled(segs, land, 2.0, planar)
    assert got.keys() == want.keys() and len(got) > 15
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    stretches = cover.stretches(cover.parts(cover.near_land(segs, land), 2.0, planar), land, planar)
    assert stretches.count() * 3 < landfall.densify(segs, 2.0, planar).count()


def test_a_long_coast(spark):
    """100,000 edges: cells go deeper, and none keeps many."""
    rng = random.Random(1)
    n, rows = 100_000, []
    at = [((4 + 0.02 * rng.random()) * math.cos(2 * math.pi * i / n), (4 + 0.02 * rng.random()) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    rows = [(1, *a, *b) for a, b in zip(at, at[1:] + at[:1])]
    land = settle(cover.build(table(spark, rows)), "test-cover")
    most = land.where("kind = 'boundary'").select(F.max(F.size(F.col("units")[0]["edges"]))).first()[0]
    assert most < 2000 and land.where("kind = 'land' and level < 2").count() > 0
    points = [(i, rng.uniform(-5, 5), rng.uniform(-5, 5)) for i in range(400)] + [(1000 + i, 4.01 * math.cos(i), 4.01 * math.sin(i)) for i in range(40)]
    got = {r["id"]: r["unit_id"] for r in cover.with_unit(spark.createDataFrame(points, "id int, longitude double, latitude double"), land).collect()}
    assert got == {i: inside(rows, x, y) for i, x, y in points}
