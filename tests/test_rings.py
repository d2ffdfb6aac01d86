"""Rings against plain walks, areas and even-odd tests."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from galetrack.operators import geometry, rings
from galetrack.operators.stage import settle
from test_cover import boxes, inside, ring, table


def test_chains(spark):
    """Closed and open chains of all lengths."""
    rng, links, want, at = random.Random(2), [], {}, 0
    for n, closed in [(1, False), (1, True), (2, True), (2, False), (3, True), (17, True), (64, False), (65, True)]:
        ids = list(range(at, at + n))
        at += n
        rng.shuffle(ids)
        if closed:
            k = ids.index(min(ids))
            ids = ids[k:] + ids[:k]
        links += [(a, b) for a, b in zip(ids, [*ids[1:], ids[0] if closed else None])]
        want |= {a: (ids[-1], i, n) for i, a in enumerate(ids)}
    rng.shuffle(links)
    got = {r["id"]: (r["chain"], r["place"], r["length"]) for r in rings.chains(spark.createDataFrame(links, "id long, next long")).collect()}
    assert got == want


def test_polygons_of_the_union(spark):
    """A ring of eight boxes around a lake, a box that touches a corner, one alone."""
    around = [(i, x, y, x + 1, y + 1) for i, (x, y) in enumerate([(0, 0), (1, 0), (2, 0), (0, 1), (2, 1), (0, 2), (1, 2), (2, 2)])]
    edges = table(spark, boxes([*around, (20, 3, 3, 4, 4), (30, 8, 0, 9, 2)]))
    traced = settle(rings.polygons(edges), "test-rings")
    found = rings.with_area(traced.drop("is_hole"), "landmass").collect()
    assert sorted((r["landmass"], r["is_hole"], r["edges"]) for r in found) == [(0, False, 12), (0, True, 4), (20, False, 4), (30, False, 4)]
    area = defaultdict(float)
    for r in found:
        area[r["landmass"]] += -r["area_km2"] if r["is_hole"] else r["area_km2"]
    masses = {r["m"]: r["a"] for r in geometry.landmasses(edges).join(geometry.connected_units(edges), "unit_id").groupBy(F.col("root").alias("m")).agg(F.first("landmass_area_km2").alias("a")).collect()}
    assert area == pytest.approx(masses)
    follow = traced.orderBy("landmass", "ring", "place").collect()
    for a, b in zip(follow, follow[1:]):
        assert a["ring"] != b["ring"] or (a["x2"], a["y2"]) == (b["x1"], b["y1"])


def line(unit, *at):
    at = [(float(x), float(y)) for x, y in at]
    return [(unit, *a, *b) for a, b in zip(at, at[1:] + at[:1])]


def test_repair(spark):
    spec = {
        1: (line(1, (0, 0), (2, 2), (2, 0), (0, 2)), 2.0, {"crossing"}),  # a bow-tie: both loops
        2: (line(2, (10, 0), (11, 0), (11, 1), (13, 1), (11, 1), (10, 1)), 1.0, {"spike or doubled line"}),
        3: (line(3, (20, 0), (20, 0), (21, 0), (21, 1), (20, 1)), 1.0, {"repeated vertex"}),
        4: (line(4, (30, 0), (31, 0), (31, 1), (30, 1)), 1.0, set()),
        5: (line(5, (40, 0), (42, 0), (42, 2), (40, 2)) + line(5, (40.5, 0.5), (41.5, 0.5), (41.5, 1.5), (40.5, 1.5)), 3.0, set()),  # a hole
        6: (line(6, (50, 0), (51, 0), (51, 1), (50, 1))[:3], 0.0, {"not closed"}),
        7: (line(7, (60, 0), (61, 0)), 0.0, {"spike or doubled line", "no area"}),
        8: (line(8, (70, 0), (72, 0), (72, 1), (70, 1)) + line(8, (71, 0), (73, 0), (73, 1), (71, 1)), 2.0, {"crossing", "spike or doubled line"}),  # what is covered twice goes
        9: (line(9, (80, 0), (81, 1), (80, 2), (79, 1)) + line(9, (81, 1), (82, 0), (83, 1), (82, 2)), 4.0, set()),  # two rings touch
    }
    good, bad = rings.repair(table(spark, [e for rows, _, _ in spec.values() for e in rows]))
    faults = defaultdict(set)
    for r in bad.collect():
        faults[r["unit_id"]].add(r["fault"])
    area, count = Counter(), Counter()
    for r in good.collect():
        area[r["unit_id"]] += (r["x1"] * r["y2"] - r["x2"] * r["y1"]) / 2
        count[r["unit_id"], r["ring"]] += 1
    for unit, (_, size, wrong) in spec.items():
        assert area[unit] == pytest.approx(size) and (faults[unit] - {"crossing"} if unit == 8 else faults[unit]) == (wrong - {"crossing"} if unit == 8 else wrong), unit
    assert sorted(n for (unit, _), n in count.items() if unit == 9) == [4, 4] and sorted(n for (unit, _), n in count.items() if unit == 1) == [3, 3]


def test_clip(spark):
    rng = random.Random(5)
    rows = ring(1, 0, 0, 5, 50, rng) + ring(2, 3, 3, 4, 21, rng) + boxes([(3, -2, -2, 2, 2), (4, -9, -9, -4, -4), (5, 1, -1.5, 6, -1)])
    box = (-2.0, -1.5, 2.5, 3.0)
    cut = [tuple(r) for r in rings.clip(table(spark, rows), box).collect()]
    assert not {u for u, *_ in cut} & {4}
    ends = Counter((u, p) for u, x1, y1, x2, y2 in cut for p in ((x1, y1), (x2, y2)))
    assert all(n % 2 == 0 for n in ends.values())
    assert all(box[0] <= x <= box[2] and box[1] <= y <= box[3] for _, x1, y1, x2, y2 in cut for x, y in ((x1, y1), (x2, y2)))
    for unit in (1, 2, 3, 5):
        mine, whole = [r for r in cut if r[0] == unit], [r for r in rows if r[0] == unit]
        for _ in range(400):
            x, y = rng.uniform(-4, 5), rng.uniform(-4, 5)
            within = box[0] < x < box[2] and box[1] < y < box[3]
            assert inside(mine, x, y) == (inside(whole, x, y) if within else None)
    with pytest.raises(rings.NothingLeft):
        rings.clip(table(spark, rows), (50.0, 50.0, 51.0, 51.0))


def test_simplify_keeps_shared_borders(spark):
    """Two neighbours with a rough border, an island near a coast, a sliver: nothing crosses, all stay closed."""
    rng = random.Random(8)
    border = [(1 + 0.05 * rng.uniform(-1, 1), i / 40) for i in range(41)]
    left = [(0.0, 0.0), *border, (0.0, 1.0)]
    right = [(2.0, 1.0), *border[::-1], (2.0, 0.0)]
    island = [(3 + 0.3 * (1 + 0.1 * rng.uniform(-1, 1)) * math.cos(2 * math.pi * i / 60), 0.5 + 0.3 * (1 + 0.1 * rng.uniform(-1, 1)) * math.sin(2 * math.pi * i / 60)) for i in range(60)]
    pin = [(x, 1.03 + 0.02 * math.sin(i)) for i, x in enumerate([0.2, 0.5, 0.8, 0.6, 0.4])]
    rows = [e for u, at in ((1, left), (2, right), (3, island), (4, pin)) for e in line(u, *at)]
    edges = table(spark, rows)
    made = settle(rings.simplify(edges, 0.2), "test-simple")
    got = [tuple(r) for r in made.collect()]
    flat = lambda u: {frozenset(((x1, y1), (x2, y2))) for v, x1, y1, x2, y2 in got if v == u}
    assert flat(1) & flat(2) and len(got) < len(rows) / 3
    for u in (1, 2, 3, 4):
        ends = Counter(p for e in flat(u) for p in e)
        assert ends and all(n % 2 == 0 for n in ends.values())
    lines = [tuple(map(tuple, map(sorted, [e])))[0] for e in {e for u in (1, 2, 3, 4) for e in flat(u)}]

    def cross(a, b):
        turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
        return turn(*a, b[0]) * turn(*a, b[1]) < 0 and turn(*b, a[0]) * turn(*b, a[1]) < 0

    assert not any(cross(a, b) for i, a in enumerate(lines) for b in lines[:i])
    same = rings.simplify(edges, 0.0)
    assert {(r[0], frozenset(((r[1], r[2]), (r[3], r[4])))) for r in same.collect()} == {(u, frozenset(((x1, y1), (x2, y2)))) for u, x1, y1, x2, y2 in rows}


def test_extract(spark):
    units = spark.createDataFrame([(1, "US"), (2, "MX"), (3, "CU")], "unit_id int, iso_country string")
    edges = table(spark, boxes([(1, 0, 0, 4, 4), (2, 4, 0, 8, 4), (3, 2, 6, 3, 7)]))
    got = {r["unit_id"] for r in rings.extract(edges, units, (1.0, 1.0, 9.0, 9.0), 0.1, ["US", "MX"]).collect()}
    assert got == {1, 2}
