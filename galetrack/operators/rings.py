"""Rings from edges: tracing, repair, the union's polygons, simplification and clipping.

Polygons are edge tables (unit_id, x1, y1, x2, y2), and what is done to them is joins on
vertices. Rings and arcs are found by pointer doubling: an edge knows the next one, then
the next but one, then the fourth, so that a chain of n edges takes about 2 log2(n) joins
and no task holds a ring.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galetrack.functions.geodesy import equal_area_x, equal_area_y
from galetrack.functions.workers import importable
from galetrack.operators import cover, geometry
from galetrack.operators.stage import settle

#: Beside an edge's middle, so far in degrees (a tenth of a millimetre), is one of its two sides.
BESIDE = 1e-9
EDGE = ("x1", "y1", "x2", "y2")


def chains(links: DataFrame) -> DataFrame:
    """id, chain (its last member), place (from 0) and length, from links (id, next).

    ``next`` is null at an end and points to one id at most. A closed chain is cut so
    that its smallest id comes first.
    """
    links = settle(links.select("id", "next"), "links")
    state = links.select("id", F.col("next").alias("hop"), F.col("id").alias("low"))
    while True:
        far = state.select(F.col("id").alias("hop"), F.col("hop").alias("further"), F.col("low").alias("below"))
        moved = state.join(far, "hop", "left")
        new = settle(moved.select("id", F.col("further").alias("hop"), F.least("low", "below").alias("low"), F.col("low").alias("old")), "rings")
        state = new.select("id", "hop", "low")
        if new.where("hop is not null and low <> old").isEmpty():
            break
    closed = state.where("hop is not null").select("id", "low")
    open_ = links.join(closed, "id", "left").select("id", F.when(~F.coalesce(F.col("next") == F.col("low"), F.lit(False)), F.col("next")).alias("hop"))
    state = open_.select("id", "hop", F.when(F.col("hop").isNull(), 0).otherwise(1).cast("long").alias("left"), F.coalesce("hop", "id").alias("chain"))
    while not state.where("hop is not null").isEmpty():
        far = state.select(F.col("id").alias("hop"), F.col("hop").alias("further"), F.col("left").alias("more"), F.col("chain").alias("end"))
        moved = state.join(far, "hop", "left")
        state = settle(moved.select("id", F.col("further").alias("hop"), (F.col("left") + F.coalesce("more", F.lit(0))).alias("left"), F.coalesce("end", "chain").alias("chain")), "ranks")
    length = state.groupBy("chain").agg((F.max("left") + 1).alias("length"))
    return state.join(length, "chain").select("id", "chain", (F.col("length") - 1 - F.col("left")).alias("place"), "length")


def facing_land(edges: DataFrame, land: DataFrame) -> DataFrame:
    """``edges`` turned so that land (a cover) is on their left; edges with land on both sides or none go."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    norm = F.sqrt(dx * dx + dy * dy)
    rows = edges.withColumns({f"__{s}": c for s, c in (("lx", (F.col("x1") + F.col("x2")) / 2 - dy / norm * BESIDE), ("ly", (F.col("y1") + F.col("y2")) / 2 + dx / norm * BESIDE), ("rx", (F.col("x1") + F.col("x2")) / 2 + dy / norm * BESIDE), ("ry", (F.col("y1") + F.col("y2")) / 2 - dx / norm * BESIDE))})
    at = cover.levels(land)
    rows = cover.with_unit(cover.with_unit(rows, land, "__lx", "__ly", "__l", at), land, "__rx", "__ry", "__r", at)
    rows = rows.where("(__l is null) <> (__r is null)")
    turned = lambda a, b: F.when(F.col("__l").isNotNull(), F.col(a)).otherwise(F.col(b))
    return rows.select(*[c for c in edges.columns if c not in EDGE], *[turned(a, b).alias(a) for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))])


def trace(edges: DataFrame, owner: str) -> DataFrame:
    """``owner``, ring, place and the edge of each of its rings, from edges with land on their left.

    Where several rings meet in a vertex, one goes on with the first edge clockwise from
    where it came, so that rings touch there and don't cross.
    """
    rows = settle(edges.select(owner, *EDGE).withColumn("id", F.monotonically_increasing_id()), "half-edges")
    back = F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2"))
    come = rows.select(owner, "id", F.col("x2").alias("x"), F.col("y2").alias("y"), back.alias("back"))
    go = rows.select(owner, F.col("id").alias("next"), F.col("x1").alias("x"), F.col("y1").alias("y"), F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")).alias("out"))
    turn = F.pmod(F.col("back") - F.col("out"), F.lit(2 * np.pi))
    turn = F.when(turn <= 0, 2 * np.pi).otherwise(turn)
    following = come.join(go, [owner, "x", "y"], "left").groupBy("id").agg(F.min_by("next", turn).alias("next"))
    return chains(following).join(rows, "id").select(owner, F.col("chain").alias("ring"), "place", *EDGE)


def with_area(rings: DataFrame, owner: str) -> DataFrame:
    """``owner``, ring, edges, area_km2 and is_hole of traced rings: holes run clockwise."""
    x1, x2, y1, y2 = equal_area_x(F.col("x1")), equal_area_x(F.col("x2")), equal_area_y(F.col("y1")), equal_area_y(F.col("y2"))
    area = F.sum(x1 * y2 - x2 * y1) / 2e6
    return rings.groupBy(owner, "ring").agg(F.count("*").alias("edges"), F.abs(area).alias("area_km2"), (area < 0).alias("is_hole"))


def polygons(edges: DataFrame, land: DataFrame | None = None) -> DataFrame:
    """The polygons of the union of all units: landmass (its least unit), ring, is_hole, place and edge.

    Units that share edges form one landmass, whose polygon has one outer ring.
    """
    fine = settle(geometry.split_edges(edges), "union-edges")
    land = settle(cover.build(fine), "union-cover") if land is None else land
    roots = geometry.connected_units(fine).select("unit_id", F.col("root").alias("landmass"))
    shore = geometry.boundary_edges(fine).join(roots, "unit_id").select("landmass", *EDGE)
    rings = settle(trace(facing_land(shore, land), "landmass"), "union-rings")
    return rings.join(with_area(rings, "landmass").select("landmass", "ring", "is_hole"), ["landmass", "ring"])


def closed(rings: DataFrame, owner: str) -> DataFrame:
    """``owner`` and parts: for each outer ring a polygon, itself and then the holes in it, closed.

    ``rings`` has is_hole. The rings of an owner are put together in one row, as a geometry is a
    value. Where an owner has several outer rings, a hole goes to the smallest outer ring
    whose box holds its own.
    """
    spots = F.transform(F.array_sort(F.collect_list(F.struct("place", "x1", "y1"))), lambda s: F.struct(s["x1"].alias("x"), s["y1"].alias("y")))
    ends = [f("x1" if c == "x" else "y1").alias(f"{n}{c}") for n, f in (("min", F.min), ("max", F.max)) for c in "xy"]
    one = rings.groupBy(owner, "ring", "is_hole").agg(spots.alias("s"), *ends)
    one = one.select(owner, "ring", "is_hole", F.concat("s", F.slice("s", 1, 1)).alias("spots"), *[f"{n}{c}" for n in ("min", "max") for c in "xy"])
    outer = one.where("not is_hole").select(owner, F.col("ring").alias("around"), *[F.col(c).alias(f"o_{c}") for c in ("minx", "miny", "maxx", "maxy")])
    held = one.where("is_hole").join(outer, owner).where("minx >= o_minx and miny >= o_miny and maxx <= o_maxx and maxy <= o_maxy")
    held = held.groupBy(owner, "ring").agg(F.min_by("around", (F.col("o_maxx") - F.col("o_minx")) * (F.col("o_maxy") - F.col("o_miny"))).alias("around"))
    placed = one.join(held, [owner, "ring"], "left").withColumn("around", F.coalesce("around", "ring"))
    parts = placed.groupBy(owner, "around").agg(F.transform(F.array_sort(F.collect_list(F.struct("is_hole", "ring", "spots"))), lambda r: r["spots"]).alias("rings"))
    return parts.groupBy(owner).agg(F.transform(F.array_sort(F.collect_list(F.struct("around", "rings"))), lambda p: p["rings"]).alias("parts"))


# Repair.


def crossing_points(edges: DataFrame, size: float = geometry.CELL) -> DataFrame:
    """id and the position of each proper crossing of two edges of a unit, which meet by cell."""
    covers = edges.withColumn("cx", F.explode(F.sequence(geometry.cell(F.least("x1", "x2"), size), geometry.cell(F.greatest("x1", "x2"), size))))
    covers = covers.withColumn("cy", F.explode(F.sequence(geometry.cell(F.least("y1", "y2"), size), geometry.cell(F.greatest("y1", "y2"), size))))
    a, b = covers.select("unit_id", "cx", "cy", F.struct("id", *EDGE).alias("a")), covers.select("unit_id", "cx", "cy", F.struct("id", *EDGE).alias("b"))
    pairs = a.join(b, ["unit_id", "cx", "cy"]).where("a.id < b.id").select("a", "b").distinct()
    ax, ay = F.col("a.x2") - F.col("a.x1"), F.col("a.y2") - F.col("a.y1")
    bx, by = F.col("b.x2") - F.col("b.x1"), F.col("b.y2") - F.col("b.y1")
    both = ax * by - ay * bx
    px, py = F.col("b.x1") - F.col("a.x1"), F.col("b.y1") - F.col("a.y1")
    t, u = (px * by - py * bx) / both, (px * ay - py * ax) / both
    met = pairs.where(both != 0).withColumns({"t": t, "u": u}).where("t > 0 and t < 1 and u > 0 and u < 1")
    met = met.withColumns({"x": F.col("a.x1") + F.col("t") * ax, "y": F.col("a.y1") + F.col("t") * ay})
    return met.select(F.explode(F.array(F.struct(F.col("a.id").alias("id"), F.col("t").alias("t"), "x", "y"), F.struct(F.col("b.id").alias("id"), F.col("u").alias("t"), "x", "y"))).alias("c")).select("c.*").distinct()


def noded(edges: DataFrame) -> DataFrame:
    """Each unit's edges cut where they cross or touch one another; what is passed an even
    number of times (spikes, doubled lines) and edges without length go."""
    rows = settle(edges.select("unit_id", *EDGE).where("x1 <> x2 or y1 <> y2").withColumn("id", F.monotonically_increasing_id()), "raw-edges")
    cuts = crossing_points(rows).groupBy("id").agg(F.array_sort(F.collect_set(F.struct("t", "x", "y"))).alias("cuts"))
    spot = lambda x, y, at: F.array(F.struct(F.lit(at).alias("t"), F.col(x).alias("x"), F.col(y).alias("y")))
    path = F.concat(spot("x1", "y1", 0.0), F.coalesce("cuts", F.array().cast("array<struct<t: double, x: double, y: double>>")), spot("x2", "y2", 1.0))
    out = rows.join(cuts, "id", "left").withColumn("path", path).select("unit_id", "path", F.explode(F.sequence(F.lit(1), F.size("path") - 1)).alias("i"))
    a, b = F.get("path", F.col("i") - 1), F.get("path", F.col("i"))
    out = out.select("unit_id", a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")).where("x1 <> x2 or y1 <> y2")
    fine = geometry.normalised(geometry.split_edges(settle(out, "crossed-edges")))
    once = fine.groupBy("unit_id", "p", "q").agg(F.count("*").alias("n")).where("n % 2 = 1")
    return once.select("unit_id", F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("q.x").alias("x2"), F.col("q.y").alias("y2"))


def repair(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rings (unit_id, ring, place and edge, land on the left), and unit_id and fault of what was not.

    The even-odd rule holds: both loops of a bow-tie are land, what is covered twice is
    not. Faults: 'crossing', 'repeated vertex', 'spike or doubled line', 'not closed'
    (left out) and 'no area' (left out).
    """
    raw = settle(edges.select("unit_id", *EDGE), "repair-input")
    numbered = raw.where("x1 <> x2 or y1 <> y2").withColumn("id", F.monotonically_increasing_id())
    ends = raw.select("unit_id", F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("p"))
    ajar = ends.groupBy("unit_id", "p").agg(F.count("*").alias("n")).where("n % 2 = 1").select("unit_id").distinct()
    sound = raw.join(ajar, "unit_id", "left_anti")
    clean = settle(noded(sound), "noded-edges")
    fault = lambda rows, name: rows.select("unit_id").distinct().withColumn("fault", F.lit(name))
    numbers = settle(numbered, "repair-numbered")
    crossed = numbers.join(crossing_points(numbers).select("id").distinct(), "id", "left_semi")
    doubled = geometry.normalised(geometry.split_edges(sound.where("x1 <> x2 or y1 <> y2"))).groupBy("unit_id", "p", "q").agg(F.count("*").alias("n")).where("n > 1")
    gone = sound.join(clean, "unit_id", "left_anti")
    faults = [fault(crossed, "crossing"), fault(raw.where("x1 = x2 and y1 = y2"), "repeated vertex"), fault(doubled, "spike or doubled line"), fault(ajar, "not closed"), fault(gone, "no area")]
    return own_rings(clean), settle(functools.reduce(DataFrame.unionByName, faults), "ring-faults")


def own_rings(clean: DataFrame) -> DataFrame:
    """Rings of each unit by itself: its side of an edge from the unit's edges along a ray.

    Edges meet others of their unit by the row of cells in which their middle lies; a
    flat edge's ray goes up, any other's to the right.
    """
    rows = settle(clean.withColumn("id", F.monotonically_increasing_id()), "unit-edges")
    flat = F.col("y1") == F.col("y2")
    mid = rows.withColumns({"mx": (F.col("x1") + F.col("x2")) / 2, "my": (F.col("y1") + F.col("y2")) / 2, "flat": flat})
    across = lambda a, b: F.explode(F.sequence(geometry.cell(F.least(a, b)), geometry.cell(F.greatest(a, b))))
    others = {f: rows.select("unit_id", F.struct(*EDGE, "id").alias("o"), across(*ab).alias("row")) for f, ab in ((False, ("y1", "y2")), (True, ("x1", "x2")))}
    asked = {f: mid.where(F.col("flat") == f).withColumn("row", geometry.cell(F.col(m))) for f, m in ((False, "my"), (True, "mx"))}
    right = ((F.col("o.y1") > F.col("my")) != (F.col("o.y2") > F.col("my"))) & (F.col("mx") < F.col("o.x1") + (F.col("my") - F.col("o.y1")) * (F.col("o.x2") - F.col("o.x1")) / (F.col("o.y2") - F.col("o.y1")))
    above = ((F.col("o.x1") > F.col("mx")) != (F.col("o.x2") > F.col("mx"))) & (F.col("my") < F.col("o.y1") + (F.col("mx") - F.col("o.x1")) * (F.col("o.y2") - F.col("o.y1")) / (F.col("o.x2") - F.col("o.x1")))
    counts = [asked[f].join(others[f], ["unit_id", "row"]).where(F.col("o.id") != F.col("id")).groupBy("id").agg(F.count_if(met).alias("n")) for f, met in ((False, right), (True, above))]
    rows = rows.join(counts[0].unionByName(counts[1]), "id", "left").withColumn("odd", F.coalesce("n", F.lit(0)) % 2 == 1)
    # Odd: there is land right of the edge (above a flat one); so an edge has it on its left
    # if it runs down, or if a flat one runs east; even: the other way round.
    kept = F.when(flat, F.col("x2") > F.col("x1")).otherwise(F.col("y2") < F.col("y1")) == F.col("odd")
    turned = rows.select("unit_id", *[F.when(kept, F.col(a)).otherwise(F.col(b)).alias(a) for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))])
    return trace(turned, "unit_id")


# Simplification and clipping.


def arcs(edges: DataFrame) -> DataFrame:
    """arc, units and points: what runs between junctions, once for all the units that share it.

    A junction is a vertex at which other than two edges meet, or edges of different
    units; a closed arc begins and ends in its smallest edge's vertex.
    """
    once = geometry.normalised(geometry.split_edges(edges)).groupBy("p", "q").agg(F.sort_array(F.collect_set("unit_id")).alias("units"))
    rows = settle(once.withColumn("id", F.monotonically_increasing_id()), "shared-edges")
    # Each edge goes both ways; of an arc's two directions one is kept.
    half = rows.select((F.col("id") * 2).alias("id"), F.col("p").alias("a"), F.col("q").alias("b"), "units").unionByName(rows.select((F.col("id") * 2 + 1).alias("id"), F.col("q").alias("a"), F.col("p").alias("b"), "units"))
    half = settle(half, "both-ways")
    plain = half.groupBy("a").agg(F.count("*").alias("n"), F.count_distinct("units").alias("kinds")).where("n = 2 and kinds = 1").select("a")
    go = half.join(plain, "a", "left_semi").select(F.col("a").alias("b"), F.col("id").alias("next"))
    following = half.select("id", "b").join(go, "b", "left").where("next is null or next <> (id ^ 1)").groupBy("id").agg(F.max("next").alias("next"))
    following = half.select("id").join(following, "id", "left")
    placed = settle(chains(following).join(half, "id"), "arc-edges")
    # The reverse of an arc has the reverse edges: the one with the smaller smallest edge stays.
    side = placed.groupBy("chain").agg(F.min(F.col("id")).alias("low"), F.min(F.col("id").bitwiseXOR(F.lit(1))).alias("other"))
    kept = placed.join(side.where("low < other").select("chain"), "chain", "left_semi")
    return kept.groupBy(F.col("chain").alias("arc")).agg(
        F.min("units").alias("units"), F.concat(F.array(F.min_by("a", "place")), F.transform(F.array_sort(F.collect_list(F.struct("place", "b"))), lambda s: s["b"])).alias("points")
    )


def _kept(points: list, tolerance: float) -> list[int]:
    """Places of a line's points that remain: those farthest from the chord, until all are near (Douglas and Peucker)."""
    at = np.array([(p["x"], p["y"]) for p in points])
    keep, open_ = {0, len(at) - 1}, [(0, len(at) - 1)]
    if len(at) > 2 and (at[0] == at[-1]).all():  # closed: its farthest point stays, and one more, so that it has an area
        far = int(((at - at[0]) ** 2).sum(axis=1).argmax())
        keep.add(far)
        open_ = [(0, far), (far, len(at) - 1)]
        line, rel = at[far] - at[0], at - at[0]
        away = np.abs(line[0] * rel[:, 1] - line[1] * rel[:, 0])
        keep.add(int(away.argmax()))
    while open_:
        a, z = open_.pop()
        if z - a < 2:
            continue
        line, rel = at[z] - at[a], at[a + 1 : z] - at[a]
        size = (line**2).sum()
        t = np.clip((rel @ line) / size, 0, 1) if size else np.zeros(len(rel))
        d = ((rel - t[:, None] * line) ** 2).sum(axis=1)
        i = int(d.argmax())
        if d[i] > tolerance**2:
            m = a + 1 + i
            keep.add(m)
            open_ += [(a, m), (m, z)]
    return sorted(keep)


def simplify(edges: DataFrame, tolerance: float) -> DataFrame:
    """``edges`` with each arc reduced to points within ``tolerance`` degrees of it.

    Arcs are simplified once, so neighbours go on sharing their edges. Arcs whose new
    edges meet another edge but at a common end get half the tolerance, until none do;
    at a tolerance of 0 an arc is what it was. Edges run in no particular direction.
    """
    importable(edges.sparkSession)
    kind = "array<struct<x: double, y: double>>"

    @F.udf(kind)
    def reduced(points, most):
        return points if not most else [points[i] for i in _kept(points, most)]

    rows = settle(arcs(edges).withColumn("most", F.lit(float(tolerance))), "arcs")
    for turn in range(12):
        made = settle(rows.withColumn("line", reduced("points", F.col("most"))), "simplified")
        bad = _conflicts(made)
        if bad.isEmpty():
            break
        half = F.lit(0.0) if turn >= 9 else F.col("most") / 2
        rows = settle(made.drop("line").join(bad.withColumn("bad", F.lit(True)), "arc", "left").withColumn("most", F.when(F.col("bad"), half).otherwise(F.col("most"))).drop("bad"), "arcs")
    lines = made.select(F.explode("units").alias("unit_id"), "line", F.explode(F.sequence(F.lit(1), F.size("line") - 1)).alias("i"))
    a, b = F.get("line", F.col("i") - 1), F.get("line", F.col("i"))
    return lines.select("unit_id", a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"))


def _conflicts(made: DataFrame, size: float = geometry.CELL) -> DataFrame:
    """Arcs with an edge that meets another edge but at a common end, or equals one."""
    i = F.explode(F.sequence(F.lit(1), F.size("line") - 1)).alias("i")
    rows = made.select("arc", "most", "line", i)
    a, b = F.get("line", F.col("i") - 1), F.get("line", F.col("i"))
    rows = settle(rows.select("arc", "most", "i", a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")), "new-edges")
    cells = rows.withColumn("cx", F.explode(F.sequence(geometry.cell(F.least("x1", "x2"), size), geometry.cell(F.greatest("x1", "x2"), size))))
    cells = cells.withColumn("cy", F.explode(F.sequence(geometry.cell(F.least("y1", "y2"), size), geometry.cell(F.greatest("y1", "y2"), size))))
    other = cells.select("cx", "cy", *[F.col(c).alias(f"o_{c}") for c in ("arc", "i", *EDGE)])
    pairs = cells.join(other, ["cx", "cy"]).where("(arc <> o_arc or i <> o_i) and most > 0")
    same = lambda a, b: (F.col(f"x{a}") == F.col(f"o_x{b}")) & (F.col(f"y{a}") == F.col(f"o_y{b}"))
    touch = F.greatest(*[same(a, b).cast("int") for a in (1, 2) for b in (1, 2)]) == 1
    equal = (same(1, 1) & same(2, 2)) | (same(1, 2) & same(2, 1))
    turn = lambda px, py, qx, qy, rx, ry: (F.col(qx) - F.col(px)) * (F.col(ry) - F.col(py)) - (F.col(qy) - F.col(py)) * (F.col(rx) - F.col(px))
    # With a common end they meet elsewhere only if they run the same way from it.
    flat = (turn("x1", "y1", "x2", "y2", "o_x1", "o_y1") == 0) & (turn("x1", "y1", "x2", "y2", "o_x2", "o_y2") == 0)
    reach = lambda e, o1, o2: (F.least(e + "1", e + "2") < F.greatest(o1, o2)) & (F.least(o1, o2) < F.greatest(e + "1", e + "2"))
    over = flat & (reach("x", "o_x1", "o_x2") | reach("y", "o_y1", "o_y2"))
    cross = geometry.segments_cross(*[F.col(c) for c in (*EDGE, "o_x1", "o_y1", "o_x2", "o_y2")])
    return pairs.where(F.when(touch, equal | over).otherwise(cross)).select("arc").distinct()


class NothingLeft(ValueError):
    """A clip without any land."""


def clip(edges: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Each unit's part within ``box`` (west, south, east, north), as edges.

    What an edge has in the box stays; along each side of the box the stretches in the
    unit become edges. Raises :class:`NothingLeft` if no land is left.
    """
    west, south, east, north = map(float, box)
    if not (west < east and south < north):
        raise ValueError("a box needs west < east and south < north")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    low, high = [F.lit(0.0)], [F.lit(1.0)]
    for start, d, a, z in (("x1", dx, west, east), ("y1", dy, south, north)):
        t1, t2 = (F.lit(a) - F.col(start)) / d, (F.lit(z) - F.col(start)) / d
        low.append(F.when(d == 0, 0.0).otherwise(F.least(t1, t2)))
        high.append(F.when(d == 0, 1.0).otherwise(F.greatest(t1, t2)))
    rows = edges.select("unit_id", *EDGE).withColumns({"t": F.greatest(*low), "u": F.least(*high)}).where("t < u")
    # Flat edges on a side belong to the side's stretches.
    rows = rows.where(~((dx == 0) & ((F.col("x1") <= west) | (F.col("x1") >= east))) & ~((dy == 0) & ((F.col("y1") <= south) | (F.col("y1") >= north))))
    hold = lambda c, a, z: F.greatest(F.lit(a), F.least(F.lit(z), c))
    part = lambda t, start, d, a, z: hold(F.when(F.col(t) == 1, F.col(start[0] + "2")).otherwise(F.col(start) + F.col(t) * d), a, z)
    inner = rows.select("unit_id", part("t", "x1", dx, west, east).alias("x1"), part("t", "y1", dy, south, north).alias("y1"), part("u", "x1", dx, west, east).alias("x2"), part("u", "y1", dy, south, north).alias("y2"))
    sides = []
    for along, fixed, value, a, z in (("x", "y", south, west, east), ("x", "y", north, west, east), ("y", "x", west, south, north), ("y", "x", east, south, north)):
        f1, f2, c1, c2 = F.col(f"{fixed}1"), F.col(f"{fixed}2"), F.col(f"{along}1"), F.col(f"{along}2")
        # The unit just within the side: its edges count from the value up on the lower side, below it on the upper one.
        first = (fixed, value) in (("y", south), ("x", west))
        above = lambda c, first=first, value=value: (c > value) if first else (c >= value)
        met = edges.where(above(f1) != above(f2)).select("unit_id", (c1 + (F.lit(value) - f1) / (f2 - f1) * (c2 - c1)).alias("at"))
        order = Window.partitionBy("unit_id").orderBy("at")
        spans = met.withColumns({"k": F.row_number().over(order), "to": F.lead("at").over(order)}).where("k % 2 = 1").select("unit_id", F.greatest("at", F.lit(a)).alias("p"), F.least("to", F.lit(z)).alias("q")).where("p < q")
        names = {f"{along}1": F.col("p"), f"{along}2": F.col("q"), f"{fixed}1": F.lit(value), f"{fixed}2": F.lit(value)}
        sides.append(spans.select("unit_id", *[names[c].alias(c) for c in EDGE]))
    out = settle(functools.reduce(DataFrame.unionByName, [inner, *sides]).where("x1 <> x2 or y1 <> y2"), "clipped")
    if out.isEmpty():
        raise NothingLeft(f"no land within {box}")
    return out


def extract(edges: DataFrame, units: DataFrame, box: tuple[float, float, float, float], tolerance: float, countries: list[str] | None = None) -> DataFrame:
    """The display extract: chosen countries, clipped to a box, simplified."""
    if countries and not units.where("iso_country is not null").isEmpty():
        edges = edges.join(units.where(F.col("iso_country").isin(*countries)).select("unit_id"), "unit_id", "left_semi")
    return simplify(clip(edges, box), tolerance)
