"""Registered queries on land itself: its cover, its rings, and what is done to them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galetrack.functions import wkb
from galetrack.operators import cover, geometry, rings
from galetrack.operators.stage import settle, shared_root
from galetrack.plans import planar, storms
from galetrack.sources import geoparquet

#: name: (rows of the inputs and their cover, SQL).
QUERIES: dict[str, tuple[Callable[[storms.Inputs, DataFrame], DataFrame], str]] = {}
PIECES = 16
CLIP = (-100.0, 10.0, -70.0, 30.0)


def put(name: str, sql: str):
    def held(make):
        QUERIES[name] = make, sql
        return make

    return held


def fine(edges: DataFrame) -> DataFrame:
    """Every side in ``PIECES`` parts."""
    i = F.col("i")
    at = lambda a, b, k: F.col(a) + (F.col(b) - F.col(a)) * k / PIECES
    rows = edges.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))))
    return rows.select("unit_id", at("x1", "x2", i).alias("x1"), at("y1", "y2", i).alias("y1"), at("x1", "x2", i + 1).alias("x2"), at("y1", "y2", i + 1).alias("y2"))


_LEVELS = f"""
levels as (select unnest(range({cover.LEAST_LEVEL + 1})) as level),
sized as (select cast(level as int) as level, {cover.WIDTH} / pow(2, level) as w from levels),
own as (select level, w, unit_id, e[1] / 10000.0 as xa, e[2] / 10000.0 as ya, e[3] / 10000.0 as xb, e[4] / 10000.0 as yb from sides cross join sized),
touched as (select level, unit_id, xa, ya, xb, yb, unnest(range(cast(ceil(xa / w) - 1 as bigint), cast(floor(xb / w) + 1 as bigint))) as cx, w from own),
met as (select level, unit_id, xa, ya, xb, yb, cx, unnest(range(cast(ceil(ya / w) - 1 as bigint), cast(floor(yb / w) + 1 as bigint))) as cy from touched),
border as (select level, cx, cy, count(*) as edges from met group by 1, 2, 3),
top as (select 0 as level, unnest(range(cast(ceil(xa / {cover.WIDTH}) - 1 as bigint), cast(floor(xb / {cover.WIDTH}) + 1 as bigint))) as cx, ya, yb from box),
under as (select level, cx, cy from (select level, cx, unnest(range(cast(ceil(ya / {cover.WIDTH}) - 1 as bigint), cast(floor(yb / {cover.WIDTH}) + 1 as bigint))) as cy from top)
          union select level + 1, cx * 2 + i, cy * 2 + j from border cross join (select unnest([0, 1]) as i) cross join (select unnest([0, 1]) as j) where level < {cover.LEAST_LEVEL}),
empty as (select u.level, (u.cx + 0.5) * w as x, (u.cy + 0.5) * w as y from under u join sized s on s.level = u.level where not exists (select 1 from border b where b.level = u.level and b.cx = u.cx and b.cy = u.cy))
"""


@put(
    "cover_levels",
    planar.over_tables("select * from sides cross join box").replace("select * from sides cross join box", "").rstrip() + "," + _LEVELS + f"""
select level, 'land' as kind, count(*) as cells, cast(0 as bigint) as edges from empty where exists (select 1 from box where x > xa and x < xb and y > ya and y < yb) group by 1
union all select level, case when level < {cover.LEAST_LEVEL} then 'cut' else 'boundary' end, count(*), cast(case when level < {cover.LEAST_LEVEL} then 0 else sum(edges) end as bigint) from border group by 1
""",
)
def cover_levels(i, land):
    """How many cells of each kind and level the cover has, and the edges in them."""
    return cover.counts(land)


@put(
    "points_on_sides",
    planar.over_tables(
        "select unit_id as of_unit, p, case when not exists (select 1 from coast c where x between c.x1 and c.x2 and y between c.y1 and c.y2)"
        " then (select min(h.unit_id) from box h where x between h.xa and h.xb and y between h.ya and h.yb) end as unit_id"
        " from (select unit_id, unnest([[0, xa, ya], [1, xb, ya], [2, xa, yb], [3, xb, yb], [4, (xa + xb) / 2, ya], [5, (xa + xb) / 2, yb], [6, xa, (ya + yb) / 2], [7, xb, (ya + yb) / 2], [8, (xa + xb) / 2, (ya + yb) / 2]]) as s from box),"
        " lateral (select cast(s[1] as int) as p, s[2] as x, s[3] as y)"
    ),
)
def points_on_sides(i, land):
    """Corners, middles of sides and middles of each unit: which unit holds them."""
    box = i.edges.groupBy("unit_id").agg(F.min("x1").alias("xa"), F.max("x1").alias("xb"), F.min("y1").alias("ya"), F.max("y1").alias("yb"))
    xa, xb, ya, yb = (F.col(c) for c in ("xa", "xb", "ya", "yb"))
    spots = [(xa, ya), (xb, ya), (xa, yb), (xb, yb), ((xa + xb) / 2, ya), ((xa + xb) / 2, yb), (xa, (ya + yb) / 2), (xb, (ya + yb) / 2), ((xa + xb) / 2, (ya + yb) / 2)]
    points = box.select(F.col("unit_id").alias("of_unit"), F.explode(F.array(*[F.struct(F.lit(k).alias("p"), x.alias("longitude"), y.alias("latitude")) for k, (x, y) in enumerate(spots)])).alias("s")).select("of_unit", "s.*")
    return cover.with_unit(points, land).select("of_unit", "p", "unit_id")


@put(
    "fine_coast",
    planar.over_tables(
        f"select f.storm_id, f.point_seq, {planar.HELD.format(x='f.longitude', y='f.latitude')} as unit_id, round(sqrt(pow(nx - f.longitude, 2) + pow(ny - f.latitude, 2)), 6) as degrees from fixes f join shore using (storm_id, point_seq)"
    ),
)
def fine_coast(i, land):
    """Fixes over a coast of more edges than are compared one by one: unit and distance in degrees."""
    edges = settle(fine(i.edges), "fine-edges")
    shore = settle(geometry.boundary_edges(edges).withColumn("edge", F.lit(0)), "fine-shore")
    near = geometry.nearest_edge(i.points, ["storm_id", "point_seq"], shore, "edge")
    held = cover.with_unit(i.points.select("storm_id", "point_seq", "longitude", "latitude"), settle(cover.build(edges), "fine-cover"))
    return held.join(near, ["storm_id", "point_seq"]).select("storm_id", "point_seq", "unit_id", F.round("near_degrees", 6).alias("degrees"))


@put(
    "landmass_rings",
    planar.over_tables(
        "select root as landmass, cast(0 as int) as is_hole, n as edges, round(landmass_area_km2, 3) as area_km2 from masses join"
        " (select run, count(*) as n from coast c join sides s on s.e = [round(x1 * 10000), round(y1 * 10000), round(x2 * 10000), round(y2 * 10000)] join runs using (unit_id) group by run) using (run)"
    ),
)
def landmass_rings(i, land):
    """The polygons of the union: rings of each landmass, with their edges and areas."""
    traced = rings.polygons(i.edges, land)
    return rings.with_area(traced.drop("is_hole"), "landmass").select("landmass", F.col("is_hole").cast("int").alias("is_hole"), "edges", F.round("area_km2", 3).alias("area_km2"))


@put(
    "geo_landmasses",
    planar.over_tables(
        "select root as landmass, cast(1 as int) as polygons, cast(n + 1 as int) as vertices, round(a, 6) as xmin, round(b, 6) as ymin, round(c, 6) as xmax, round(d, 6) as ymax from masses"
        " join (select run, count(*) as n from coast c join sides s on s.e = [round(x1 * 10000), round(y1 * 10000), round(x2 * 10000), round(y2 * 10000)] join runs using (unit_id) group by run) using (run)"
        " join (select run, min(xa) as a, min(ya) as b, max(xb) as c, max(yb) as d from box join runs using (unit_id) group by run) using (run)"
        f" where a <= {CLIP[2]} and c >= {CLIP[0]} and b <= {CLIP[3]} and d >= {CLIP[1]}"
    ),
)
def geo_landmasses(i, land):
    """Landmasses as polygons in a GeoParquet table, those whose box meets another read back."""
    made = rings.closed(rings.polygons(i.edges, land), "landmass")
    path = f"{shared_root(i.edges.sparkSession)}/geo-landmasses-{uuid.uuid4().hex}"
    geoparquet.write(geoparquet.polygons(made, F.col("parts")).drop("parts"), path)
    back = geoparquet.read(i.edges.sparkSession, path, CLIP).withColumn("parts", wkb.as_polygons(F.col("geometry")))
    corners = [F.round(f"bbox.{c}", 6).alias(c) for c in geoparquet.BOX]
    return back.select("landmass", F.size("parts").alias("polygons"), F.size(F.flatten(F.flatten("parts"))).alias("vertices"), *corners)


def _area(xa: str, xb: str, ya: str, yb: str) -> str:
    return f"round(6378.137 * 6378.137 * radians({xb} - {xa}) * ({planar._Q.format(y=yb)} - {planar._Q.format(y=ya)}) / 2, 3)"


@put(
    "clipped_units",
    planar.over_tables(
        f"select unit_id, {_area('a', 'b', 'c', 'd')} as area_km2 from (select unit_id, greatest(xa, {CLIP[0]}) as a, least(xb, {CLIP[2]}) as b, greatest(ya, {CLIP[1]}) as c, least(yb, {CLIP[3]}) as d from box) where a < b and c < d"
    ),
)
def clipped_units(i, land):
    """What a box leaves of each unit."""
    return _areas(rings.clip(i.edges, CLIP))


def _areas(edges: DataFrame) -> DataFrame:
    """unit_id and area_km2 of edges that run in any direction: rings without their holes."""
    signed = F.when(F.col("is_hole"), -F.col("area_km2")).otherwise(F.col("area_km2"))
    return rings.with_area(rings.own_rings(edges), "unit_id").groupBy("unit_id").agg(F.round(F.sum(signed), 3).alias("area_km2"))


@put("simplified_units", planar.over_tables(f"select unit_id, {_area('xa', 'xb', 'ya', 'yb')} as area_km2, cast(1 as int) as fewer from box"))
def simplified_units(i, land):
    """Sides in sixteen parts, simplified as shared arcs: the areas stay, the edges are few again."""
    made = settle(rings.simplify(fine(i.edges), 0.01), "simple-edges")
    return _areas(made).join(made.groupBy("unit_id").agg((F.count("*") <= 12).cast("int").alias("fewer")), "unit_id")


@put("repaired_units", planar.over_tables(f"select unit_id, {_area('xa', 'xb', 'ya', 'yb')} as area_km2, 'repeated vertex; spike or doubled line' as faults from box"))
def repaired_units(i, land):
    """Units with a spike and a repeated vertex each, mended."""
    corner = i.edges.groupBy("unit_id").agg(F.max(F.struct("x1", "y1")).alias("c")).select("unit_id", F.col("c.x1").alias("x"), F.col("c.y1").alias("y"))
    tip = F.col("x") + 0.125
    spoiled = i.edges
    for ends in (("x", "y", tip, "y"), (tip, "y", "x", "y"), ("x", "y", "x", "y")):
        spoiled = spoiled.unionByName(corner.select("unit_id", *[(F.col(e) if isinstance(e, str) else e).alias(c) for e, c in zip(ends, rings.EDGE)]))
    good, bad = rings.repair(spoiled)
    area = rings.with_area(good, "unit_id").select("unit_id", F.round("area_km2", 3).alias("area_km2"))
    return area.join(bad.groupBy("unit_id").agg(F.concat_ws("; ", F.array_sort(F.collect_list("fault"))).alias("faults")), "unit_id")
