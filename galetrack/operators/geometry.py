"""Spatial operators as relational rewrites over edge tables.

A polygon set is a table of edges (unit, x1, y1, x2, y2) in degrees. Joins go
through grid cells, so nothing is compared with everything: the build side of a
point-in-polygon join is one row for each cell, and Spark broadcasts it only
while it is small.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galetrack.functions.geodesy import equal_area_x, equal_area_y, haversine_km, with_geodesic
from galetrack.functions.workers import importable
from galetrack.operators.stage import settle

#: Cell width in degrees of the containment grid and of the finest nearest-edge grid.
CELL = 1.0
#: Up to so many edges are scanned from a broadcast array instead of joined by cell.
FEW_EDGES = 512
#: Up to so many links between units are joined up on the driver.
MOST_LINKS = 100_000


def cell(x: Column, size: float = CELL) -> Column:
    return F.floor(x / F.lit(size)).cast("int")


def normalised(edges: DataFrame) -> DataFrame:
    """Edges with ends in a fixed order, so that shared edges are equal."""
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    return edges.withColumns({"p": F.least(a, b), "q": F.greatest(a, b)})


def split_edges(edges: DataFrame, size: float = CELL) -> DataFrame:
    """``edges`` cut at every vertex that lies on them, so that partly shared borders are equal edges.

    Vertices meet edges by grid cell.
    """
    rows = settle(edges.select("unit_id", "x1", "y1", "x2", "y2").withColumn("edge", F.monotonically_increasing_id()), "whole-edges")
    ends = F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("p")
    spots = rows.select(ends).select("p.x", "p.y").distinct().withColumns({"cx": cell(F.col("x"), size), "cy": cell(F.col("y"), size)})
    covers = rows.withColumn("cx", F.explode(F.sequence(cell(F.least("x1", "x2"), size), cell(F.greatest("x1", "x2"), size))))
    covers = covers.withColumn("cy", F.explode(F.sequence(cell(F.least("y1", "y2"), size), cell(F.greatest("y1", "y2"), size))))
    dx, dy, px, py = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.col("x") - F.col("x1"), F.col("y") - F.col("y1")
    t = (px * dx + py * dy) / (dx * dx + dy * dy)
    on = (dx * dx + dy * dy > 0) & (F.abs(px * dy - py * dx) <= F.lit(1e-12) * (dx * dx + dy * dy)) & (t > 1e-12) & (t < 1 - 1e-12)
    cuts = covers.join(spots, ["cx", "cy"]).where(on).groupBy("edge").agg(F.array_sort(F.collect_set(F.struct(t.alias("t"), "x", "y"))).alias("cuts"))
    spot = lambda x, y, at: F.array(F.struct(F.lit(at).alias("t"), F.col(x).alias("x"), F.col(y).alias("y")))
    path = F.concat(spot("x1", "y1", 0.0), F.coalesce("cuts", F.array().cast("array<struct<t: double, x: double, y: double>>")), spot("x2", "y2", 1.0))
    out = rows.join(cuts, "edge", "left").withColumn("path", path).select("unit_id", "path", F.explode(F.sequence(F.lit(1), F.size("path") - 1)).alias("i"))
    a, b = F.get("path", F.col("i") - 1), F.get("path", F.col("i"))
    return out.select("unit_id", a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"))


def boundary_edges(edges: DataFrame) -> DataFrame:
    """Edges of the union's boundary: those that occur an odd number of times."""
    once = normalised(edges).groupBy("p", "q").agg(F.count("*").alias("n"), F.min("unit_id").alias("unit_id")).where("n % 2 = 1")
    return once.select("unit_id", F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("q.x").alias("x2"), F.col("q.y").alias("y2"))


def country_coastline(edges: DataFrame, units: DataFrame, countries: list[str]) -> DataFrame:
    """Boundary of the selected countries' union (with its borders to other countries)."""
    chosen = units.where(F.col("iso_country").isin(*countries)).select("unit_id")
    return boundary_edges(edges.join(chosen, "unit_id", "left_semi"))


def unit_areas(edges: DataFrame) -> DataFrame:
    """unit_id and area in km2: the shoelace sum in an equal-area projection."""
    x1, x2, y1, y2 = equal_area_x(F.col("x1")), equal_area_x(F.col("x2")), equal_area_y(F.col("y1")), equal_area_y(F.col("y2"))
    return edges.groupBy("unit_id").agg((F.abs(F.sum(x1 * y2 - x2 * y1)) / 2e6).alias("area_km2"))


def connected_units(edges: DataFrame) -> DataFrame:
    """unit_id and root, the least unit that shared edges connect it to.

    Units are map features, thousands at most; labels are spread along shared
    edges and shortened by the label's label until they stay.
    """
    shared = normalised(edges).select("unit_id", "p", "q")
    other = shared.withColumnRenamed("unit_id", "other")
    links = shared.join(other, ["p", "q"]).select("unit_id", "other").distinct()
    return connected(settle(links, "unit-links"))


def connected(links: DataFrame) -> DataFrame:
    """unit_id and root, the least number it is connected to, from links (unit_id, other) in both directions."""
    if links.count() <= MOST_LINKS:
        return _connected_on_driver(links)
    labels = links.groupBy("unit_id").agg(F.min("other").alias("root"))
    while True:
        near = links.join(labels.select(F.col("unit_id").alias("other"), F.col("root").alias("r")), "other").groupBy("unit_id").agg(F.min("r").alias("r"))
        up = labels.select(F.col("unit_id").alias("root"), F.col("root").alias("above"))
        new = labels.join(near, "unit_id").join(up, "root").select("unit_id", F.least("r", "above").alias("root"), F.col("root").alias("old"))
        new = settle(new, "unit-roots")
        labels = new.select("unit_id", "root")
        if new.where("root != old").isEmpty():
            return labels


def _connected_on_driver(links: DataFrame) -> DataFrame:
    """The same for a number of links that has been checked."""
    root: dict[int, int] = {}

    def find(u: int) -> int:
        while root.setdefault(u, u) != u:
            root[u] = u = root[root[u]]
        return u

    for a, b in links.collect():
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return links.sparkSession.createDataFrame([(u, find(u)) for u in sorted(root)], T.StructType([T.StructField(n, links.schema["unit_id"].dataType) for n in ("unit_id", "root")]))


def landmasses(edges: DataFrame) -> DataFrame:
    """unit_id, landmass_id (rank by area, largest 0; ties to the least unit) and landmass_area_km2."""
    areas = connected_units(edges).join(unit_areas(edges), "unit_id")
    whole = areas.groupBy("root").agg(F.sum("area_km2").alias("landmass_area_km2"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc(F.round("landmass_area_km2", 6)), "root")
    ranked = whole.withColumn("landmass_id", (F.row_number().over(order) - 1).cast("int"))
    return areas.join(ranked, "root").select("unit_id", "landmass_id", "landmass_area_km2")


def mainland_landmass(units: DataFrame, masses: DataFrame, country: str) -> int | None:
    """The largest landmass that meets a country."""
    row = units.where(F.col("iso_country") == country).join(masses, "unit_id").agg(F.min("landmass_id").alias("m")).first()
    return row["m"]


def nearest_on_edge(px: Column, py: Column) -> tuple[Column, Column]:
    """The nearest position of the edge (x1, y1, x2, y2), in the plane of degrees."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    size = dx * dx + dy * dy
    t = F.when(size == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - F.col("x1")) * dx + (py - F.col("y1")) * dy) / size)))
    return F.col("x1") + t * dx, F.col("y1") + t * dy


def nearest_edge(points: DataFrame, key: list[str], edges: DataFrame, edge_id: str, x: str = "longitude", y: str = "latitude", levels: tuple[float, ...] = (1.0, 4.0, 16.0, 64.0, 256.0)) -> DataFrame:
    """key, ``edge_id``, near_x, near_y and near_degrees of each point's nearest edge.

    Nearness is planar in degrees; ties go to the smallest id. A set of at most
    ``FEW_EDGES`` edges is compared as a whole with every point. Beyond that,
    grids grow from level to level: in a point's 3 x 3 cells, any edge nearer than
    one cell's width is present, so a best distance up to that width is final, and
    only the other points go on. The last level's cells hold the globe.
    """
    left = points.select(*key, F.col(x).alias("__px"), F.col(y).alias("__py")).where("__px is not null and __py is not null")
    if edges.count() <= FEW_EDGES:
        return _nearest_of_few(left, key, edges, edge_id)
    left, done = settle(left, "nearest-points"), []
    for level, size in enumerate(levels):
        covers = edges.withColumn("__cx", F.explode(F.sequence(cell(F.least("x1", "x2"), size), cell(F.greatest("x1", "x2"), size))))
        covers = covers.withColumn("__cy", F.explode(F.sequence(cell(F.least("y1", "y2"), size), cell(F.greatest("y1", "y2"), size))))
        near = left.withColumn("__cx", F.explode(F.sequence(cell(F.col("__px"), size) - 1, cell(F.col("__px"), size) + 1)))
        near = near.withColumn("__cy", F.explode(F.sequence(cell(F.col("__py"), size) - 1, cell(F.col("__py"), size) + 1)))
        nx, ny = nearest_on_edge(F.col("__px"), F.col("__py"))
        met = near.join(covers, ["__cx", "__cy"]).withColumns({"near_x": nx, "near_y": ny})
        d = F.sqrt(F.pow(F.col("near_x") - F.col("__px"), F.lit(2.0)) + F.pow(F.col("near_y") - F.col("__py"), F.lit(2.0)))
        met = met.withColumn("near_degrees", d)
        best = met.groupBy(*key).agg(F.min(F.struct(F.round("near_degrees", 12).alias("r"), F.col(edge_id).alias("id"), "near_x", "near_y", "near_degrees")).alias("best"))
        best = best.select(*key, F.col("best.id").alias(edge_id), "best.near_x", "best.near_y", "best.near_degrees")
        final = best if level == len(levels) - 1 else best.where(F.col("near_degrees") <= size)
        final = settle(final, "nearest-level")
        done.append(final)
        left = settle(left.join(final.select(*key), key, "left_anti"), "nearest-points")
    return functools.reduce(DataFrame.unionByName, done)


def _nearest_of_few(left: DataFrame, key: list[str], edges: DataFrame, edge_id: str) -> DataFrame:
    """Every point against all edges, whose number has been checked, as Arrow-batched NumPy."""
    rows = sorted(tuple(r) for r in edges.select(edge_id, "x1", "y1", "x2", "y2").collect())
    kind = edges.schema[edge_id].dataType.simpleString()
    if not rows:
        return left.where("false").select(*key, F.lit(None).cast(kind).alias(edge_id), *[F.lit(None).cast("double").alias(c) for c in ("near_x", "near_y", "near_degrees")])
    importable(left.sparkSession)
    ids = [r[0] for r in rows]
    rank = np.unique(np.array(ids), return_inverse=True)[1]
    x1, y1, x2, y2 = (np.array([r[i] for r in rows], dtype=float) for i in (1, 2, 3, 4))

    @F.pandas_udf(f"struct<id: {kind}, near_x: double, near_y: double, near_degrees: double>")
    def best(xs: pd.Series, ys: pd.Series) -> pd.DataFrame:
        out = []
        dx, dy = x2 - x1, y2 - y1
        size = dx * dx + dy * dy
        for a in range(0, len(xs), 4096):
            px, py = xs.to_numpy(float)[a : a + 4096, None], ys.to_numpy(float)[a : a + 4096, None]
            t = np.where(size == 0, 0.0, np.clip(((px - x1) * dx + (py - y1) * dy) / np.where(size == 0, 1.0, size), 0.0, 1.0))
            nx, ny = x1 + t * dx, y1 + t * dy
            d = np.sqrt((nx - px) ** 2 + (ny - py) ** 2)
            # Of equally near ones the smallest id, then the first position.
            mask = np.ones(d.shape, dtype=bool)
            for value in (np.round(d, 12), np.broadcast_to(rank, d.shape), nx, ny):
                low = np.where(mask, value, np.inf).min(axis=1, keepdims=True)
                mask &= value == low
            at, row = mask.argmax(axis=1), np.arange(len(d))
            out.append(pd.DataFrame({"id": [ids[i] for i in at], "near_x": nx[row, at], "near_y": ny[row, at], "near_degrees": d[row, at]}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "near_x": [], "near_y": [], "near_degrees": []})

    met = left.withColumn("best", best("__px", "__py"))
    return met.select(*key, F.col("best.id").alias(edge_id), "best.near_x", "best.near_y", "best.near_degrees")


def with_distance(df: DataFrame, out: str, lon1: str, lat1: str, lon2: str, lat2: str, planar: bool = False) -> DataFrame:
    """``df`` with the geodesic in km between two positions, or with ``planar`` the arc on the mean sphere."""
    if planar:
        return df.withColumn(out, haversine_km(F.col(lon1), F.col(lat1), F.col(lon2), F.col(lat2)))
    return with_geodesic(df, out, lon1, lat1, lon2, lat2, iterations=12)


def distance_to_coast(points: DataFrame, key: list[str], coast: DataFrame, x: str = "longitude", y: str = "latitude", planar: bool = False) -> DataFrame:
    """key, min_distance_to_coast_km, nearest_coast_lon and nearest_coast_lat: to the planar-nearest position."""
    # Edges have no number of their own: of equally near positions the first in (lon, lat) counts.
    numbered = coast.withColumn("edge", F.lit(0))
    near = nearest_edge(points, key, numbered, "edge", x, y)
    joined = near.join(points.select(*key, F.col(x).alias("__x"), F.col(y).alias("__y")), key)
    found = with_distance(joined, "min_distance_to_coast_km", "__x", "__y", "near_x", "near_y", planar)
    return found.select(*key, "min_distance_to_coast_km", F.col("near_x").alias("nearest_coast_lon"), F.col("near_y").alias("nearest_coast_lat"))


def segments_cross(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column, dx: Column, dy: Column) -> Column:
    """Whether segments a-b and c-d share a position (orientation test)."""

    def turn(px: Column, py: Column, qx: Column, qy: Column, rx: Column, ry: Column) -> Column:
        return F.signum((qx - px) * (ry - py) - (qy - py) * (rx - px))

    one, two = turn(ax, ay, bx, by, cx, cy), turn(ax, ay, bx, by, dx, dy)
    three, four = turn(cx, cy, dx, dy, ax, ay), turn(cx, cy, dx, dy, bx, by)
    boxes = (F.least(ax, bx) <= F.greatest(cx, dx)) & (F.least(cx, dx) <= F.greatest(ax, bx)) & (F.least(ay, by) <= F.greatest(cy, dy)) & (F.least(cy, dy) <= F.greatest(ay, by))
    return boxes & (one * two <= 0) & (three * four <= 0)
