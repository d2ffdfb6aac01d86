"""Gates along a coast, at even distances and across the shore's direction.

Coast segments that meet in a position of exactly two segments form one line. Lines are
found by connected components over such positions; each line is then walked in one task
(a coastline is a map feature of at most some hundred thousand segments), and its gates
are placed by their share of its length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galetrack.functions.geodesy import direct, equal_area_x, equal_area_y, inverse
from galetrack.functions.workers import importable
from galetrack.operators import geometry
from galetrack.operators.stage import settle

FIELDS = "line long, first_x double, first_y double, place int, lon double, lat double, x1 double, y1 double, x2 double, y2 double, length_km double"


class GateError(ValueError):
    """A coast or a spacing that gives no gates."""


def coast_lines(coast: DataFrame) -> DataFrame:
    """The segments of ``coast`` (x1, y1, x2, y2) with ``line``, the number of their line."""
    rows = coast.where("x1 != x2 or y1 != y2").select("x1", "y1", "x2", "y2").withColumn("edge", F.monotonically_increasing_id())
    rows = settle(rows, "coast-segments")
    ends = rows.select("edge", F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("p"))
    joints = ends.groupBy("p").agg(F.count("*").alias("n"), F.min("edge").alias("a"), F.max("edge").alias("b")).where("n = 2")
    # Both ways, and every segment with itself, so that lone ones are lines too.
    links = joints.select(F.col("a").alias("unit_id"), F.col("b").alias("other")).union(joints.select("b", "a")).union(rows.select("edge", F.col("edge").alias("e")))
    roots = geometry.connected(settle(links.distinct(), "coast-links"))
    return rows.join(roots.select(F.col("unit_id").alias("edge"), F.col("root").alias("line")), "edge").select("line", "x1", "y1", "x2", "y2")


def walk(segments: np.ndarray) -> np.ndarray:
    """The positions along a line of segments (rows x1, y1, x2, y2), from its lesser end.

    A ring starts at its least position and goes on to the lesser of the two beside it.
    """
    beside: dict[tuple[float, float], list[tuple[float, float]]] = {}
    for x1, y1, x2, y2 in segments.tolist():
        beside.setdefault((x1, y1), []).append((x2, y2))
        beside.setdefault((x2, y2), []).append((x1, y1))
    loose = sorted(p for p, near in beside.items() if len(near) != 2)
    at = loose[0] if loose else min(beside)
    out = [at]
    for _ in range(len(segments)):
        if not beside[at]:
            break
        new = min(beside[at])
        beside[at].remove(new)
        beside[new].remove(at)
        out.append(new)
        at = new
    return np.array(out)


def place(path: np.ndarray, spacing_km: float, half_km: float) -> list[tuple]:
    """Centre, landward and seaward end of each gate along a line: (lon, lat, x1, y1, x2, y2).

    A line shorter than the spacing gets one gate in its middle. Places are shares of
    the line's length in degrees; the shore's direction is taken just around each.
    """
    steps = np.hypot(*np.diff(path, axis=0).T)
    along = np.r_[0.0, np.cumsum(steps)]
    km, _ = inverse(path[:-1, 0], path[:-1, 1], path[1:, 0], path[1:, 1], 12)
    whole = float(km.sum())
    n = 1 if whole < spacing_km else max(1, round(whole / spacing_km))
    share = (np.arange(n) + 0.5) / n
    reach = min(0.001, max(along[-1] * 1e-4, 1e-9)) / along[-1]
    spot = lambda f: (np.interp(f * along[-1], along, path[:, 0]), np.interp(f * along[-1], along, path[:, 1]))
    (lon, lat), before, after = spot(share), spot(np.maximum(0, share - reach)), spot(np.minimum(1, share + reach))
    _, bearing = inverse(*before, *after, 12)
    across = np.where((before[0] == after[0]) & (before[1] == after[1]), 0.0, bearing) + np.pi / 2
    sea, land = direct(lon, lat, across, np.full(n, half_km), 12), direct(lon, lat, across + np.pi, np.full(n, half_km), 12)
    return list(zip(lon, lat, land[0], land[1], sea[0], sea[1], np.full(n, whole)))


def generate(coast: DataFrame, spacing_km: float, half_km: float, edges: DataFrame | None = None, units: DataFrame | None = None, prefix: str = "G") -> DataFrame:
    """gate_id, gate_name, region, sort_order, x1, y1, x2, y2 (landward to seaward).

    With ``edges`` and ``units`` the region is the unit nearest to the centre in the
    equal-area projection, the first by number of equally near ones.
    """
    if spacing_km <= 0:
        raise GateError(f"the spacing must be positive: {spacing_km}")
    importable(coast.sparkSession)

    def gates_of(line: pd.DataFrame) -> pd.DataFrame:
        path = walk(line[["x1", "y1", "x2", "y2"]].to_numpy(float))
        rows = [(line["line"].iloc[0], *path[0], i, *g) for i, g in enumerate(place(path, spacing_km, half_km))]
        return pd.DataFrame(rows, columns=[f.split()[0] for f in FIELDS.split(", ")])

    rows = settle(coast_lines(coast).groupBy("line").applyInPandas(gates_of, FIELDS), "coast-gates")
    if rows.isEmpty():
        raise GateError("the coast has no segment")
    # Gates are map features: thousands, numbered in one window.
    order = Window.partitionBy(F.lit(0)).orderBy("first_x", "first_y", "line", "place")
    rows = rows.withColumn("sort_order", F.row_number().over(order) - 1)
    rows = settle(rows.withColumn("gate_id", F.concat(F.lit(prefix), F.lpad(F.col("sort_order").cast("string"), 5, "0"))), "numbered-gates")
    name, region = F.lit(None).cast("string").alias("gate_name"), F.lit(None).cast("string").alias("region")
    if edges is not None and units is not None:
        flat = lambda x, y: ((equal_area_x(x) / 111_000).alias("__x"), (equal_area_y(y) / 111_000).alias("__y"))
        points = rows.select("gate_id", *flat(F.col("lon"), F.col("lat")))
        sides = edges.select("unit_id", *[c.alias(n) for a, b in (("x1", "y1"), ("x2", "y2")) for n, c in zip((a, b), flat(F.col(a), F.col(b)))])
        near = geometry.nearest_edge(points, ["gate_id"], sides, "unit_id", "__x", "__y").select("gate_id", "unit_id")
        rows = rows.join(near, "gate_id", "left").join(units.select("unit_id", "admin1_name", "country_name"), "unit_id", "left")
        name, region = F.when(F.col("admin1_name").isNotNull(), F.concat_ws(", ", "admin1_name", "country_name")).alias("gate_name"), F.col("admin1_name").alias("region")
    return rows.select("gate_id", name, region, "sort_order", "x1", "y1", "x2", "y2")
