"""Structural checks of a built database.

Each table is read once: its rows are summed up by storm, the sums of all tables meet in
one row for each storm, and one aggregate over those gives every check. A build that was
watched (:func:`watch`) has counted the row-level failures on its own writes, and these
are taken from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from galetrack.functions import domain
from galetrack.sources.besttrack import RADII

MEASURED = ("max_wind_kt", "min_pressure_mb", "radius_max_wind_nm", *RADII)


def _not_in(column: str, values) -> Column:
    return ~F.coalesce(F.col(column).isin(*values), F.lit(False))


def _outside(column: str, low: float, high: float, missing: bool) -> Column:
    """Beyond a range; ``missing``: whether null is beyond it too."""
    return ~F.coalesce(F.col(column).between(low, high), F.lit(not missing))


def row_checks(table: str, columns: list[str]) -> dict[str, Column]:
    """What makes a row of a table fail, by check."""
    if table == "track_points":
        held = [c for c in MEASURED if c in columns]
        return {
            "sentinels": F.coalesce(F.exists(F.array(*[F.col(c).cast("double") for c in held]), lambda v: v.isin(*map(float, domain.MISSING))), F.lit(False)),
            "coordinates_on_globe": _outside("latitude", -90, 90, True) | _outside("longitude", -180, 180, True),
            "distance_present": F.col("min_distance_to_coast_km").isNull(),
            "statuses": _not_in("status", domain.STATUSES),
            "record_identifiers": F.col("record_identifier").isNotNull() & _not_in("record_identifier", domain.RECORD_IDENTIFIERS),
            "categories": _not_in("ss_category", domain.CATEGORIES),
            "latitudes": _outside("latitude", -90, 90, True), "longitudes": _outside("longitude", -180, 180, True),
            "winds": _outside("max_wind_kt", 0, 200, False), "pressures": _outside("min_pressure_mb", 850, 1050, False),
            "numbered_categories_are_hurricanes": F.col("ss_category").isin("1", "2", "3", "4", "5") & ~F.coalesce(F.col("max_wind_kt") >= 64, F.lit(False)),
        }
    if table == "landfalls":
        native = F.col("detection_method").isin("native", "native_confirmed")
        return {
            "native_never_demoted": native & ~F.col("is_landfall"),
            "reentries_are_inferred": ~F.col("is_landfall") & native,
            "us_landfalls_have_unit": F.col("is_us_landfall") & F.col("landfall_admin1").isNull(),
            "exact_iff_zero_distance": ~F.col("is_attribution_exact").eqNullSafe(F.col("landfall_admin_distance_km").eqNullSafe(F.lit(0.0))),
            "geometric_is_exact": (F.col("detection_method") != "native") & ~F.col("is_attribution_exact"),
        }
    return {}


def watch(df: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """``df``, which counts its failing rows when it is written."""
    seen = Observation(f"checks_{table}")
    return df.observe(seen, F.count("*").alias("rows"), *[F.count_if(bad).alias(name) for name, bad in row_checks(table, df.columns).items()]), seen


def run(db) -> DataFrame:
    """check, result ('PASS' or 'FAIL'), failures and detail of each of 29 checks."""
    seen = {name: o.get for name, o in db.observations.items()}
    count = lambda rows, table: [] if table in seen else [F.count_if(bad).alias(f"c_{name}") for name, bad in row_checks(table, rows.columns).items()]
    s, p, b, g = db.storms, db.track_points, db.bypasses, db.landfall_gates
    gates = g.groupBy("gate_id").agg(F.count("*").alias("n_gates"))
    falls = db.landfalls.join(gates, "gate_id", "left")
    declared = F.max("n_declared") if "n_declared" in s.columns else F.lit(None).cast("int")
    storms = s.groupBy("storm_id").agg(F.count("*").alias("s_rows"), F.max("n_track_points").alias("s_points"), F.max("n_landfalls").alias("s_landfalls"), declared.alias("s_declared"))
    points = p.groupBy("storm_id").agg(F.count("*").alias("p_rows"), F.count_distinct("point_seq").alias("p_places"), *count(p, "track_points"))
    own = F.col("is_landfall")
    land = falls.groupBy("storm_id").agg(
        F.count("*").alias("l_rows"), F.count_if(own).alias("l_landfalls"), F.count_if(F.col("gate_id").isNotNull() & F.col("n_gates").isNull()).alias("l_orphans"),
        F.min(F.when(own, F.col("landfall_seq"))).alias("l_first"), F.max(F.when(own, F.col("landfall_seq"))).alias("l_last"), F.count_distinct(F.when(own, F.col("landfall_seq"))).alias("l_kinds"), *count(db.landfalls, "landfalls"),
    )
    near = b.groupBy("storm_id").agg(F.count("*").alias("b_rows"))
    whole = storms
    for rows in (points, land, near):
        whole = whole.join(rows, "storm_id", "full")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    orphan = F.col("s_rows").isNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    found = {
        "unique_storms": total(F.greatest(n("s_rows") - 1, F.lit(0))), "unique_points": total(n("p_rows") - n("p_places")), "unique_bypasses": total(F.greatest(n("b_rows") - 1, F.lit(0))),
        "points_have_storm": total(F.when(orphan, n("p_rows"))), "landfalls_have_storm": total(F.when(orphan, n("l_rows"))), "bypasses_have_storm": total(F.when(orphan, n("b_rows"))),
        "landfalls_have_gate": total("l_orphans"), "bypass_and_landfall_disjoint": F.count_if((n("b_rows") > 0) & (n("l_landfalls") > 0)),
        "declared_point_counts": F.count_if(F.col("s_declared") != n("p_rows")), "point_counts": F.count_if(~orphan & (n("s_points") != n("p_rows"))),
        "landfall_counts": F.count_if(~orphan & (n("s_landfalls") != n("l_landfalls"))), "sequences_contiguous": F.count_if((n("l_kinds") > 0) & ((F.col("l_first") != 1) | (F.col("l_last") != F.col("l_kinds")))),
    }
    of = {"unique_storms": "s_rows", "unique_points": "p_rows", "unique_bypasses": "b_rows", "points_have_storm": "p_rows", "landfalls_have_storm": "l_rows", "bypasses_have_storm": "b_rows", "landfalls_have_gate": "l_rows"}
    sizes = {c: total(c) for c in ("s_rows", "p_rows", "l_rows", "b_rows")}
    for table, size in (("track_points", "p_rows"), ("landfalls", "l_rows")):
        for name in row_checks(table, getattr(db, table).columns):
            found[name] = F.lit(seen[table][name]).cast("long") if table in seen else total(f"c_{name}")
            of[name] = size
    one = whole.agg(*[v.alias(k) for k, v in found.items()], *[v.alias(k) for k, v in sizes.items()])
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("failures"), F.col(of.get(k, "s_rows")).alias("rows")) for k in found])).alias("c")).select("c.*")
    rows = rows.unionByName(gates.agg(total(F.col("n_gates") - 1).alias("failures"), total("n_gates").alias("rows")).select(F.lit("unique_gates").alias("check"), "failures", "rows"))
    return rows.select("check", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("result"), "failures", F.format_string("%d of %d", "failures", "rows").alias("detail"))
