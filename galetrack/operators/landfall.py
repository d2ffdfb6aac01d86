"""Detection, reconciliation and sequencing of landfalls.

Tracks are tables of fixes (storm_id, point_seq, ...). Every step is a window over
one storm or a join by storm, so storms spread over the cluster; a storm has some
hundred fixes at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galetrack.functions import domain
from galetrack.operators import cover, geometry

FIX = ("timestamp_utc", "longitude", "latitude", "max_wind_kt", "min_pressure_mb", "status", "flagged")


def segments(points: DataFrame) -> DataFrame:
    """Consecutive pairs of fixes: storm_id, seg, a_* and b_*."""
    rows = points.withColumn("flagged", F.coalesce(F.col("record_identifier") == "L", F.lit(False)))
    rows = rows.select("storm_id", F.col("point_seq").alias("seg"), F.struct(*FIX).alias("a"), F.lead(F.struct(*FIX)).over(Window.partitionBy("storm_id").orderBy("point_seq")).alias("b"))
    rows = rows.where("b is not null")
    return rows.select("storm_id", "seg", *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "ab" for c in FIX])


def densify(segs: DataFrame, step_km: float = 1.0, planar: bool = False) -> DataFrame:
    """Samples along segments: storm_id, seg, j, n, lon, lat; n equal parts of at most a step.

    ``planar`` interpolates in degrees and measures on the sphere; else samples lie
    on the geodesic. Longitudes are unwrapped, so a segment over the antimeridian
    stays short.
    """
    rows = cover.parts(segs, step_km, planar)
    rows = cover.positions(rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n")))), planar, j="lon,lat")
    return rows.select("storm_id", "seg", "j", "n", "lon", "lat")


def crossings(segs: DataFrame, land: DataFrame, step_km: float = 1.0, planar: bool = False) -> DataFrame:
    """Water-to-land transitions: storm_id, seg, o (ordinal in the segment), n, j, lon, lat, unit_id.

    j is the first sample on land; (before_lon, before_lat) the last one at sea. ``land``
    is a cover; only samples of stretches in its boundary cells are rows.
    """
    rows = cover.stretches(cover.parts(cover.near_land(segs, land), step_km, planar), land, planar)
    along = Window.partitionBy("storm_id", "seg").orderBy("j")
    rows = rows.withColumns({"nth": F.row_number().over(along), "was": F.lag("over").over(along)})
    rows = rows.where("over is not null and was is null and nth > 1").withColumn("o", (F.row_number().over(along) - 1).cast("int"))
    rows = cover.positions(rows.withColumn("i", F.col("j") - 1), planar, j="lon,lat", i="before_lon,before_lat")
    return rows.select("storm_id", "seg", "o", "j", "n", "lon", "lat", F.col("over").alias("unit_id"), "before_lon", "before_lat")


def match_flags(segs: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with flag_seq: the flagged fix that each crossing claims, or null.

    Claims are greedy: the fix at the segment's start, else the one at its end,
    each at most once. Whether a segment's start is already claimed follows from
    the last segment before it that settles the question: none there or no flag at
    its end (no), two crossings or no flag at its start (yes); a segment with one
    crossing and both ends flagged carries the state on.
    """
    counts = found.groupBy("storm_id", "seg").agg(F.count("*").alias("k"))
    rows = segs.select("storm_id", "seg", F.col("a_flagged").alias("fa"), F.col("b_flagged").alias("fb")).join(counts, ["storm_id", "seg"], "left")
    k = F.coalesce("k", F.lit(0))
    settles = F.when((k == 0) | ~F.col("fb"), 0).when((k >= 2) | ~F.col("fa"), 1)
    before = Window.partitionBy("storm_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("r", settles).withColumn("taken", F.coalesce(F.last("r", ignorenulls=True).over(before), F.lit(0)) == 1)
    out = found.join(rows.select("storm_id", "seg", "fa", "fb", "taken"), ["storm_id", "seg"])
    open_ = F.col("fa") & ~F.col("taken")
    flag = F.when(open_, F.when(F.col("o") == 0, F.col("seg")).when((F.col("o") == 1) & F.col("fb"), F.col("seg") + 1)).otherwise(F.when((F.col("o") == 0) & F.col("fb"), F.col("seg") + 1))
    return out.withColumn("flag_seq", flag).drop("fa", "fb", "taken")


def events(points: DataFrame, segs: DataFrame, matched: DataFrame) -> DataFrame:
    """Geometric and native-only events with interpolated time and intensity."""
    fixes = points.select("storm_id", F.col("point_seq").alias("flag_seq"), F.col("max_wind_kt").alias("flag_wind"))
    rows = matched.join(segs, ["storm_id", "seg"]).join(fixes, ["storm_id", "flag_seq"], "left")
    f = F.col("j") / F.col("n")
    wind = domain.interpolated_int(F.col("a_max_wind_kt"), F.col("b_max_wind_kt"), f)
    geometric = rows.select(
        "storm_id", "seg", "j", F.lit(0).alias("native_only"), F.col("flag_seq").alias("source_point_seq"),
        F.when(F.col("flag_seq").isNull(), "inferred").otherwise("native_confirmed").alias("detection_method"),
        domain.interpolated_time(F.col("a_timestamp_utc"), F.col("b_timestamp_utc"), f).alias("exact_time"),
        F.col("lon").alias("exact_lon"), F.col("lat").alias("exact_lat"), F.coalesce("flag_wind", wind).alias("exact_wind_kt"),
        domain.interpolated_int(F.col("a_min_pressure_mb"), F.col("b_min_pressure_mb"), f).alias("exact_pressure_mb"),
        F.col("a_status").alias("status_at_landfall"), F.lit(True).alias("exact_is_offcadence"), "unit_id", "before_lon", "before_lat",
    )
    claimed = matched.where("flag_seq is not null").select("storm_id", F.col("flag_seq").alias("point_seq"))
    several = points.groupBy("storm_id").agg(F.count("*").alias("n")).where("n > 1").select("storm_id")
    flags = points.where(F.col("record_identifier") == "L").join(several, "storm_id", "left_semi").join(claimed, ["storm_id", "point_seq"], "left_anti")
    native = flags.select(
        "storm_id", F.col("point_seq").alias("seg"), F.lit(0).alias("j"), F.lit(1).alias("native_only"), F.col("point_seq").alias("source_point_seq"),
        F.lit("native").alias("detection_method"), F.col("timestamp_utc").alias("exact_time"), F.col("longitude").alias("exact_lon"),
        F.col("latitude").alias("exact_lat"), F.col("max_wind_kt").alias("exact_wind_kt"), F.col("min_pressure_mb").alias("exact_pressure_mb"),
        F.col("status").alias("status_at_landfall"), (~F.coalesce(F.col("is_synoptic"), F.lit(False))).alias("exact_is_offcadence"),
        F.lit(None).cast("int").alias("unit_id"), F.lit(None).cast("double").alias("before_lon"), F.lit(None).cast("double").alias("before_lat"),
    )
    return geometric.unionByName(native)


def attribute(found: DataFrame, index: DataFrame, edges: DataFrame, units: DataFrame, masses: DataFrame, mainland: int | None, planar: bool = False) -> DataFrame:
    """Events with place: the containing unit, else the nearest one and its distance."""
    key = ["storm_id", "seg", "j", "native_only"]
    inside = cover.with_unit(found.where("native_only = 1"), index, "exact_lon", "exact_lat")
    rows = found.where("native_only = 0").unionByName(inside)
    outside = rows.where("unit_id is null")
    near = geometry.nearest_edge(outside, key, edges.select("unit_id", "x1", "y1", "x2", "y2"), "unit_id", "exact_lon", "exact_lat")
    joined = outside.select(*key, F.col("exact_lon").alias("__x"), F.col("exact_lat").alias("__y")).join(near, key)
    away = geometry.with_distance(joined, "landfall_admin_distance_km", "__x", "__y", "near_x", "near_y", planar)
    away = away.select(*key, F.col("unit_id").alias("near_unit"), "landfall_admin_distance_km")
    rows = rows.join(away, key, "left").withColumn("is_attribution_exact", F.col("unit_id").isNotNull())
    rows = rows.withColumns({"unit_id": F.coalesce("unit_id", "near_unit"), "landfall_admin_distance_km": F.coalesce("landfall_admin_distance_km", F.lit(0.0))}).drop("near_unit")
    place = units.join(masses, "unit_id").select("unit_id", F.col("admin1_name").alias("landfall_admin1"), F.col("country_name").alias("landfall_country"), F.col("iso_country").alias("landfall_iso"), "landmass_id", "landmass_area_km2")
    rows = rows.join(place, "unit_id", "left")
    main = F.lit(False) if mainland is None else F.coalesce(F.col("landmass_id") == mainland, F.lit(False))
    return rows.withColumn("is_mainland_landfall", main)


def sequence(found: DataFrame, points: DataFrame, index: DataFrame) -> DataFrame:
    """Events in order, de-duplicated, with is_landfall, landfall_seq and landfall_type.

    An event is a landfall if it is native, the storm's first, on another landmass
    than the event before, or if a fix between the two was over water.
    """
    spot = Window.partitionBy("storm_id", "exact_time", F.round("exact_lat", 9), F.round("exact_lon", 9)).orderBy("native_only", "seg", "j")
    rows = found.withColumn("__first", F.row_number().over(spot)).where("__first = 1").drop("__first")
    # Water seen so far, at each fix and event: a running count on one timeline.
    wet = cover.with_unit(points.select("storm_id", "point_seq", "timestamp_utc", "longitude", "latitude"), index, out="over").where("over is null")
    ticks = wet.select("storm_id", F.col("timestamp_utc").alias("t"), F.lit(1).alias("w"), F.lit(None).cast("int").alias("seg"), F.lit(None).cast("int").alias("j"), F.lit(None).cast("int").alias("native_only"))
    times = rows.select("storm_id", F.col("exact_time").alias("t"), F.lit(0).alias("w"), "seg", "j", "native_only")
    # Strictly before an event: equal times don't count; up to one: they do.
    by_time = Window.partitionBy("storm_id").orderBy(F.unix_micros("t"))
    counted = ticks.unionByName(times).withColumns({
        "upto": F.sum("w").over(by_time.rangeBetween(Window.unboundedPreceding, 0)),
        "below": F.coalesce(F.sum("w").over(by_time.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    }).where("w = 0").drop("w", "t")
    rows = rows.join(counted, ["storm_id", "seg", "j", "native_only"])
    order = Window.partitionBy("storm_id").orderBy("exact_time", "native_only", "seg", "j")
    rows = rows.withColumns({"__n": F.row_number().over(order), "__mass": F.lag("landmass_id").over(order), "__upto": F.lag("upto").over(order)})
    native = F.col("detection_method").isin("native", "native_confirmed")
    fresh = native | (F.col("__n") == 1) | ~F.col("landmass_id").eqNullSafe(F.col("__mass")) | (F.col("below") > F.col("__upto"))
    rows = rows.withColumn("is_landfall", fresh)
    rows = rows.withColumn("landfall_seq", F.sum(F.col("is_landfall").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    kind = F.when(~F.col("is_landfall"), "overland_reentry").when(F.col("landfall_seq") == 1, "first_landfall").otherwise("subsequent_landfall")
    return rows.withColumn("landfall_type", kind).drop("__n", "__mass", "__upto", "upto", "below")


def preceding_synoptic(rows: DataFrame, points: DataFrame) -> DataFrame:
    """As-of join: the storm's last synoptic fix at or before the event, sixhr_*.

    Events and fixes share one timeline for each storm; of fixes with equal time
    the one earlier in the track wins.
    """
    key = ["storm_id", "seg", "j", "native_only"]
    fix = F.struct("timestamp_utc", "latitude", "longitude", "max_wind_kt", "min_pressure_mb")
    first = Window.partitionBy("storm_id", "timestamp_utc").orderBy("point_seq")
    fixes = points.where("is_synoptic").withColumn("__r", F.row_number().over(first)).where("__r = 1")
    right = fixes.select("storm_id", F.col("timestamp_utc").alias("t"), F.lit(0).alias("side"), fix.alias("fix"), *[F.lit(None).cast("int").alias(k) for k in key[1:]])
    left = rows.select("storm_id", F.col("exact_time").alias("t"), F.lit(1).alias("side"), F.lit(None).cast(right.schema["fix"].dataType).alias("fix"), *[F.col(k).cast("int") for k in key[1:]])
    line = Window.partitionBy("storm_id").orderBy("t", "side", "seg", "j").rowsBetween(Window.unboundedPreceding, 0)
    met = left.unionByName(right).withColumn("near", F.last("fix", ignorenulls=True).over(line)).where("side = 1")
    met = met.select(*key, *[F.col(f"near.{a}").alias(b) for a, b in (("timestamp_utc", "sixhr_time"), ("latitude", "sixhr_lat"), ("longitude", "sixhr_lon"), ("max_wind_kt", "sixhr_wind_kt"), ("min_pressure_mb", "sixhr_pressure_mb"))])
    return rows.join(met, key).withColumn("hours_from_6hr_to_landfall", domain.hours_between(F.col("exact_time"), F.col("sixhr_time")))


def finish(rows: DataFrame, seasons: DataFrame, conus: list[str] | None = None) -> DataFrame:
    """Derived labels and flags of the landfall table."""
    rows = rows.join(seasons.select("storm_id", "season"), "storm_id")
    in_conus = (F.col("landfall_iso") == "US") & (F.col("landfall_admin1").isin(*conus) if conus else F.lit(True))
    return rows.withColumns({
        "exact_ss_category": domain.ss_category(F.col("exact_wind_kt")),
        "sixhr_ss_category": domain.ss_category(F.col("sixhr_wind_kt")),
        "is_us_landfall": F.coalesce(F.col("landfall_iso") == "US", F.lit(False)),
        "is_tropical_at_landfall": domain.is_tropical(F.col("status_at_landfall")),
        "event_class": domain.event_class(F.col("status_at_landfall"), F.col("exact_wind_kt")),
        "native_flagging_complete": domain.flagging_complete(F.col("season"), F.coalesce(in_conus, F.lit(False))),
    }).drop("season")


def attribute_gates(rows: DataFrame, gates: DataFrame, planar: bool = False) -> DataFrame:
    """gate_id, gate_region, gate_is_crossing and gate_distance_km of each event.

    A gate that the crossing's last step intersects, the nearest of several; else
    the nearest gate. Ties go to the smallest id.
    """
    key = ["storm_id", "seg", "j", "native_only"]
    lines = gates.select("gate_id", "x1", "y1", "x2", "y2")
    covers = lines.withColumn("cx", F.explode(F.sequence(geometry.cell(F.least("x1", "x2")), geometry.cell(F.greatest("x1", "x2")))))
    covers = covers.withColumn("cy", F.explode(F.sequence(geometry.cell(F.least("y1", "y2")), geometry.cell(F.greatest("y1", "y2")))))
    steps = rows.where("before_lon is not null").select(*key, "before_lon", "before_lat", "exact_lon", "exact_lat")
    steps = steps.withColumn("cx", F.explode(F.sequence(geometry.cell(F.least("before_lon", "exact_lon")), geometry.cell(F.greatest("before_lon", "exact_lon")))))
    steps = steps.withColumn("cy", F.explode(F.sequence(geometry.cell(F.least("before_lat", "exact_lat")), geometry.cell(F.greatest("before_lat", "exact_lat")))))
    hits = steps.join(covers, ["cx", "cy"]).where(geometry.segments_cross(*[F.col(c) for c in ("before_lon", "before_lat", "exact_lon", "exact_lat", "x1", "y1", "x2", "y2")]))
    nx, ny = geometry.nearest_on_edge(F.col("exact_lon"), F.col("exact_lat"))
    hits = hits.withColumns({"near_x": nx, "near_y": ny})
    d = F.pow(F.col("near_x") - F.col("exact_lon"), F.lit(2.0)) + F.pow(F.col("near_y") - F.col("exact_lat"), F.lit(2.0))
    hits = hits.groupBy(*key).agg(F.min(F.struct(F.round(d, 12).alias("d"), "gate_id", "near_x", "near_y")).alias("best"))
    hits = hits.select(*key, "best.gate_id", "best.near_x", "best.near_y", F.lit(True).alias("gate_is_crossing"))
    rest = rows.join(hits.select(*key), key, "left_anti")
    near = geometry.nearest_edge(rest, key, lines, "gate_id", "exact_lon", "exact_lat").select(*key, "gate_id", "near_x", "near_y", F.lit(False).alias("gate_is_crossing"))
    found = hits.unionByName(near).join(gates.select("gate_id", F.col("region").alias("gate_region")), "gate_id")
    out = rows.join(found, key, "left")
    return geometry.with_distance(out, "gate_distance_km", "exact_lon", "exact_lat", "near_x", "near_y", planar).drop("near_x", "near_y")
