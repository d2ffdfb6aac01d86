"""Enriched tracks, near misses and storm summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galetrack.functions import domain
from galetrack.operators import cover, geometry


def enrich(points: DataFrame, index: DataFrame, coast: DataFrame, planar: bool = False) -> DataFrame:
    """Every fix with is_over_land, the coast's nearest position and distance, and derived labels."""
    key = ["storm_id", "point_seq"]
    rows = cover.with_unit(points, index, out="over_unit").withColumn("is_over_land", F.col("over_unit").isNotNull()).drop("over_unit")
    rows = rows.join(geometry.distance_to_coast(points, key, coast, planar=planar), key, "left")
    wind = F.col("max_wind_kt")
    return rows.withColumns({
        "ss_category": domain.ss_category(wind), "is_major_hurricane": domain.is_major(wind),
        "is_native_landfall_record": F.coalesce(F.col("record_identifier") == "L", F.lit(False)),
        "is_tropical": domain.is_tropical(F.col("status")), "event_class": domain.event_class(F.col("status"), wind),
    })


def bypasses(track: DataFrame, landfalls: DataFrame, radius_km: float = domain.BYPASS_RADIUS_KM) -> DataFrame:
    """The closest fix of each storm without a countable landfall, within the radius."""
    landed = landfalls.where("is_landfall").select("storm_id").distinct()
    away = track.join(landed, "storm_id", "left_anti").where("min_distance_to_coast_km is not null")
    order = Window.partitionBy("storm_id").orderBy("min_distance_to_coast_km", "point_seq")
    first = away.withColumn("__r", F.row_number().over(order)).where((F.col("__r") == 1) & (F.col("min_distance_to_coast_km") <= radius_km))
    return first.select(
        "storm_id", F.col("timestamp_utc").alias("bypass_time_utc"), F.col("latitude").alias("bypass_lat"), F.col("longitude").alias("bypass_lon"),
        F.col("min_distance_to_coast_km").alias("bypass_distance_to_coast_km"), "nearest_coast_lon", "nearest_coast_lat", F.col("max_wind_kt").alias("bypass_wind_kt"),
        F.col("min_pressure_mb").alias("bypass_pressure_mb"), F.col("ss_category").alias("bypass_ss_category"), F.col("status").alias("bypass_status"),
        "is_over_land", F.lit(radius_km).alias("radius_km"),
    )


def extremes(points: DataFrame) -> DataFrame:
    """storm_id with its time span, strongest wind, lowest pressure and number of fixes."""
    return points.groupBy("storm_id").agg(
        F.min("timestamp_utc").alias("start_time_utc"), F.max("timestamp_utc").alias("end_time_utc"), F.max("max_wind_kt").alias("peak_wind_kt"),
        F.min("min_pressure_mb").alias("min_pressure_mb"), F.count("*").alias("n_track_points"),
        *([F.min("min_distance_to_coast_km").alias("min_distance_to_coast_km")] if "min_distance_to_coast_km" in points.columns else []),
    )


def storms(track: DataFrame, landfalls: DataFrame, seasons: DataFrame) -> DataFrame:
    """A row per storm: extremes, lifetime class, track line, counts and landfall flags."""
    sums = extremes(track).join(lifetime_class(track).select("storm_id", F.col("lifetime_class").alias("event_class")), "storm_id")
    sums = sums.join(track_lines(track), "storm_id", "left")
    hits = landfalls.where("is_landfall").groupBy("storm_id").agg(F.count("*").alias("n_landfalls"), F.count_if("is_us_landfall").alias("n_us_landfalls"))
    rows = sums.join(hits, "storm_id", "left").join(seasons, "storm_id")
    zero = lambda c: F.coalesce(c, F.lit(0))
    rows = rows.withColumns({"n_landfalls": zero("n_landfalls"), "n_us_landfalls": zero("n_us_landfalls")})
    return rows.withColumns({
        "made_landfall": F.col("n_landfalls") > 0, "made_us_landfall": F.col("n_us_landfalls") > 0,
        "peak_ss_category": domain.ss_category(F.col("peak_wind_kt")), "is_major_hurricane": domain.is_major(F.col("peak_wind_kt")),
    })


def lifetime_class(track: DataFrame) -> DataFrame:
    """storm_id and the highest-ranked class of its fixes."""
    best = track.groupBy("storm_id").agg(F.min(domain.class_rank(domain.event_class(F.col("status"), F.col("max_wind_kt")))).alias("rank"))
    return best.withColumn("lifetime_class", F.element_at(F.array(*[F.lit(c) for c in domain.CLASSES]), F.col("rank") + 1))


def track_spots(points: DataFrame) -> DataFrame:
    """storm_id and spots: the positions of its fixes, in order."""
    spots = F.array_sort(F.collect_list(F.struct("point_seq", "longitude", "latitude")))
    return points.groupBy("storm_id").agg(F.transform(spots, lambda s: F.struct(s["longitude"].alias("x"), s["latitude"].alias("y"))).alias("spots"))


def track_lines(points: DataFrame) -> DataFrame:
    """storm_id and track_wkt; null for storms of fewer than two fixes."""
    spots = F.array_sort(F.collect_list(F.struct("point_seq", "longitude", "latitude")))
    rows = points.groupBy("storm_id").agg(spots.alias("spots"))
    text = F.array_join(F.transform("spots", lambda s: F.concat_ws(" ", s["longitude"].cast("string"), s["latitude"].cast("string"))), ", ")
    return rows.select("storm_id", F.when(F.size("spots") >= 2, F.concat(F.lit("LINESTRING ("), text, F.lit(")"))).alias("track_wkt"))


def time_breaks(points: DataFrame, order: str = "point_seq") -> DataFrame:
    """storm_id and ``order`` of the fixes whose time is before that of the fix ahead of them."""
    back = F.col("timestamp_utc") < F.lag("timestamp_utc").over(Window.partitionBy("storm_id").orderBy(order))
    return points.withColumn("__back", back).where("__back").select("storm_id", order)
