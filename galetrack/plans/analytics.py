"""Analytics of a built database: who struck where, how it was detected, and how well.

Functions take the landfalls of a scope (``scope(db, conus)``), or the database. Series
run over all seasons from the scope's first to its last, zero-filled, and are a row for
each season, so windows over them have one small partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galetrack.functions import domain
from galetrack.plans.storms import Database, TABLES
from galetrack.plans.workload import countable

NATIVE = ("native", "native_confirmed")
SMOOTHING = (-5, 4)
LEAST_SEASONS = 6
#: One step of the archive's positions, a tenth of a degree, in km.
QUANTUM_KM = 11.119
CUTS = (1944, 1950, 1966)


class EmptyScope(ValueError):
    """US landfalls exist, but none lies in the chosen units."""


def scope(db: Database, conus: tuple[str, ...] = domain.CONUS_UNITS) -> DataFrame:
    """Countable US landfalls in the units named."""
    return countable(db).where(F.col("is_us_landfall") & F.col("landfall_admin1").isin(*conus))


def guard(db: Database, conus: tuple[str, ...] = domain.CONUS_UNITS, shown: int = 25) -> None:
    """Raises if the units' names match no US landfall though there are some."""
    us = countable(db).where("is_us_landfall")
    if not us.isEmpty() and scope(db, conus).isEmpty():
        seen = [r[0] for r in us.select("landfall_admin1").distinct().orderBy("landfall_admin1").limit(shown).collect()]
        raise EmptyScope(f"no US landfall lies in the chosen units; the land names its units {seen}")


def classes(spark) -> DataFrame:
    """event_class and its rank."""
    return spark.createDataFrame([(c, i) for i, c in enumerate(domain.CLASSES)], "event_class string, rank int")


def by_class(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("event_class").agg(F.count("*").alias(name))


def in_class_order(spark, *counts: DataFrame) -> DataFrame:
    """Counts by class beside each other, zero-filled, in the order of classes."""
    out = classes(spark)
    for c in counts:
        out = out.join(c, "event_class", "left")
    return out.fillna(0)


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percent, rounded half to even; null where there is no whole."""
    return F.bround(100.0 * part / F.nullif(whole, F.lit(0)), digits)


def smoothed(column: str, *keys: str) -> Column:
    """Mean over ten seasons around each; null with fewer than six of them."""
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("season").rowsBetween(*SMOOTHING)
    return F.when(F.count(column).over(w) >= LEAST_SEASONS, F.round(F.avg(column).over(w), 6))


def seasons_of(falls: DataFrame) -> DataFrame:
    return falls.agg(F.min("season").alias("a"), F.max("season").alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b")).alias("season"))


def yearly(falls: DataFrame, *keys: str) -> DataFrame:
    """season, class (and ``keys``), with n landfalls and those flagged: a full grid."""
    spark = falls.sparkSession
    # Seasons are hundreds, classes five and the keys map units: a bounded grid.
    grid = seasons_of(falls).join(F.broadcast(classes(spark)), how="cross")
    if keys:
        grid = grid.join(falls.select(*keys).distinct(), how="cross")
    counts = falls.groupBy("season", "event_class", *keys).agg(F.count("*").alias("n"), F.count_if(F.col("detection_method").isin(*NATIVE)).alias("flagged"))
    return grid.join(counts, ["season", "event_class", *keys], "left").fillna(0, ["n", "flagged"])


# Inventory and classes.


def table_inventory(db: Database) -> DataFrame:
    out = None
    for name in TABLES:
        if name == "metadata":
            continue
        rows = getattr(db, name).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


def class_overview(db: Database) -> DataFrame:
    """Fixes, storms (lifetime), landfall events and near misses by class."""
    misses = db.bypasses.withColumn("event_class", domain.event_class(F.col("bypass_status"), F.col("bypass_wind_kt")))
    tables = ((db.track_points, "track_points"), (db.storms, "storms"), (db.landfalls, "landfalls"), (misses, "bypasses"))
    return in_class_order(db.storms.sparkSession, *[by_class(t, n) for t, n in tables]).drop("rank")


def storms_by_season_class(db: Database, by: str = "season") -> DataFrame:
    """Storms by season (or basin) and lifetime class."""
    return db.storms.groupBy(by, "event_class").agg(F.count("*").alias("n"))


def misleading_categories(db: Database) -> DataFrame:
    """Fixes with a numbered wind category that aren't tropical or subtropical."""
    rows = db.track_points.where(F.col("ss_category").isin("1", "2", "3", "4", "5") & (F.col("event_class") == domain.CLASSES[3]))
    return rows.groupBy("ss_category").agg(F.count("*").alias("n"))


# Landfalls of a scope.


def scope_counts(db: Database, conus: tuple[str, ...]) -> DataFrame:
    inside = F.col("landfall_admin1").isin(*conus)
    rows = countable(db).where("is_us_landfall")
    return rows.agg(
        F.count("*").alias("us_landfalls"), F.count_if(inside).alias("in_scope"), F.count_if(~inside).alias("outside"),
        F.count_distinct(F.when(inside, F.col("storm_id"))).alias("storms"), F.min(F.when(inside, F.col("season"))).alias("first_season"), F.max(F.when(inside, F.col("season"))).alias("last_season"),
    )


def intensity_composition(falls: DataFrame) -> DataFrame:
    """Landfalls by category, and how many of all are at hurricane strength."""
    every = Window.partitionBy(F.lit(0))
    rows = falls.groupBy("exact_ss_category").agg(F.count("*").alias("n"), F.count_if(F.col("exact_wind_kt") >= domain.HURRICANE_FLOOR).alias("strong"))
    return rows.select("exact_ss_category", "n", share(F.sum("strong").over(every), F.sum("n").over(every)).alias("hurricane_pct"))


def latest_season(falls: DataFrame) -> DataFrame:
    last = falls.agg(F.max("season").alias("season"))
    return falls.join(F.broadcast(last), "season").select("season", "name", F.unix_micros("exact_time").alias("exact_us"), "landfall_admin1", "exact_wind_kt", "exact_ss_category", "detection_method")


def national_series(falls: DataFrame) -> DataFrame:
    """All landfalls of each season and their smoothed mean."""
    rows = yearly(falls).groupBy("season").agg(F.sum("n").alias("n"))
    return rows.select("season", "n", smoothed("n").alias("smoothed"))


def class_series(falls: DataFrame) -> DataFrame:
    rows = yearly(falls)
    return rows.select("season", "event_class", "n", smoothed("n", "event_class").alias("smoothed"))


def series_extremes(falls: DataFrame) -> DataFrame:
    """Mean and maximum a season, the first season of the maximum, and seasons with none."""
    rows = yearly(falls).groupBy("season").agg(F.sum("n").alias("n"))
    return rows.agg(F.round(F.avg("n"), 6).alias("mean"), F.max("n").alias("most"), F.max_by("season", F.struct("n", -F.col("season"))).alias("in_season"), F.count_if(F.col("n") == 0).alias("none"))


def state_composition(falls: DataFrame) -> DataFrame:
    """Landfalls by unit and class, with each unit's total and its share of hurricanes."""
    unit = Window.partitionBy("landfall_admin1")
    rows = falls.groupBy("landfall_admin1", "event_class").agg(F.count("*").alias("n"))
    strong = F.sum(F.when(F.col("event_class") == domain.CLASSES[0], F.col("n")).otherwise(0)).over(unit)
    return rows.select("landfall_admin1", "event_class", "n", F.sum("n").over(unit).alias("total"), share(strong, F.sum("n").over(unit)).alias("hurricane_pct"))


def state_matrix(falls: DataFrame) -> DataFrame:
    return yearly(falls, "landfall_admin1").where("n > 0").select("landfall_admin1", "season", "event_class", "n")


def state_trends(falls: DataFrame) -> DataFrame:
    """Smoothed landfalls a season by unit and class, over the full grid."""
    rows = yearly(falls, "landfall_admin1")
    return rows.select("landfall_admin1", "season", "event_class", smoothed("n", "landfall_admin1", "event_class").alias("smoothed")).where("smoothed > 0")


def detection_by_decade(falls: DataFrame) -> DataFrame:
    rows = falls.withColumn("decade", domain.decade(F.col("season")))
    count = lambda m: F.count_if(F.col("detection_method") == m).alias(m)
    return rows.groupBy("event_class", "decade").agg(*[count(m) for m in ("native_confirmed", "native", "inferred")])


# What flags alone would show.


def native_visibility(falls: DataFrame) -> DataFrame:
    flagged = F.col("detection_method").isin(*NATIVE)
    rows = falls.agg(
        F.count("*").alias("landfalls"), F.count_if(flagged).alias("flagged"), F.count_distinct("storm_id").alias("storms"),
        F.count_distinct(F.when(flagged, F.col("storm_id"))).alias("storms_flagged"),
    )
    return rows.withColumns({"flagged_pct": share(F.col("flagged"), F.col("landfalls"), 0), "only_inferred": F.col("storms") - F.col("storms_flagged")})


def era_deltas(falls: DataFrame) -> DataFrame:
    """By era of flagging: seasons, landfalls, flags, and what inference adds a season."""
    rows = yearly(falls).groupBy("season").agg(F.sum("n").alias("n"), F.sum("flagged").alias("flagged")).withColumn("delta", F.col("n") - F.col("flagged"))
    return rows.groupBy(domain.flag_era(F.col("season")).alias("era")).agg(
        F.count("*").alias("seasons"), F.sum("n").alias("detected"), F.sum("flagged").alias("flagged"), F.sum("delta").alias("delta_total"),
        F.round(F.avg("delta"), 6).alias("delta_mean"), F.median("delta").alias("delta_median"), F.max("delta").alias("delta_max"),
        share(F.sum("delta"), F.sum("n")).alias("inferred_pct"), F.count_if((F.col("flagged") == 0) & (F.col("n") > 0)).alias("blind_seasons"),
    )


def season_deltas(falls: DataFrame) -> DataFrame:
    rows = yearly(falls).groupBy("season").agg((F.sum("n") - F.sum("flagged")).alias("delta"))
    return rows.select("season", "delta", smoothed("delta").alias("smoothed"))


def class_deltas(falls: DataFrame) -> DataFrame:
    rows = yearly(falls)
    return rows.select("season", "event_class", (F.col("n") - F.col("flagged")).alias("delta")).where("delta > 0")


# How well places are attributed.


def attribution_quality(db: Database) -> DataFrame:
    km, exact = F.col("landfall_admin_distance_km"), F.col("is_attribution_exact")
    return db.landfalls.groupBy("detection_method").agg(
        F.count("*").alias("n"), F.count_if(exact).alias("exact"), F.count_if(~exact).alias("inexact"), share(F.count_if(~exact), F.count("*"), 2).alias("inexact_pct"),
        F.round(F.median(km), 6).alias("median_km"), F.round(F.percentile(km, 0.95), 6).alias("p95_km"), F.round(F.max(km), 6).alias("max_km"),
    )


def missed_flags(db: Database) -> DataFrame:
    """Flags that no crossing reproduced: at sea in this land, or already ashore."""
    rows = db.landfalls.where(F.col("detection_method").isin(*NATIVE))
    kind = F.when(F.col("detection_method") == "native_confirmed", "reproduced").when(F.col("is_attribution_exact"), "already_ashore").otherwise("off_land")
    return rows.groupBy(kind.alias("mechanism")).agg(F.count("*").alias("n"), F.median("landfall_seq").alias("median_seq"))


def miss_rate(db: Database, *keys: str) -> DataFrame:
    """Share of flags not reproduced, by class or by mainland and class."""
    rows = db.landfalls.where(F.col("detection_method").isin(*NATIVE)).withColumns({"mainland": F.col("is_mainland_landfall").cast("int"), "missed": (F.col("detection_method") == "native").cast("int")})
    return rows.groupBy(*keys).agg(F.sum("missed").alias("missed"), F.count("*").alias("n"), share(F.sum("missed"), F.count("*")).alias("miss_pct"))


def offshore(db: Database) -> DataFrame:
    return db.landfalls.where((F.col("detection_method") == "native") & ~F.col("is_attribution_exact"))


def offshore_distances(db: Database, quantum: float = QUANTUM_KM) -> DataFrame:
    """How far off the land unreproduced flags lie, and how many are within one step of positions."""
    km = F.col("landfall_admin_distance_km")
    quartiles = F.percentile(km, F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)]))
    rows = offshore(db).agg(F.min(km).alias("least"), quartiles.alias("q"), F.max(km).alias("most"), F.count_if(km <= quantum).alias("within"), F.count("*").alias("n"))
    at = lambda i: F.round(F.get("q", F.lit(i)), 6)
    return rows.select(F.round("least", 6).alias("least_km"), at(0).alias("q25_km"), at(1).alias("median_km"), at(2).alias("q75_km"), F.round("most", 6).alias("most_km"), "within", "n")


def furthest_offshore(db: Database, top: int = 6) -> DataFrame:
    km = F.round("landfall_admin_distance_km", 6)
    rows = offshore(db).select("storm_id", F.unix_micros("exact_time").alias("exact_us"), "landfall_admin1", "landfall_country", "exact_wind_kt", "event_class", km.alias("km"))
    return rows.orderBy(F.desc("km"), "storm_id", "exact_us").limit(top)


def exact_share(db: Database) -> DataFrame:
    return db.landfalls.groupBy("detection_method").agg(F.bround(100.0 * F.avg(F.col("is_attribution_exact").cast("double")), 1).alias("exact_pct"), F.count("*").alias("n"))


#: Upper ends of the distance classes, in km.
BINS = (1.0, 5.0, QUANTUM_KM, 25.0, 50.0, 100.0, 1000.0)


def distance_bin(km: Column, ends: tuple[float, ...] = BINS) -> Column:
    """Number of the class (0 < km <= first end, and so on); null outside of all."""
    out = F.when(km <= 0, F.lit(None).cast("int"))
    for i, end in enumerate(ends):
        out = out.when(km <= end, i)
    return out


def distance_histogram(db: Database) -> DataFrame:
    rows = db.landfalls.where("landfall_admin_distance_km > 0").groupBy(distance_bin(F.col("landfall_admin_distance_km")).alias("bin")).agg(F.count("*").alias("n"))
    return seasonless(db, len(BINS)).join(rows, "bin", "left").fillna(0)


def seasonless(db: Database, n: int) -> DataFrame:
    return db.landfalls.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"))


# The exact moment against the synoptic fix.


def timed(falls: DataFrame) -> DataFrame:
    return falls.where("exact_wind_kt is not null and sixhr_wind_kt is not null").withColumn("delta_kt", F.col("exact_wind_kt") - F.col("sixhr_wind_kt"))


def timing_totals(falls: DataFrame) -> DataFrame:
    d = F.col("delta_kt")
    return timed(falls).agg(F.count("*").alias("n"), F.count_if(d != 0).alias("differ"), F.count_if(d > 0).alias("stronger"), F.count_if(d < 0).alias("weaker"), F.max(d).alias("most_kt"))


def strongest_rises(falls: DataFrame, top: int = 6) -> DataFrame:
    rows = timed(falls).select("name", "season", "landfall_seq", "landfall_admin1", "sixhr_wind_kt", "exact_wind_kt", "delta_kt", F.round("hours_from_6hr_to_landfall", 6).alias("hours"))
    return rows.orderBy(F.desc("delta_kt"), "name", "landfall_seq").limit(top)


def timing_by_class(falls: DataFrame) -> DataFrame:
    d = F.col("delta_kt")
    rows = timed(falls).where(F.col("event_class") != domain.CLASSES[4])
    return rows.groupBy("event_class").agg(F.count("*").alias("n"), share(F.count_if(d != 0), F.count("*")).alias("differ_pct"), F.median(F.abs(d)).alias("median_kt"), F.max(d).alias("most_kt"))


def landfall_cube(db: Database) -> DataFrame:
    """Landfalls by state, class and method and all their subtotals.

    ``level`` has a bit for each of the three that is summed over, so a subtotal is told
    from landfalls without a state.
    """
    rows = db.landfalls.where("is_landfall").select(F.col("landfall_admin1").alias("state"), "event_class", F.col("detection_method").alias("method"), "storm_id", "exact_wind_kt")
    sums = rows.cube("state", "event_class", "method").agg(F.grouping_id().alias("level"), F.count("*").alias("n"), F.count_distinct("storm_id").alias("storms"), F.max("exact_wind_kt").alias("wind"))
    return sums.select("state", "event_class", "method", F.col("level").cast("long").alias("level"), "n", "storms", "wind")


# Near misses.


def approaches(db: Database) -> DataFrame:
    """Storms without landfall: class and closest distance."""
    return db.storms.where("not made_landfall").select("storm_id", "event_class", F.col("min_distance_to_coast_km").alias("km"))


def radius_table(db: Database, radii: tuple[float, ...] = (50.0, 111.12, 200.0, 300.0, 500.0)) -> DataFrame:
    """How many storms without landfall came within each radius."""
    one = approaches(db).agg(F.count("*").alias("all"), F.array(*[F.struct(F.lit(r).alias("radius_km"), F.count_if(F.col("km") <= r).alias("n")) for r in radii]).alias("r"))
    return one.select(F.explode("r").alias("r"), "all").select("r.radius_km", "r.n", share(F.col("r.n"), F.col("all")).alias("pct"))


def approach_histogram(db: Database, width: float = 25.0, most: float = 1500.0) -> DataFrame:
    """Storms without landfall by distance and class; the last bin holds all that are farther."""
    rows = approaches(db).where("km is not null")
    return rows.groupBy(F.least(F.floor(F.col("km") / width), F.lit(int(most / width) - 1)).cast("int").alias("bin"), "event_class").agg(F.count("*").alias("n"))


def approaches_by_class(db: Database, radius_km: float = domain.BYPASS_RADIUS_KM) -> DataFrame:
    rows = approaches(db)
    return in_class_order(rows.sparkSession, by_class(rows, "storms"), by_class(rows.where(F.col("km") <= radius_km), "within")).drop("rank")


# One row for each storm, and the record's change over time.


def strongest_landfall(falls: DataFrame) -> DataFrame:
    """Each storm's landfall with the strongest wind, the earliest of equal ones."""
    w = Window.partitionBy("storm_id").orderBy(F.desc_nulls_last("exact_wind_kt"), "exact_time", "native_only", "seg", "j")
    return falls.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def composition_of_storms(falls: DataFrame) -> DataFrame:
    """Crossings and storms (at their strongest landfall) by class, in percent of their sums."""
    rows = in_class_order(falls.sparkSession, by_class(falls, "crossings"), by_class(strongest_landfall(falls), "storms"))
    every = Window.partitionBy(F.lit(0))
    return rows.select("event_class", "crossings", "storms", share(F.col("crossings"), F.sum("crossings").over(every)).alias("crossings_pct"), share(F.col("storms"), F.sum("storms").over(every)).alias("storms_pct"))


def crossings_a_storm(falls: DataFrame) -> DataFrame:
    rows = falls.groupBy("storm_id").agg(F.count("*").alias("n"), F.max("exact_wind_kt").alias("wind"))
    return rows.agg(F.count("*").alias("storms"), F.sum("n").alias("crossings"), F.count_if(F.col("n") > 1).alias("several"), F.max("n").alias("most"), F.count_if(F.col("wind").isNull()).alias("no_wind"))


def cut_ratios(falls: DataFrame, cuts: tuple[int, ...] = CUTS) -> DataFrame:
    """Landfalls a season from each cut on over those before it, by class; null without any before."""
    span = falls.agg(F.min("season").alias("first"), F.max("season").alias("last"))
    rows = falls.groupBy("season", "event_class").agg(F.count("*").alias("n"))
    rows = rows.unionByName(falls.groupBy("season").agg(F.lit("ALL").alias("event_class"), F.count("*").alias("n")))
    rows = rows.where(F.col("event_class") != domain.CLASSES[4]).withColumn("cut", F.explode(F.array(*[F.lit(c) for c in cuts])))
    sums = rows.groupBy("cut", "event_class").agg(F.sum(F.when(F.col("season") < F.col("cut"), F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("season") >= F.col("cut"), F.col("n")).otherwise(0)).alias("b"))
    sums = sums.join(F.broadcast(span), how="cross")
    before, after = F.col("a") / F.nullif(F.col("cut") - F.col("first"), F.lit(0)), F.col("b") / F.nullif(F.col("last") - F.col("cut") + 1, F.lit(0))
    return sums.select("cut", "event_class", F.round(F.try_divide(after, F.nullif(before, F.lit(0.0))), 6).alias("ratio"))


def inferred_share(falls: DataFrame, cuts: tuple[int, ...] = CUTS) -> DataFrame:
    inferred = (F.col("detection_method") == "inferred").cast("double")
    rows = falls.withColumn("cut", F.explode(F.array(*[F.lit(c) for c in cuts])))
    mean = lambda side: F.round(100.0 * F.avg(F.when(side, inferred)), 6)
    return rows.groupBy("cut").agg(mean(F.col("season") < F.col("cut")).alias("before_pct"), mean(F.col("season") >= F.col("cut")).alias("after_pct"))


def period_means(falls: DataFrame, cut: int = 1950) -> DataFrame:
    """Landfalls a season by class, before and from the cut, and their ratio."""
    rows = yearly(falls).groupBy("event_class").agg(F.avg(F.when(F.col("season") < cut, F.col("n"))).alias("a"), F.avg(F.when(F.col("season") >= cut, F.col("n"))).alias("b"))
    return rows.select("event_class", F.round("a", 6).alias("before"), F.round("b", 6).alias("after"), F.round(F.try_divide("b", F.nullif(F.col("a"), F.lit(0.0))), 6).alias("ratio"))


def modern_storms(falls: DataFrame, cut: int = 1950) -> DataFrame:
    """Storms at their strongest landfall by class: from the cut on, and in all."""
    peak = strongest_landfall(falls)
    return in_class_order(falls.sparkSession, by_class(peak.where(F.col("season") >= cut), "modern"), by_class(peak, "full")).drop("rank")


def hurricane_strikes(db: Database, last: int = 2024) -> DataFrame:
    """US landfalls at hurricane strength, with the storm's published label."""
    rows = countable(db).where(F.col("is_us_landfall") & (F.col("exact_wind_kt") >= domain.HURRICANE_FLOOR) & (F.col("season") <= last))
    return rows.withColumn("label", domain.published_label(F.col("name"), F.col("season")))


def strikes_by_category(db: Database, conus: tuple[str, ...]) -> DataFrame:
    rows = hurricane_strikes(db)
    return rows.groupBy("exact_ss_category").agg(F.count("*").alias("n"), F.count_distinct("storm_id").alias("storms"), F.count_if(F.col("landfall_admin1").isin(*conus)).alias("in_scope"))


def label_check(db: Database, labels: list[str]) -> DataFrame:
    """Which published labels the database has as hurricane strikes, where and how strong.

    A label that is missing also gets the strongest wind of that storm's US landfalls,
    if it has any below hurricane strength.
    """
    spark = db.landfalls.sparkSession
    asked = spark.createDataFrame([(x,) for x in labels], "label string")
    found = hurricane_strikes(db).groupBy("label").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("landfall_admin1")), ", ").alias("units"), F.max("exact_wind_kt").alias("wind_kt"))
    weak = countable(db).where("is_us_landfall").withColumn("label", domain.published_label(F.col("name"), F.col("season"))).groupBy("label").agg(F.max("exact_wind_kt").alias("any_kt"))
    out = asked.join(found, "label", "left").join(weak, "label", "left")
    return out.select("label", F.col("n").isNotNull().cast("int").alias("found"), F.coalesce("n", F.lit(0)).alias("landfalls"), "units", "wind_kt", F.when(F.col("n").isNull(), F.col("any_kt")).alias("below_kt"))


def storm_counter(db: Database) -> DataFrame:
    """How many storms have appeared up to each season: what a frame of the display shows."""
    rows = db.storms.groupBy("season").agg(F.count("*").alias("n"))
    w = Window.partitionBy(F.lit(0)).orderBy("season").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("season", "n", F.sum("n").over(w).alias("so_far"))


def display_points(db: Database, conus: tuple[str, ...], first: int, last: int) -> DataFrame:
    """Fixes of storms with a landfall in the scope, in the seasons given, with their marker's class."""
    struck = scope(db, conus).select("storm_id").distinct()
    rows = db.track_points.join(struck, "storm_id", "left_semi").join(db.storms.select("storm_id", "season"), "storm_id").where(F.col("season").between(first, last))
    return rows.select("storm_id", "point_seq", "season", "longitude", "latitude", domain.system_type(F.col("status"), F.col("max_wind_kt")).alias("marker"))


def impact_points(db: Database, conus: tuple[str, ...]) -> DataFrame:
    """Landfalls in the scope with a position: the season whose display they mark, and the marker's class."""
    rows = scope(db, conus).where("exact_lon is not null and exact_lat is not null")
    return rows.select("season", domain.system_type(F.col("status_at_landfall"), F.col("exact_wind_kt")).alias("marker"), F.col("exact_lon").alias("lon"), F.col("exact_lat").alias("lat"))


def impact_labels(db: Database, conus: tuple[str, ...], chosen: dict[int | str, str], least_kt: int = domain.CATEGORY_FLOORS[0][0]) -> DataFrame:
    """Names on the display, at each storm's strongest landfall in the scope.

    Labelled are storms that came ashore with ``least_kt`` or more, and the ``chosen`` ones
    (texts by storm), whose text is kept; a chosen storm without landfall in the scope has no
    place and no label.
    """
    falls = scope(db, conus)
    texts = falls.sparkSession.createDataFrame(list(chosen.items()), f"storm_id {dict(falls.dtypes)['storm_id']}, text string")
    asked = falls.where(F.col("exact_wind_kt") >= least_kt).select("storm_id").union(texts.select("storm_id")).distinct()
    peak = strongest_landfall(falls).join(asked, "storm_id", "left_semi").join(F.broadcast(texts), "storm_id", "left")
    own = F.concat_ws(" ", F.initcap("name"), F.col("season").cast("string"))
    return peak.select("storm_id", "season", F.coalesce("text", own).alias("text"), F.col("exact_lon").alias("lon"), F.col("exact_lat").alias("lat"))


def state_totals(falls: DataFrame) -> DataFrame:
    """Landfalls of each unit, the most frequent first."""
    return falls.groupBy("landfall_admin1").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "landfall_admin1")


def both_ends(falls: DataFrame, n: int = 5) -> DataFrame:
    """The earliest and the latest ``n`` landfalls, those at both ends once."""
    order = ["exact_time", "storm_id", "seg", "j", "native_only"]
    last = falls.orderBy(*[F.desc(c) for c in order]).limit(n)
    return falls.orderBy(*order).limit(n).union(last).dropDuplicates(order)


def summary_counts(db: Database) -> DataFrame:
    """One row: the build's sizes."""
    l = db.landfalls.agg(F.count("*").alias("events"), F.count_if("is_landfall").alias("landfalls"), F.count_if(F.col("is_landfall") & F.col("is_us_landfall")).alias("us_landfalls"))  # noqa: E741
    for name in ("storms", "track_points", "bypasses", "landfall_gates"):
        l = l.join(getattr(db, name).agg(F.count("*").alias(name)), how="cross")  # noqa: E741  one row beside one row
    return l
