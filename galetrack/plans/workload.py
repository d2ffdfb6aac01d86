"""The everyday questions to a built database, as DataFrame functions.

Each takes a :class:`galetrack.plans.storms.Database`. Results are unordered unless a
function says otherwise; ``orderBy`` is left to whoever shows them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galetrack.functions import domain
from galetrack.plans.storms import Database

MAJOR = ("3", "4", "5")


def countable(db: Database) -> DataFrame:
    """Landfalls that count, with their storm's season, name and basin."""
    return db.landfalls.where("is_landfall").join(db.storms.select("storm_id", "season", "name", "basin"), "storm_id")


def us_landfall_intensity(db: Database) -> DataFrame:
    """US landfalls with the exact wind, or the synoptic one where that is missing."""
    return countable(db).where("is_us_landfall").select(
        "season", "name", "landfall_seq", "landfall_admin1", F.coalesce("exact_wind_kt", "sixhr_wind_kt").alias("wind_kt"),
        F.when(F.col("exact_wind_kt").isNotNull(), F.col("exact_ss_category")).otherwise(F.col("sixhr_ss_category")).alias("ss_category"),
    )


def late_intensification(db: Database, least_kt: int = 15) -> DataFrame:
    """Landfalls that were stronger by ``least_kt`` than the last synoptic fix."""
    rise = F.col("exact_wind_kt") - F.col("sixhr_wind_kt")
    return countable(db).where(rise >= least_kt).select("name", "season", "landfall_seq", "landfall_admin1", "sixhr_wind_kt", "exact_wind_kt", rise.alias("delta_kt"), F.round("hours_from_6hr_to_landfall", 6).alias("hours"))


def landfalls_by_state_category(db: Database) -> DataFrame:
    return countable(db).where(F.col("landfall_iso") == "US").groupBy("landfall_admin1", "exact_ss_category").agg(F.count("*").alias("n"))


def major_landfalls_per_decade(db: Database) -> DataFrame:
    rows = countable(db).where(F.col("is_us_landfall") & F.col("exact_ss_category").isin(*MAJOR))
    return rows.groupBy(domain.decade(F.col("season")).alias("decade")).agg(F.count("*").alias("n"))


def detection_methods(db: Database) -> DataFrame:
    return countable(db).groupBy("detection_method").agg(F.count("*").alias("n"))


def inferred_where_unflagged(db: Database) -> DataFrame:
    """US landfalls that the archive's flags could not have told of."""
    rows = countable(db).where("is_us_landfall and not native_flagging_complete").where(F.col("detection_method") == "inferred")
    return rows.select("season", "name", "landfall_seq", "landfall_admin1", "exact_wind_kt")


def native_only(db: Database) -> DataFrame:
    """Flags that no crossing confirms."""
    return db.landfalls.where(F.col("detection_method") == "native").select("storm_id", "landfall_seq", "landfall_admin1", "exact_wind_kt", F.round("landfall_admin_distance_km", 6).alias("distance_km"))


def several_countries(db: Database) -> DataFrame:
    """Storms with landfalls in more than one country, and the countries."""
    codes = F.array_sort(F.collect_set("landfall_iso"))
    rows = countable(db).groupBy("storm_id", "name", "season").agg(codes.alias("codes")).where(F.size("codes") > 1)
    return rows.select("name", "season", F.size("codes").cast("long").alias("countries"), F.array_join("codes", ",").alias("iso_list"))


def two_countries(db: Database, first: str = "MX", second: str = "US") -> DataFrame:
    """Every landfall of the storms that struck both countries, in whatever order."""
    falls = countable(db)
    both = falls.groupBy("storm_id").agg(F.bool_or(F.col("landfall_iso") == first).alias("f"), F.bool_or(F.col("landfall_iso") == second).alias("s")).where("f and s")
    return falls.join(both.select("storm_id"), "storm_id", "left_semi").select("name", "season", "landfall_seq", "landfall_iso", "landfall_admin1", F.unix_micros("exact_time").alias("exact_us"), "exact_wind_kt")


def island_then_mainland(db: Database) -> DataFrame:
    """US landfalls with the size of the land they struck."""
    return countable(db).where(F.col("landfall_iso") == "US").select("name", "season", "landfall_seq", "landfall_admin1", F.col("is_mainland_landfall").cast("int").alias("mainland"), F.round("landmass_area_km2", 1).alias("landmass_km2"))


def by_landmass_size(db: Database, km2: float = 5000.0, above: bool = False) -> DataFrame:
    """Landfalls on land smaller (or larger) than a size."""
    size = F.col("landmass_area_km2")
    return countable(db).where(size > km2 if above else size < km2).select("storm_id", "landfall_seq", "landfall_admin1", F.round(size, 1).alias("landmass_km2"))


def own_radius(db: Database, km: float = 250.0) -> DataFrame:
    """Storms without landfall that came as near as ``km``."""
    near = db.track_points.groupBy("storm_id").agg(F.min("min_distance_to_coast_km").alias("km")).where(F.col("km") <= km)
    return near.join(db.storms.where("not made_landfall"), "storm_id").select("name", "season", F.round("km", 6).alias("closest_km"))


def major_near_misses(db: Database) -> DataFrame:
    rows = db.bypasses.where(F.col("bypass_ss_category").isin(*MAJOR)).join(db.storms.select("storm_id", "name", "season"), "storm_id")
    return rows.select("name", "season", F.round("bypass_distance_to_coast_km", 6).alias("km"), "bypass_wind_kt", "bypass_ss_category", F.unix_micros("bypass_time_utc").alias("at_us"))


def gate_frequency(db: Database, top: int = 25) -> DataFrame:
    """The gates with the most landfalls."""
    gates = db.landfall_gates.select("gate_id", "region")
    return countable(db).join(gates, "gate_id").groupBy("gate_id", "region").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "gate_id").limit(top)


def fallback_gates(db: Database) -> DataFrame:
    """How many landfalls have only the nearest gate."""
    return countable(db).where("not gate_is_crossing").agg(F.count("*").alias("n"))


def fallback_gate_rows(db: Database) -> DataFrame:
    return countable(db).where("not gate_is_crossing").select("storm_id", "landfall_seq", "gate_id", F.round("gate_distance_km", 6).alias("km"))


def landfall_wind(db: Database) -> DataFrame:
    """The best known wind of each landfall."""
    return countable(db).select("storm_id", "landfall_seq", F.coalesce("exact_wind_kt", "sixhr_wind_kt").alias("wind_kt"))


def closest_approach(db: Database, km: float = 250.0) -> DataFrame:
    """Every storm's closest approach within ``km``, whether or not it made landfall."""
    return db.track_points.groupBy("storm_id").agg(F.round(F.min("min_distance_to_coast_km"), 6).alias("closest_km")).where(F.col("closest_km") <= km)


def us_view(db: Database) -> DataFrame:
    return db.views()["v_us_landfalls"].select("storm_id", "landfall_seq", "name", "season", "basin", "landfall_admin1", "exact_wind_kt")


def mean_radii(track: DataFrame, since: int = 2021) -> DataFrame:
    """Mean 34 kt radius over the quadrants, and the radius of maximum wind, of recent fixes that have both.

    ``track`` is a parsed track (the quadrant radii are columns of its own).
    """
    quadrants = [F.col(f"r34_{q}_nm") for q in ("ne", "se", "sw", "nw")]
    mean = sum(quadrants[1:], quadrants[0]) / F.lit(4.0)
    rows = track.where((F.col("season") >= since) & F.col("radius_max_wind_nm").isNotNull())
    return rows.select("storm_id", "point_seq", mean.alias("mean_r34_nm"), "radius_max_wind_nm").where("mean_r34_nm is not null")


def provenance(db: Database) -> DataFrame:
    """The build's metadata: key and value."""
    return db.metadata
