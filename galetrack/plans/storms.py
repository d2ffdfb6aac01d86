"""From tracks and land to the analytical tables."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from galetrack.functions import domain, sql
from galetrack.operators import cover, geometry, landfall, summary
from galetrack.operators.stage import settle
from galetrack.plans import checks
from galetrack.sources import geoparquet


TABLES = ("storms", "track_points", "landfalls", "bypasses", "landfall_gates", "metadata")
#: What the landfall table holds, in a sentence for its users.
LANDFALL_RULE = "A storm centre crosses from water onto land that it was not on already, whatever its strength; flags of the archive are never demoted."


@dataclass
class Database:
    """The tables of one build."""

    storms: DataFrame
    track_points: DataFrame
    landfalls: DataFrame
    bypasses: DataFrame
    landfall_gates: DataFrame
    metadata: DataFrame
    #: What a watched build counted while it wrote, by table.
    observations: dict[str, Observation] = field(default_factory=dict)

    def views(self) -> dict[str, DataFrame]:
        """The joined and geometric views: WKT beside the tables' columns."""
        us = self.landfalls.where("is_landfall and is_us_landfall").join(self.storms.select("storm_id", "name", "season", "basin"), "storm_id")
        wkt = domain.point_wkt
        return {
            "v_us_landfalls": us,
            "v_track_points": self.track_points.withColumns({"position_wkt": wkt(F.col("longitude"), F.col("latitude")), "nearest_coast_wkt": wkt(F.col("nearest_coast_lon"), F.col("nearest_coast_lat"))}),
            "v_landfalls": self.landfalls.withColumns({"position_wkt": wkt(F.col("exact_lon"), F.col("exact_lat")), "sixhr_wkt": wkt(F.col("sixhr_lon"), F.col("sixhr_lat"))}),
            "v_storms": self.storms.where("track_wkt is not null"),
            "v_landfall_gates": self.landfall_gates.withColumn("gate_wkt", domain.line_wkt(*[F.col(c) for c in ("x1", "y1", "x2", "y2")])),
        }

    def geometric(self) -> dict[str, DataFrame]:
        """The tables with ``geometry`` and ``bbox``, where they have a place: storms as lines of their
        fixes (null for fewer than two), gates as lines, all else as points."""
        gate = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("x1", "y1"), ("x2", "y2"))])
        drawn = self.storms.join(summary.track_spots(self.track_points), "storm_id", "left")
        return {
            "storms": geoparquet.line(drawn, F.col("spots")).drop("spots"),
            "track_points": geoparquet.point(self.track_points, "longitude", "latitude"),
            "landfalls": geoparquet.point(self.landfalls, "exact_lon", "exact_lat"),
            "bypasses": geoparquet.point(self.bypasses, "bypass_lon", "bypass_lat"),
            "landfall_gates": geoparquet.line(self.landfall_gates, gate),
            "metadata": self.metadata,
        }

    def register(self, prefix: str = "") -> None:
        """Temporary views of the tables and the joined ones, by ``prefix`` and name, and the SQL functions."""
        sql.register(self.storms.sparkSession)
        for name in TABLES:
            getattr(self, name).createOrReplaceTempView(prefix + name)
        for name, rows in self.views().items():
            rows.createOrReplaceTempView(prefix + name)


@dataclass
class Land:
    """Land and gates, made ready for builds."""

    edges: DataFrame
    units: DataFrame
    gates: DataFrame | None
    index: DataFrame
    coast: DataFrame
    masses: DataFrame
    mainland: int | None


def prepare(edges: DataFrame, units: DataFrame, gates: DataFrame | None, mainland_country: str | None = "US") -> Land:
    index = settle(cover.build(edges), "cover")
    fine = settle(geometry.split_edges(edges), "split-edges")
    coast = settle(geometry.boundary_edges(fine), "coast")
    masses = settle(geometry.landmasses(fine), "landmasses")
    return Land(edges, units, gates, index, coast, masses, geometry.mainland_landmass(units, masses, mainland_country) if mainland_country else None)


def build(
    points: DataFrame,
    seasons: DataFrame,
    edges: DataFrame,
    units: DataFrame,
    gates: DataFrame,
    step_km: float = 1.0,
    planar: bool = False,
    mainland_country: str | None = "US",
    conus: list[str] | None = None,
    radius_km: float = 111.12,
    provenance: dict[str, str] | None = None,
    land: Land | None = None,
) -> Database:
    """All tables of a set of tracks. Nothing is collected but the mainland's number.

    ``planar`` interpolates in degrees and measures on the mean sphere.
    ``provenance`` (sources, checksums, calibrations) goes into the metadata. ``land`` is
    what :func:`prepare` made of the same land and gates, if there are several builds.
    """
    land = land or prepare(edges, units, gates, mainland_country)
    index, coast = land.index, land.coast
    falls = landfalls(points, seasons, edges, units, gates, index, land.masses, land.mainland, step_km, planar, conus)
    falls, seen_falls = checks.watch(falls, "landfalls")
    falls = settle(falls, "landfalls")
    track, seen_track = checks.watch(summary.enrich(points, index, coast, planar), "track_points")
    track = settle(track, "track-points")
    storms_ = settle(summary.storms(track, falls, seasons), "storms")
    given = {"schema_version": SCHEMA_VERSION, "landfall_definition": LANDFALL_RULE, "step_km": f"{step_km:g}", "bypass_radius_km": f"{radius_km:g}", **(provenance or {})}
    return Database(storms_, track, falls, summary.bypasses(track, falls, radius_km), gates, metadata(given, gates, storms_, track), {"landfalls": seen_falls, "track_points": seen_track})


SCHEMA_VERSION = "2"


def metadata(given: dict[str, str], gates: DataFrame, storms_: DataFrame, track: DataFrame) -> DataFrame:
    """key and value: what was given, and the tables' sizes."""
    out = gates.sparkSession.createDataFrame(sorted(given.items()), "key string, value string")
    for key, rows in (("gate_count", gates), ("storm_count", storms_), ("track_point_count", track)):
        out = out.unionByName(rows.agg(F.count("*").cast("string").alias("value")).select(F.lit(key).alias("key"), "value"))
    return out


def landfalls(points, seasons, edges, units, gates, index, masses, mainland, step_km=1.0, planar=False, conus=None) -> DataFrame:
    """The landfall table."""
    segs = landfall.segments(points)
    found = settle(landfall.crossings(segs, index, step_km, planar), "crossings")
    made = settle(landfall.events(points, segs, landfall.match_flags(segs, found)), "events")
    placed = settle(landfall.attribute(made, index, edges, units, masses, mainland, planar), "placed")
    ordered = landfall.sequence(placed, points, index)
    rows = landfall.finish(landfall.preceding_synoptic(ordered, points), seasons, conus)
    if gates is not None:
        rows = landfall.attribute_gates(rows, gates, planar)
    return rows


# Tracks and land from the driver's tables: integer recipes, the same in any SQL engine.

FIXES_SQL = """
select user_id as storm_id, cast(point_seq as int) as point_seq, cast(ts as timestamp) as timestamp_utc,
       cast(lon10 as double) / 10 as longitude, cast(lat10 as double) / 10 as latitude,
       case event_type when 'view' then 'TS' when 'signup' then 'TD' when 'error' then 'EX' when 'click' then 'HU' else 'LO' end as status,
       case when event_id % 13 = 0 and user_id % 11 not in (0, 5) then 'L' end as record_identifier,
       cast(case when event_id % 17 <> 0 then 15 + (event_id * 7 % 30) * 5 end as int) as max_wind_kt,
       cast(case when event_id % 5 <> 0 then 1010 - (event_id * 7 % 30) * 3 end as int) as min_pressure_mb,
       hour(ts) % 6 = 0 as is_synoptic
from (
  select *, row_number() over (partition by user_id order by ts, event_id) - 1 as point_seq,
         -850 + (user_id * 53 % 300) - 150 + case when user_id % 11 in (0, 5) then 380 else 0 end + sum((event_id * 37 % 41) - 20) over (partition by user_id order by ts, event_id rows unbounded preceding) as lon10,
         250 + (user_id * 29 % 160) - 80 + sum((event_id * 31 % 21) - 10) over (partition by user_id order by ts, event_id rows unbounded preceding) as lat10
  from events
) e
"""
SEASONS_SQL = """
select user_id as storm_id, cast(1851 + user_id % 175 as int) as season,
       concat('STORM', cast(user_id as varchar(20))) as name, case user_id % 3 when 0 then 'AL' when 1 then 'EP' else 'CP' end as basin
from events group by user_id
"""
UNITS_SQL = """
select cast(n_nationkey as int) as unit_id, n_name as admin1_name, r_name as country_name,
       case n_regionkey when 1 then 'US' when 2 then 'MX' else cast(n_regionkey as varchar(5)) end as iso_country,
       -1100317 + 120000 * (n_nationkey % 5) + case when n_nationkey in (3, 17) then 30000 else 0 end as ix1,
       -1100317 + 120000 * (n_nationkey % 5) + case when n_nationkey in (3, 17) then 36000 when n_nationkey % 2 = 0 then 120000 else 80000 end as ix2,
       80317 + 80000 * cast(floor(n_nationkey / 5) as int) as iy1,
       80317 + 80000 * cast(floor(n_nationkey / 5) as int) + case when n_nationkey in (3, 17) then 6000 else 60000 end as iy2
from nation join region on n_regionkey = r_regionkey
"""


@dataclass
class Inputs:
    points: DataFrame
    seasons: DataFrame
    units: DataFrame
    edges: DataFrame
    gates: DataFrame


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Tracks, land and gates from events, nation and region."""
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("events", "nation", "region")}
    run = lambda text: spark.sql(re.sub(r"\b(from|join) (events|nation|region)\b", r"\1 {\2}", text), **tables)
    units = run(UNITS_SQL)
    deg = lambda c: F.col(c) / F.lit(10000.0)
    box = units.select("unit_id", deg("ix1").alias("a"), deg("ix2").alias("b"), deg("iy1").alias("c"), deg("iy2").alias("d"))
    sides = [("a", "c", "b", "c"), ("b", "c", "b", "d"), ("b", "d", "a", "d"), ("a", "d", "a", "c")]
    edges = box.select("unit_id", F.explode(F.array(*[F.struct(F.col(w).alias("x1"), F.col(x).alias("y1"), F.col(y).alias("x2"), F.col(z).alias("y2")) for w, x, y, z in sides])).alias("e")).select("unit_id", "e.*")
    # One gate along each unit's west side.
    gates = box.join(units.select("unit_id", "admin1_name"), "unit_id").select(
        F.format_string("G%03d", "unit_id").alias("gate_id"), F.col("admin1_name").alias("gate_name"), F.col("admin1_name").alias("region"), F.col("unit_id").alias("sort_order"),
        F.col("a").alias("x1"), F.col("c").alias("y1"), F.col("a").alias("x2"), F.col("d").alias("y2"),
    )
    return Inputs(
        settle(run(FIXES_SQL), "fixes"), settle(run(SEASONS_SQL), "seasons"),
        settle(units.select("unit_id", "admin1_name", "country_name", "iso_country"), "units"), settle(edges, "edges"), settle(gates, "gates"),
    )
