"""Queries over the planar build, each with its DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galetrack.functions import domain, wkb
from galetrack.operators.stage import shared_root
from galetrack.plans import analytics as a
from galetrack.plans import checks, external, planar, workload
from galetrack.plans.storms import Database
from galetrack.sources import geoparquet

CONUS = planar.CONUS
HURRICANE, _, _, OTHER, UNKNOWN = domain.CLASSES
#: name: (rows of the database, SQL over the tables of ``planar``).
QUERIES: dict[str, tuple[Callable[[Database], DataFrame], str]] = {}


def put(name: str, sql: str, make: Callable[[Database], DataFrame]) -> None:
    QUERIES[name] = make, planar.over_tables(sql)


def conus(db: Database) -> DataFrame:
    return a.scope(db, CONUS)


def us(column: str) -> str:
    """Microseconds of a time, in SQL."""
    return f"epoch_us({column})"


def flags(*names: str) -> list:
    return [F.col(n).cast("int").alias(n) for n in names]


def km(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


# The tables.

put(
    "planar_landfalls",
    f"select storm_id, landfall_seq, landfall_type, cast(is_landfall as int) as is_landfall, detection_method, {us('exact_time')} as exact_us, round(exact_lon, 6) as exact_lon,"
    " round(exact_lat, 6) as exact_lat, exact_wind_kt, exact_pressure_mb, status_at_landfall, cast(exact_is_offcadence as int) as exact_is_offcadence, exact_ss_category, event_class,"
    " cast(is_us_landfall as int) as is_us_landfall, cast(is_tropical_at_landfall as int) as is_tropical_at_landfall, cast(native_flagging_complete as int) as native_flagging_complete from landfalls",
    lambda db: db.landfalls.select(
        "storm_id", "landfall_seq", "landfall_type", "detection_method", F.unix_micros("exact_time").alias("exact_us"), *km("exact_lon", "exact_lat"), "exact_wind_kt", "exact_pressure_mb",
        "status_at_landfall", "exact_ss_category", "event_class", *flags("is_landfall", "exact_is_offcadence", "is_us_landfall", "is_tropical_at_landfall", "native_flagging_complete"),
    ),
)
put(
    "planar_synoptic",
    f"select storm_id, landfall_seq, {us('exact_time')} as exact_us, {us('sixhr_time')} as sixhr_us, sixhr_lat, sixhr_lon, sixhr_wind_kt, sixhr_pressure_mb, sixhr_ss_category, round(hours_from_6hr_to_landfall, 6) as hours from landfalls",
    lambda db: db.landfalls.select(
        "storm_id", "landfall_seq", F.unix_micros("exact_time").alias("exact_us"), F.unix_micros("sixhr_time").alias("sixhr_us"), "sixhr_lat", "sixhr_lon", "sixhr_wind_kt", "sixhr_pressure_mb",
        "sixhr_ss_category", F.round("hours_from_6hr_to_landfall", 6).alias("hours"),
    ),
)
put(
    "planar_places",
    f"select storm_id, landfall_seq, {us('exact_time')} as exact_us, unit_id, landfall_admin1, landfall_country, landfall_iso, landmass_id, round(landmass_area_km2, 2) as landmass_area_km2,"
    " cast(is_mainland_landfall as int) as is_mainland_landfall, cast(is_attribution_exact as int) as is_attribution_exact, round(landfall_admin_distance_km, 6) as landfall_admin_distance_km from landfalls",
    lambda db: db.landfalls.select(
        "storm_id", "landfall_seq", F.unix_micros("exact_time").alias("exact_us"), "unit_id", "landfall_admin1", "landfall_country", "landfall_iso", "landmass_id", F.round("landmass_area_km2", 2).alias("landmass_area_km2"),
        *flags("is_mainland_landfall", "is_attribution_exact"), *km("landfall_admin_distance_km"),
    ),
)
put(
    "planar_gates",
    f"select storm_id, landfall_seq, {us('exact_time')} as exact_us, gate_id, gate_region, cast(gate_is_crossing as int) as gate_is_crossing, round(gate_distance_km, 6) as gate_distance_km from landfalls",
    lambda db: db.landfalls.select("storm_id", "landfall_seq", F.unix_micros("exact_time").alias("exact_us"), "gate_id", "gate_region", *flags("gate_is_crossing"), *km("gate_distance_km")),
)
put(
    "planar_track_points",
    "select storm_id, point_seq, cast(is_over_land as int) as is_over_land, cast(is_native_landfall_record as int) as is_native_landfall_record, round(min_distance_to_coast_km, 6) as min_distance_to_coast_km,"
    " round(nearest_coast_lon, 6) as nearest_coast_lon, round(nearest_coast_lat, 6) as nearest_coast_lat, ss_category, event_class from track_points",
    lambda db: db.track_points.select("storm_id", "point_seq", *flags("is_over_land", "is_native_landfall_record"), *km("min_distance_to_coast_km", "nearest_coast_lon", "nearest_coast_lat"), "ss_category", "event_class"),
)
put(
    "planar_storms",
    f"select storm_id, season, name, basin, {us('start_time_utc')} as start_us, {us('end_time_utc')} as end_us, peak_wind_kt, min_pressure_mb, round(min_distance_to_coast_km, 6) as min_distance_to_coast_km,"
    " n_track_points, event_class, peak_ss_category, n_landfalls, n_us_landfalls, cast(made_landfall as int) as made_landfall from storms",
    lambda db: db.storms.select(
        "storm_id", "season", "name", "basin", F.unix_micros("start_time_utc").alias("start_us"), F.unix_micros("end_time_utc").alias("end_us"), "peak_wind_kt", "min_pressure_mb", *km("min_distance_to_coast_km"),
        "n_track_points", "event_class", "peak_ss_category", "n_landfalls", "n_us_landfalls", *flags("made_landfall"),
    ),
)
put(
    "planar_bypasses",
    f"select storm_id, {us('bypass_time_utc')} as at_us, bypass_lat, bypass_lon, round(bypass_distance_to_coast_km, 6) as km, round(nearest_coast_lon, 6) as nearest_coast_lon, round(nearest_coast_lat, 6) as nearest_coast_lat,"
    " bypass_wind_kt, bypass_pressure_mb, bypass_ss_category, bypass_status from near_misses",
    lambda db: db.bypasses.select(
        "storm_id", F.unix_micros("bypass_time_utc").alias("at_us"), "bypass_lat", "bypass_lon", F.round("bypass_distance_to_coast_km", 6).alias("km"), *km("nearest_coast_lon", "nearest_coast_lat"),
        "bypass_wind_kt", "bypass_pressure_mb", "bypass_ss_category", "bypass_status",
    ).orderBy("storm_id"),
)
put(
    "planar_track_lines",
    "select storm_id, count(*) as n_fixes, arg_min(longitude, point_seq) as first_lon, arg_max(latitude, point_seq) as last_lat from track_points group by 1 having count(*) >= 2",
    lambda db: db.views()["v_storms"].select(
        "storm_id", F.size(F.split("track_wkt", ", ")).cast("long").alias("n_fixes"), F.regexp_extract("track_wkt", r"\((-?[0-9.]+) ", 1).cast("double").alias("first_lon"), F.regexp_extract("track_wkt", r" (-?[0-9.]+)\)$", 1).cast("double").alias("last_lat")
    ),
)
put("planar_metadata", "select 'gate_count' as key, cast(count(*) as varchar) as value from gates union all select 'storm_count', cast(count(*) as varchar) from seasons union all select 'track_point_count', cast(count(*) as varchar) from fixes", lambda db: workload.provenance(db).where(F.col("key").endswith("_count")))

# Everyday questions.

_FALLS = "from falls where is_landfall"
put("sql_us_landfall_intensity", f"select season, name, landfall_seq, landfall_admin1, coalesce(exact_wind_kt, sixhr_wind_kt) as wind_kt, case when exact_wind_kt is null then sixhr_ss_category else exact_ss_category end as ss_category {_FALLS} and is_us_landfall", workload.us_landfall_intensity)
put("sql_late_intensification", f"select name, season, landfall_seq, landfall_admin1, sixhr_wind_kt, exact_wind_kt, exact_wind_kt - sixhr_wind_kt as delta_kt, round(hours_from_6hr_to_landfall, 6) as hours {_FALLS} and exact_wind_kt - sixhr_wind_kt >= 15", workload.late_intensification)
put("sql_landfalls_by_state_category", f"select landfall_admin1, exact_ss_category, count(*) as n {_FALLS} and landfall_iso = 'US' group by all", workload.landfalls_by_state_category)
put("sql_major_landfalls_per_decade", f"select cast(season // 10 * 10 as int) as decade, count(*) as n {_FALLS} and is_us_landfall and exact_wind_kt >= 96 group by 1", workload.major_landfalls_per_decade)
put("sql_detection_methods", f"select detection_method, count(*) as n {_FALLS} group by 1", workload.detection_methods)
put("sql_inferred_where_unflagged", f"select season, name, landfall_seq, landfall_admin1, exact_wind_kt {_FALLS} and is_us_landfall and not native_flagging_complete and detection_method = 'inferred'", workload.inferred_where_unflagged)
put("sql_native_only", "select storm_id, landfall_seq, landfall_admin1, exact_wind_kt, round(landfall_admin_distance_km, 6) as distance_km from falls where detection_method = 'native'", workload.native_only)
put("sql_several_countries", f"select name, season, count(distinct landfall_iso) as countries, string_agg(distinct landfall_iso, ',' order by landfall_iso) as iso_list {_FALLS} group by storm_id, name, season having count(distinct landfall_iso) > 1", workload.several_countries)
put(
    "sql_two_countries",
    f"select name, season, landfall_seq, landfall_iso, landfall_admin1, {us('exact_time')} as exact_us, exact_wind_kt {_FALLS} and storm_id in (select storm_id {_FALLS} and landfall_iso = 'MX') and storm_id in (select storm_id {_FALLS} and landfall_iso = 'US')",
    workload.two_countries,
)
put("sql_island_then_mainland", f"select name, season, landfall_seq, landfall_admin1, cast(is_mainland_landfall as int) as mainland, round(landmass_area_km2, 1) as landmass_km2 {_FALLS} and landfall_iso = 'US'", workload.island_then_mainland)
put("sql_small_islands", f"select storm_id, landfall_seq, landfall_admin1, round(landmass_area_km2, 1) as landmass_km2 {_FALLS} and landmass_area_km2 < 5000", workload.by_landmass_size)
put("sql_large_landmasses", f"select storm_id, landfall_seq, landfall_admin1, round(landmass_area_km2, 1) as landmass_km2 {_FALLS} and landmass_area_km2 > 5000", lambda db: workload.by_landmass_size(db, above=True))
put("sql_own_radius", "select name, season, round(min_distance_to_coast_km, 6) as closest_km from storms where not made_landfall and min_distance_to_coast_km <= 250", workload.own_radius)
put("sql_closest_approach", "select storm_id, round(min_distance_to_coast_km, 6) as closest_km from storms where min_distance_to_coast_km <= 250", workload.closest_approach)
put("sql_major_near_misses", f"select name, season, round(bypass_distance_to_coast_km, 6) as km, bypass_wind_kt, bypass_ss_category, {us('bypass_time_utc')} as at_us from near_misses join storms using (storm_id) where bypass_wind_kt >= 96", workload.major_near_misses)
put("sql_gate_frequency", f"select gate_id, gate_region as region, count(*) as n {_FALLS} and gate_id is not null group by 1, 2 order by n desc, gate_id limit 25", workload.gate_frequency)
put("sql_fallback_gates", f"select count(*) as n {_FALLS} and not gate_is_crossing", workload.fallback_gates)
put("sql_fallback_gate_rows", f"select storm_id, landfall_seq, gate_id, round(gate_distance_km, 6) as km {_FALLS} and not gate_is_crossing", workload.fallback_gate_rows)
put("sql_landfall_wind", f"select storm_id, landfall_seq, coalesce(exact_wind_kt, sixhr_wind_kt) as wind_kt {_FALLS}", workload.landfall_wind)
put("sql_us_view", f"select storm_id, landfall_seq, name, season, basin, landfall_admin1, exact_wind_kt {_FALLS} and is_us_landfall", workload.us_view)

# Analytics.

_SMOOTH = "case when count(n) over w >= 6 then round(avg(n) over w, 6) end"
_ROWS = "rows between 5 preceding and 4 following"
_YEARS = "(select season, sum(n) as n, sum(flagged) as flagged from yearly group by 1)"


def _pct(part: str, whole: str, digits: int = 1) -> str:
    return f"round_even(100.0 * ({part}) / nullif({whole}, 0), {digits})"


put(
    "table_inventory",
    "select 'storms' as table_name, count(*) as n_rows from storms union all select 'track_points', count(*) from track_points union all select 'landfalls', count(*) from landfalls"
    " union all select 'bypasses', count(*) from near_misses union all select 'landfall_gates', count(*) from gates",
    a.table_inventory,
)
put(
    "class_overview",
    "select event_class, (select count(*) from track_points t where t.event_class = c.event_class) as track_points, (select count(*) from storms t where t.event_class = c.event_class) as storms,"
    " (select count(*) from landfalls t where t.event_class = c.event_class) as landfalls, (select count(*) from near_misses t where t.event_class = c.event_class) as bypasses from classes c",
    a.class_overview,
)
put("storms_by_season_class", "select season, event_class, count(*) as n from storms group by all", a.storms_by_season_class)
put("storms_by_basin_class", "select basin, event_class, count(*) as n from storms group by all", lambda db: a.storms_by_season_class(db, "basin"))
put("misleading_categories", f"select ss_category, count(*) as n from track_points where max_wind_kt >= 64 and event_class = '{OTHER}' group by 1", a.misleading_categories)
put(
    "scope_counts",
    f"select (select count(*) {_FALLS} and is_us_landfall) as us_landfalls, count(*) as in_scope, (select count(*) {_FALLS} and is_us_landfall and landfall_admin1 not in ({planar.QUOTED})) as outside,"
    " count(distinct storm_id) as storms, min(season) as first_season, max(season) as last_season from conus",
    lambda db: a.scope_counts(db, CONUS),
)
put("intensity_composition", f"select exact_ss_category, count(*) as n, any_value((select {_pct('count(*) filter (exact_wind_kt >= 64)', 'count(*)')} from conus)) as hurricane_pct from conus group by 1", lambda db: a.intensity_composition(conus(db)))
put("latest_season", f"select season, name, {us('exact_time')} as exact_us, landfall_admin1, exact_wind_kt, exact_ss_category, detection_method from conus where season = (select max(season) from conus)", lambda db: a.latest_season(conus(db)))
put("national_series", f"select cast(season as int) as season, cast(n as bigint) as n, {_SMOOTH} as smoothed from {_YEARS} window w as (order by season {_ROWS})", lambda db: a.national_series(conus(db)))
put("class_series", f"select cast(season as int) as season, event_class, n, {_SMOOTH} as smoothed from yearly window w as (partition by event_class order by season {_ROWS})", lambda db: a.class_series(conus(db)))
put("series_extremes", f"select round(avg(n), 6) as mean, cast(max(n) as bigint) as most, cast(arg_max(season, n * 10000 - season) as int) as in_season, count(*) filter (n = 0) as none from {_YEARS}", lambda db: a.series_extremes(conus(db)))
put(
    "state_composition",
    f"select landfall_admin1, event_class, count(*) as n, any_value(total) as total, any_value(pct) as hurricane_pct from conus"
    f" join (select landfall_admin1, count(*) as total, {_pct(f"count(*) filter (event_class = '{HURRICANE}')", 'count(*)')} as pct from conus group by 1) using (landfall_admin1) group by 1, 2",
    lambda db: a.state_composition(conus(db)),
)
put("state_matrix", "select landfall_admin1, season, event_class, count(*) as n from conus group by all", lambda db: a.state_matrix(conus(db)))
put(
    "state_trends",
    "select landfall_admin1, cast(season as int) as season, event_class, smoothed from (select *,"
    f" {_SMOOTH} as smoothed from (select landfall_admin1, season, event_class, count(c.storm_id) as n from grid cross join (select distinct landfall_admin1 from conus) left join conus c using (landfall_admin1, season, event_class) group by all)"
    f" window w as (partition by landfall_admin1, event_class order by season {_ROWS})) where smoothed > 0",
    lambda db: a.state_trends(conus(db)),
)
put(
    "detection_by_decade",
    "select event_class, cast(season // 10 * 10 as int) as decade, count(*) filter (detection_method = 'native_confirmed') as native_confirmed, count(*) filter (detection_method = 'native') as native,"
    " count(*) filter (detection_method = 'inferred') as inferred from conus group by 1, 2",
    lambda db: a.detection_by_decade(conus(db)),
)
put(
    "native_visibility",
    f"select *, {_pct('flagged', 'landfalls', 0)} as flagged_pct, storms - storms_flagged as only_inferred from (select count(*) as landfalls, count(*) filter (detection_method <> 'inferred') as flagged,"
    " count(distinct storm_id) as storms, count(distinct storm_id) filter (detection_method <> 'inferred') as storms_flagged from conus)",
    lambda db: a.native_visibility(conus(db)),
)
put(
    "era_deltas",
    "select case when season <= 1970 then '1851-1970' when season <= 1990 then '1971-1990' else '1991 onward' end as era, count(*) as seasons, cast(sum(n) as bigint) as detected, cast(sum(flagged) as bigint) as flagged,"
    f" cast(sum(n - flagged) as bigint) as delta_total, round(avg(n - flagged), 6) as delta_mean, median(n - flagged) as delta_median, cast(max(n - flagged) as bigint) as delta_max, {_pct('sum(n - flagged)', 'sum(n)')} as inferred_pct,"
    f" count(*) filter (flagged = 0 and n > 0) as blind_seasons from {_YEARS} group by 1",
    lambda db: a.era_deltas(conus(db)),
)
put("season_deltas", f"select cast(season as int) as season, cast(d as bigint) as delta, {_SMOOTH} as smoothed from (select season, n - flagged as d, n - flagged as n from {_YEARS}) window w as (order by season {_ROWS})", lambda db: a.season_deltas(conus(db)))
put("class_deltas", "select cast(season as int) as season, event_class, n - flagged as delta from yearly where n > flagged", lambda db: a.class_deltas(conus(db)))
_KM = "landfall_admin_distance_km"
put(
    "attribution_quality",
    f"select detection_method, count(*) as n, count(*) filter (is_attribution_exact) as exact, count(*) filter (not is_attribution_exact) as inexact, {_pct('count(*) filter (not is_attribution_exact)', 'count(*)', 2)} as inexact_pct,"
    f" round(median({_KM}), 6) as median_km, round(quantile_cont({_KM}, 0.95), 6) as p95_km, round(max({_KM}), 6) as max_km from falls group by 1",
    a.attribution_quality,
)
put("missed_flags", "select case when not missed then 'reproduced' when is_attribution_exact then 'already_ashore' else 'off_land' end as mechanism, count(*) as n, median(landfall_seq) as median_seq from flagged group by 1", a.missed_flags)
put(
    "miss_rate_by_mainland",
    f"select cast(is_mainland_landfall as int) as mainland, event_class, count(*) filter (missed) as missed, count(*) as n, {_pct('count(*) filter (missed)', 'count(*)')} as miss_pct from flagged group by 1, 2",
    lambda db: a.miss_rate(db, "mainland", "event_class"),
)
put("miss_rate_by_class", f"select event_class, count(*) filter (missed) as missed, count(*) as n, {_pct('count(*) filter (missed)', 'count(*)')} as miss_pct from flagged group by 1", lambda db: a.miss_rate(db, "event_class"))
put(
    "offshore_distances",
    f"select round(min({_KM}), 6) as least_km, round(quantile_cont({_KM}, 0.25), 6) as q25_km, round(median({_KM}), 6) as median_km, round(quantile_cont({_KM}, 0.75), 6) as q75_km, round(max({_KM}), 6) as most_km,"
    f" count(*) filter ({_KM} <= 11.119) as within, count(*) as n from offshore",
    a.offshore_distances,
)
put("furthest_offshore", f"select storm_id, {us('exact_time')} as exact_us, landfall_admin1, landfall_country, exact_wind_kt, event_class, round({_KM}, 6) as km from offshore order by km desc, storm_id, exact_us limit 6", a.furthest_offshore)
put("exact_share", "select detection_method, round_even(100.0 * avg(cast(is_attribution_exact as double)), 1) as exact_pct, count(*) as n from falls group by 1", a.exact_share)
put(
    "distance_histogram",
    f"select cast(b as int) as bin, count(f.storm_id) as n from (select unnest(range(7)) as b, unnest([0, 1, 5, 11.119, 25, 50, 100]) as low, unnest([1, 5, 11.119, 25, 50, 100, 1000]) as high) left join falls f on {_KM} > low and {_KM} <= high group by 1",
    a.distance_histogram,
)
put("timing_totals", "select count(*) as n, count(*) filter (delta_kt <> 0) as differ, count(*) filter (delta_kt > 0) as stronger, count(*) filter (delta_kt < 0) as weaker, max(delta_kt) as most_kt from timing", lambda db: a.timing_totals(conus(db)))
put("strongest_rises", "select name, season, landfall_seq, landfall_admin1, sixhr_wind_kt, exact_wind_kt, delta_kt, round(hours_from_6hr_to_landfall, 6) as hours from timing order by delta_kt desc, name, landfall_seq limit 6", lambda db: a.strongest_rises(conus(db)))
put("timing_by_class", f"select event_class, count(*) as n, {_pct('count(*) filter (delta_kt <> 0)', 'count(*)')} as differ_pct, median(abs(delta_kt)) as median_kt, max(delta_kt) as most_kt from timing where event_class <> '{UNKNOWN}' group by 1", lambda db: a.timing_by_class(conus(db)))
_NEAR = "(select * from storms where not made_landfall)"
put(
    "radius_table",
    f"select r as radius_km, count(*) filter (min_distance_to_coast_km <= r) as n, {_pct('count(*) filter (min_distance_to_coast_km <= r)', 'count(*)')} as pct from {_NEAR} cross join (select cast(unnest([50, 111.12, 200, 300, 500]) as double) as r) group by 1",
    a.radius_table,
)
put("approach_histogram", f"select cast(least(59, floor(min_distance_to_coast_km / 25)) as int) as bin, event_class, count(*) as n from {_NEAR} where min_distance_to_coast_km is not null group by 1, 2", a.approach_histogram)
_BIN = "cast(least(2, floor(min_distance_to_coast_km / 100)) as int)"  # the synthetic storms pass within some hundred km
put("approach_histogram_short", f"select {_BIN} as bin, event_class, count(*) as n from {_NEAR} where min_distance_to_coast_km is not null group by 1, 2", lambda db: a.approach_histogram(db, 100.0, 300.0))
_WHERE, _HOW = "landfall_admin1", "detection_method"
put(
    "landfall_cube",
    f"select {_WHERE} as state, event_class, {_HOW} as method, grouping({_WHERE}, event_class, {_HOW}) as level, count(*) as n, count(distinct storm_id) as storms, max(exact_wind_kt) as wind from falls where is_landfall group by cube ({_WHERE}, event_class, {_HOW})",
    lambda db: a.landfall_cube(db),
)
_NATIVE = "detection_method in ('native', 'native_confirmed')"
#: What fails each structural check, counted in SQL.
CHECKS = {
    "unique_storms": "select count(*) - count(distinct storm_id) from storms",
    "unique_points": "select count(*) - count(distinct (storm_id, point_seq)) from track_points",
    "unique_gates": "select count(*) - count(distinct gate_id) from gates",
    "unique_bypasses": "select count(*) - count(distinct storm_id) from near_misses",
    "points_have_storm": "select count(*) from track_points where storm_id not in (select storm_id from storms)",
    "landfalls_have_storm": "select count(*) from landfalls where storm_id not in (select storm_id from storms)",
    "bypasses_have_storm": "select count(*) from near_misses where storm_id not in (select storm_id from storms)",
    "landfalls_have_gate": "select count(*) from landfalls where gate_id not in (select gate_id from gates)",
    "bypass_and_landfall_disjoint": "select count(*) from near_misses where storm_id in (select storm_id from landfalls where is_landfall)",
    "declared_point_counts": "select 0",
    "point_counts": "select count(*) from storms s where n_track_points <> (select count(*) from track_points p where p.storm_id = s.storm_id)",
    "landfall_counts": "select count(*) from storms s where n_landfalls <> (select count(*) from landfalls l where l.storm_id = s.storm_id and is_landfall)",
    "sentinels": "select count(*) from track_points where max_wind_kt in (-999, -99) or min_pressure_mb in (-999, -99)",
    "coordinates_on_globe": "select count(*) from track_points where not (latitude between -90 and 90 and longitude between -180 and 180)",
    "distance_present": "select count(*) from track_points where min_distance_to_coast_km is null",
    "statuses": "select count(*) from track_points where coalesce(status, '') not in ('TD', 'TS', 'HU', 'EX', 'SD', 'SS', 'LO', 'WV', 'DB')",
    "record_identifiers": "select count(*) from track_points where record_identifier not in ('C', 'G', 'I', 'L', 'P', 'R', 'S', 'T', 'W')",
    "categories": "select count(*) from track_points where ss_category not in ('UNK', 'TD', 'TS', '1', '2', '3', '4', '5')",
    "latitudes": "select count(*) from track_points where not latitude between -90 and 90",
    "longitudes": "select count(*) from track_points where not longitude between -180 and 180",
    "winds": "select count(*) from track_points where not max_wind_kt between 0 and 200",
    "pressures": "select count(*) from track_points where not min_pressure_mb between 850 and 1050",
    "numbered_categories_are_hurricanes": "select count(*) from track_points where ss_category in ('1', '2', '3', '4', '5') and coalesce(max_wind_kt, 0) < 64",
    "native_never_demoted": f"select count(*) from landfalls where {_NATIVE} and not is_landfall",
    "reentries_are_inferred": f"select count(*) from landfalls where not is_landfall and {_NATIVE}",
    "sequences_contiguous": "select count(*) from (select storm_id from landfalls where is_landfall group by 1 having min(landfall_seq) <> 1 or max(landfall_seq) <> count(distinct landfall_seq))",
    "us_landfalls_have_unit": "select count(*) from landfalls where is_us_landfall and landfall_admin1 is null",
    "exact_iff_zero_distance": "select count(*) from landfalls where is_attribution_exact <> (landfall_admin_distance_km = 0)",
    "geometric_is_exact": "select count(*) from landfalls where detection_method <> 'native' and not is_attribution_exact",
}
put(
    "structural_checks",
    "select * from (" + " union all ".join(f"select '{name}' as \"check\", f as failures, case when f = 0 then 'PASS' else 'FAIL' end as result from (select cast(({text}) as bigint) as f)" for name, text in CHECKS.items()) + ")",
    lambda db: checks.run(db).select("check", "failures", "result"),
)
put("approaches_by_class", f"select c.event_class, count(s.storm_id) as storms, count(s.storm_id) filter (min_distance_to_coast_km <= 300) as within from classes c left join {_NEAR} s using (event_class) group by 1", lambda db: a.approaches_by_class(db, planar.RADIUS_KM))
put("strongest_landfall", f"select storm_id, landfall_seq, exact_wind_kt, {us('exact_time')} as exact_us from peak", lambda db: a.strongest_landfall(conus(db)).select("storm_id", "landfall_seq", "exact_wind_kt", F.unix_micros("exact_time").alias("exact_us")))
put(
    "composition_of_storms",
    f"select event_class, x as crossings, y as storms, {_pct('x', 'sum(x) over ()')} as crossings_pct, {_pct('y', 'sum(y) over ()')} as storms_pct from (select event_class,"
    " (select count(*) from conus t where t.event_class = c.event_class) as x, (select count(*) from peak t where t.event_class = c.event_class) as y from classes c)",
    lambda db: a.composition_of_storms(conus(db)),
)
put(
    "crossings_a_storm",
    "select count(*) as storms, cast(sum(n) as bigint) as crossings, count(*) filter (n > 1) as several, max(n) as most, count(*) filter (wind is null) as no_wind from (select storm_id, count(*) as n, max(exact_wind_kt) as wind from conus group by 1)",
    lambda db: a.crossings_a_storm(conus(db)),
)
put(
    "cut_ratios",
    "select cut, event_class, round((b / nullif(hi - cut + 1, 0)) / nullif(a / nullif(cut - lo, 0), 0), 6) as ratio from (select cut, event_class, count(*) filter (season < cut) as a, count(*) filter (season >= cut) as b from"
    f" (select season, event_class from conus where event_class <> '{UNKNOWN}' union all select season, 'ALL' from conus) cross join (select unnest([1944, 1950, 1966]) as cut) group by 1, 2)"
    " cross join (select min(season) as lo, max(season) as hi from conus)",
    lambda db: a.cut_ratios(conus(db)),
)
put(
    "inferred_share",
    "select cut, round(100.0 * avg(i) filter (season < cut), 6) as before_pct, round(100.0 * avg(i) filter (season >= cut), 6) as after_pct from"
    " (select season, cast(detection_method = 'inferred' as double) as i from conus) cross join (select unnest([1944, 1950, 1966]) as cut) group by 1",
    lambda db: a.inferred_share(conus(db)),
)
put(
    "period_means",
    "select event_class, round(a, 6) as before, round(b, 6) as after, round(b / nullif(a, 0), 6) as ratio from (select event_class, avg(n) filter (season < 1950) as a, avg(n) filter (season >= 1950) as b from yearly group by 1)",
    lambda db: a.period_means(conus(db)),
)
put(
    "modern_storms",
    "select event_class, (select count(*) from peak p where p.event_class = c.event_class and season >= 1950) as modern, (select count(*) from peak p where p.event_class = c.event_class) as full from classes c",
    lambda db: a.modern_storms(conus(db)),
)
_STRIKES = f"(select *, upper(name[1]) || lower(name[2:]) || ' (' || season || ')' as label {_FALLS} and is_us_landfall)"
put(
    "strikes_by_category",
    f"select exact_ss_category, count(*) as n, count(distinct storm_id) as storms, count(*) filter (landfall_admin1 in ({planar.QUOTED})) as in_scope {_FALLS} and is_us_landfall and exact_wind_kt >= 64 and season <= 2024 group by 1",
    lambda db: a.strikes_by_category(db, CONUS),
)
_LABELS = [f"Storm{i} ({1851 + i % 175})" for i in range(0, 40)] + ["Ida (2021)"]
put(
    "label_check",
    "select label, cast(count(s.label) filter (strong) > 0 as int) as found, count(s.label) filter (strong) as landfalls, string_agg(distinct landfall_admin1, ', ' order by landfall_admin1) filter (strong) as units,"
    " max(exact_wind_kt) filter (strong) as wind_kt, case when count(s.label) filter (strong) = 0 then max(exact_wind_kt) end as below_kt"
    f" from (select unnest([{', '.join(repr(x) for x in _LABELS)}]) as label) left join (select *, coalesce(exact_wind_kt >= 64 and season <= 2024, false) as strong from {_STRIKES}) s using (label) group by 1",
    lambda db: a.label_check(db, _LABELS),
)
put("storm_counter", "select season, count(*) as n, cast(sum(count(*)) over (order by season) as bigint) as so_far from storms group by 1", a.storm_counter)
put(
    "display_points",
    f"select storm_id, point_seq, season, longitude, latitude, case when status not in ({planar.TROPICAL}) then 'extratropical' when max_wind_kt >= 64 then 'hurricane' when max_wind_kt >= 34 then 'tropical' else 'depression' end as marker"
    " from track_points join seasons using (storm_id) where storm_id in (select storm_id from conus) and season between 1900 and 1990",
    lambda db: a.display_points(db, CONUS, 1900, 1990),
)
put(
    "summary_counts",
    "select (select count(*) from landfalls) as events, (select count(*) from landfalls where is_landfall) as landfalls, (select count(*) from landfalls where is_landfall and is_us_landfall) as us_landfalls,"
    " (select count(*) from storms) as storms, (select count(*) from track_points) as track_points, (select count(*) from near_misses) as bypasses, (select count(*) from gates) as landfall_gates",
    a.summary_counts,
)

CHOSEN = {3: "Third of the list", 14: "Fourteenth", 10**9: "Nowhere"}
_MARKER = "case when status_at_landfall not in ({0}) then 'extratropical' when exact_wind_kt >= 64 then 'hurricane' when exact_wind_kt >= 34 then 'tropical' else 'depression' end".format(planar.TROPICAL)
put(
    "impact_points",
    f"select season, {_MARKER} as marker, round(exact_lon, 6) as lon, round(exact_lat, 6) as lat from conus",
    lambda db: a.impact_points(db, CONUS).select("season", "marker", *km("lon", "lat")),
)
put(
    "impact_labels",
    "select storm_id, season, case storm_id " + " ".join(f"when {k} then '{v}'" for k, v in CHOSEN.items()) + " else upper(name[1]) || lower(name[2:]) || ' ' || season end as text, round(exact_lon, 6) as lon, round(exact_lat, 6) as lat"
    f" from peak where storm_id in (select storm_id from conus where exact_wind_kt >= 137) or storm_id in ({', '.join(map(str, CHOSEN))})",
    lambda db: a.impact_labels(db, CONUS, CHOSEN).select("storm_id", "season", "text", *km("lon", "lat")),
)
put("state_totals", "select landfall_admin1, count(*) as n from conus group by 1", lambda db: a.state_totals(conus(db)))
put(
    "first_and_last",
    f"select storm_id, {us('exact_time')} as exact_us from conus qualify row_number() over (order by exact_time, storm_id, seg, j, native_only) <= 5 or row_number() over (order by exact_time desc, storm_id desc, seg desc, j desc, native_only desc) <= 5",
    lambda db: a.both_ends(conus(db)).select("storm_id", F.unix_micros("exact_time").alias("exact_us")),
)
put("bypasses_by_storm", "select storm_id, bypass_wind_kt from near_misses", lambda db: db.bypasses.orderBy("storm_id").select("storm_id", "bypass_wind_kt"))

# Tables with geometry, written and read back within a box.

BOX = (-100.0, 10.0, -70.0, 30.0)


def geometric(name: str):
    def rows(db: Database) -> DataFrame:
        spark = db.storms.sparkSession
        path = f"{shared_root(spark)}/geo-{name}-{uuid.uuid4().hex}"
        geoparquet.write(db.geometric()[name], path)
        return geoparquet.read(spark, path, BOX)

    return rows


put(
    "geo_landfalls",
    f"select storm_id, landfall_seq, {us('exact_time')} as exact_us, round(exact_lon, 6) as lon, round(exact_lat, 6) as lat from landfalls where exact_lon between {BOX[0]} and {BOX[2]} and exact_lat between {BOX[1]} and {BOX[3]}",
    lambda db: geometric("landfalls")(db).withColumn("p", wkb.as_point(F.col("geometry"))).select(
        "storm_id", "landfall_seq", F.unix_micros("exact_time").alias("exact_us"), F.round("p.x", 6).alias("lon"), F.round("p.y", 6).alias("lat")
    ),
)
put(
    "geo_storms",
    "select storm_id, cast(count(*) as int) as vertices, arg_min(longitude, point_seq) as first_lon, arg_max(latitude, point_seq) as last_lat, min(longitude) as xmin, max(latitude) as ymax from fixes group by storm_id having count(*) >= 2"
    f" and min(longitude) <= {BOX[2]} and max(longitude) >= {BOX[0]} and min(latitude) <= {BOX[3]} and max(latitude) >= {BOX[1]}",
    lambda db: geometric("storms")(db).withColumn("l", wkb.as_line(F.col("geometry"))).select(
        "storm_id", F.size("l").alias("vertices"), F.element_at("l", 1)["x"].alias("first_lon"), F.element_at("l", -1)["y"].alias("last_lat"), "bbox.xmin", "bbox.ymax"
    ),
)
put(
    "geo_gates",
    f"select gate_id, x1, y1, x2, y2 from gates where x1 between {BOX[0]} and {BOX[2]} and y1 <= {BOX[3]} and y2 >= {BOX[1]}",
    lambda db: geometric("landfall_gates")(db).withColumn("l", wkb.as_line(F.col("geometry"))).select(
        "gate_id", *[F.element_at("l", i)[c].alias(f"{c}{i}") for i in (1, 2) for c in "xy"]
    ),
)

# An external list, made from the seasons by a recipe: it lacks some storms and marks others.

_COUNTED = "(select * from listed where not missed and not in_mexico)"
_EVENTS = "(select * from conus where exact_wind_kt >= 64 qualify row_number() over (partition by storm_id order by exact_time, native_only, seg, j) = 1)"


def listed(db: Database) -> DataFrame:
    rows = db.storms.where("storm_id % 3 <> 0")
    return rows.select(F.col("season").alias("year"), "name", (F.col("storm_id") % 7 == 0).alias("missed"), (F.col("storm_id") % 13 == 0).alias("in_mexico"))


put(
    "external_by_year",
    f"select year, coalesce(a, 0) as listed, coalesce(b, 0) as detected, coalesce(b, 0) - coalesce(a, 0) as diff from (select year, count(*) as a from {_COUNTED} group by 1)"
    f" full join (select season as year, count(*) as b from {_EVENTS} group by 1) using (year)",
    lambda db: external.by_year(db, listed(db), CONUS),
)
put(
    "external_by_era",
    f"select era, flags_complete, a as listed, b as detected, b - a as diff from (select e.era, e.flags_complete, (select count(*) from {_COUNTED} l where l.year between lo and hi) as a, (select count(*) from {_EVENTS} v where v.season between lo and hi) as b"
    " from (values ('1851-1970', 1, 1851, 1970), ('1971-1990', 0, 1971, 1990), ('1991-present', 1, 1991, 9999)) e(era, flags_complete, lo, hi))",
    lambda db: external.by_era(db, listed(db), CONUS),
)
_WEAK = "(select season, name, max(exact_wind_kt) as kt from conus where exact_wind_kt < 64 group by 1, 2)"
put(
    "external_by_name",
    "select * from (select season, name, case when l and d then 'matched' when l and kt is not null then 'below_hurricane' when l then 'only_listed' when d and m then 'annotated' when d then 'only_detected' end as verdict,"
    " case when l and not d then kt end as weak_kt from (select season, name, coalesce(l, false) as l, coalesce(m, false) as m, coalesce(d, false) as d, kt from"
    " (select year as season, name, bool_or(not missed and not in_mexico) as l, bool_or(missed or in_mexico) as m from listed group by 1, 2)"
    f" full join (select distinct season, name, true as d from {_EVENTS} where season >= 1950) using (season, name) left join {_WEAK} using (season, name))) where verdict is not null",
    lambda db: external.by_name(db, listed(db), CONUS),
)
put("outside_scope", f"select count(*) as n {_FALLS} and is_us_landfall and landfall_admin1 = 'NATION_21'", lambda db: external.outside_count(db, ("NATION_21",)))
put("weak_landfalls", f"select season, name, kt as weak_kt from {_WEAK}", lambda db: external.weak_events(db, CONUS))
