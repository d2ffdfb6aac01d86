"""The planar build's tables as DuckDB SQL, from the same integer recipes as the Spark inputs.

Planar samples are plain arithmetic in degrees, so another engine repeats them to the
last digit; only distances (arcs on the mean sphere) are rounded where they are shown.
Units are boxes here, so containment and nearest positions are comparisons and clamps
instead of the engine's edge tables.
"""

from __future__ import annotations

import re

from galetrack.functions import domain
from galetrack.plans import storms

CONUS = ("NATION_1", "NATION_6", "NATION_11", "NATION_16")
STEP_KM, RADIUS_KM = 1.0, 300.0

QUOTED = ", ".join(f"'{c}'" for c in CONUS)
TROPICAL = ", ".join(f"'{s}'" for s in domain.TROPICAL_STATUSES)
HURRICANE, STORM, DEPRESSION, OTHER, UNKNOWN = domain.CLASSES


def category(wind: str) -> str:
    """The intensity label, written from the scale's floors."""
    return (
        f"case when {wind} is null or {wind} < 0 then 'UNK' when {wind} >= 137 then '5' when {wind} >= 113 then '4' when {wind} >= 96 then '3'"
        f" when {wind} >= 83 then '2' when {wind} >= 64 then '1' when {wind} >= 34 then 'TS' else 'TD' end"
    )


def event_class(status: str, wind: str) -> str:
    """Five classes: status first, then wind."""
    return (
        f"case when {status} is null or {status} not in ({TROPICAL}) then '{OTHER}' when {wind} is null then '{UNKNOWN}'"
        f" when {wind} >= 64 then '{HURRICANE}' when {wind} >= 34 then '{STORM}' else '{DEPRESSION}' end"
    )


def arc(x1: str, y1: str, x2: str, y2: str) -> str:
    """Kilometres on the mean sphere."""
    return (
        f"(2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians({y2} - {y1}) / 2), 2)"
        f" + cos(radians({y1})) * cos(radians({y2})) * pow(sin(radians({x2} - {x1}) / 2), 2)))))"
    )


RANK = "case {c} " + " ".join(f"when '{c}' then {i}" for i, c in enumerate(domain.CLASSES)) + " end"
_E2 = "0.0066943799901413165"
_Q = (
    f"((1 - {_E2}) * (sin(radians({{y}})) / (1 - {_E2} * pow(sin(radians({{y}})), 2))"
    f" - 1 / (2 * sqrt({_E2})) * ln((1 - sqrt({_E2}) * sin(radians({{y}}))) / (1 + sqrt({_E2}) * sin(radians({{y}}))))))"
)
#: Orientation of r against the line from p to q.
_TURN = "sign(({qx} - {px}) * ({ry} - {py}) - ({qy} - {py}) * ({rx} - {px}))"


def _turn(p: tuple[str, str], q: tuple[str, str], r: tuple[str, str]) -> str:
    return _TURN.format(px=p[0], py=p[1], qx=q[0], qy=q[1], rx=r[0], ry=r[1])


_A, _B, _C, _D = ("before_lon", "before_lat"), ("exact_lon", "exact_lat"), ("g.x1", "g.y1"), ("g.x2", "g.y2")
_KEY = "storm_id, seg, j, native_only"

#: The unit that holds a point: its box does, sides included, and the point is on no edge of the union's boundary.
HELD = (
    "case when not exists (select 1 from coast c where {x} between c.x1 and c.x2 and {y} between c.y1 and c.y2)"
    " then (select min(h.unit_id) from box h where {x} between h.xa and h.xb and {y} between h.ya and h.yb) end"
)
#: Table expressions in the order of their use.
TABLES = {
    "fixes": storms.FIXES_SQL,
    "seasons": storms.SEASONS_SQL,
    "units": storms.UNITS_SQL,
    "box": "select *, ix1 / 10000.0 as xa, ix2 / 10000.0 as xb, iy1 / 10000.0 as ya, iy2 / 10000.0 as yb from units",
    "sides": (
        "select unit_id, unnest([[ix1, iy1, ix2, iy1], [ix1, iy2, ix2, iy2], [ix1, iy1, ix1, iy2], [ix2, iy1, ix2, iy2]]) as e from units"
    ),
    "coast": "select e[1] / 10000.0 as x1, e[2] / 10000.0 as y1, e[3] / 10000.0 as x2, e[4] / 10000.0 as y2 from sides group by e having count(*) % 2 = 1",
    "gates": "select printf('G%03d', unit_id) as gate_id, admin1_name as region, xa as x1, xa as x2, ya as y1, yb as y2 from box",
    "areas": f"select unit_id, 6378.137 * 6378.137 * radians(xb - xa) * ({_Q.format(y='yb')} - {_Q.format(y='ya')}) / 2 as km2 from box",
    "runs": "select unit_id, sum(case when unit_id % 5 = 0 or unit_id % 2 = 0 or unit_id in (3, 17) then 1 else 0 end) over (order by unit_id) as run from units",
    "masses": "select min(unit_id) as root, run, sum(km2) as landmass_area_km2 from runs join areas using (unit_id) group by run",
    "landmass": (
        "select r.unit_id, m.landmass_area_km2, m.landmass_id from runs r"
        " join (select *, cast(row_number() over (order by round(landmass_area_km2, 6) desc, root) - 1 as int) as landmass_id from masses) m using (run)"
    ),
    "mainland": "select min(landmass_id) as landmass_id from landmass join units using (unit_id) where iso_country = 'US'",
    "segs": (
        "select storm_id, point_seq as seg, timestamp_utc as a_t, longitude as a_lon, latitude as a_lat, max_wind_kt as a_w, min_pressure_mb as a_p, status as a_s,"
        " coalesce(record_identifier = 'L', false) as a_f, lead(timestamp_utc) over w as b_t, lead(longitude) over w as b_lon, lead(latitude) over w as b_lat,"
        " lead(max_wind_kt) over w as b_w, lead(min_pressure_mb) over w as b_p, lead(coalesce(record_identifier = 'L', false)) over w as b_f"
        " from fixes window w as (partition by storm_id order by point_seq) qualify b_f is not null"
    ),
    "cut": f"select *, greatest(1, cast(ceil({arc('a_lon', 'a_lat', 'b_lon', 'b_lat')} / {STEP_KM}) as int)) as n, (b_lon - a_lon + 180.0) - 180.0 as span from segs",
    "samples": "select storm_id, seg, n, j, a_lon + span * (j / n) as lon, a_lat + (b_lat - a_lat) * (j / n) as lat from (select *, unnest(range(0, n + 1)) as j from cut)",
    "placed": f"select s.*, {HELD.format(x='s.lon', y='s.lat')} as unit_id from samples s",
    "steps": (
        "select *, lag(lon) over w as before_lon, lag(lat) over w as before_lat, lag(j) over w as before_j, lag(unit_id) over w as was"
        " from placed window w as (partition by storm_id, seg order by j)"
    ),
    "crossings": "select *, row_number() over (partition by storm_id, seg order by j) - 1 as o from steps where unit_id is not null and was is null and before_j is not null",
    "counted": "select s.storm_id, s.seg, s.a_f, s.b_f, coalesce(c.k, 0) as k from segs s left join (select storm_id, seg, count(*) as k from crossings group by all) c using (storm_id, seg)",
    "settled": "select *, case when k = 0 or not b_f then 0 when k >= 2 or not a_f then 1 end as r from counted",
    "taken": (
        "select *, coalesce(last_value(r ignore nulls) over (partition by storm_id order by seg rows between unbounded preceding and 1 preceding), 0) = 1 as gone from settled"
    ),
    "claims": (
        "select c.*, case when t.a_f and not t.gone then case when o = 0 then seg when o = 1 and t.b_f then seg + 1 end"
        " when o = 0 and t.b_f then seg + 1 end as flag_seq from crossings c join taken t using (storm_id, seg)"
    ),
    "geometric": (
        "select c.storm_id, c.seg, c.j, 0 as native_only, case when flag_seq is null then 'inferred' else 'native_confirmed' end as detection_method,"
        " a_t + to_microseconds(cast(round_even((epoch_us(b_t) - epoch_us(a_t)) * (c.j / c.n), 0) as bigint)) as exact_time, lon as exact_lon, lat as exact_lat,"
        " coalesce(f.max_wind_kt, cast(round_even(a_w + (b_w - a_w) * (c.j / c.n), 0) as int)) as exact_wind_kt,"
        " cast(round_even(a_p + (b_p - a_p) * (c.j / c.n), 0) as int) as exact_pressure_mb, a_s as status_at_landfall, true as exact_is_offcadence,"
        " c.unit_id, before_lon, before_lat"
        " from claims c join segs using (storm_id, seg) left join fixes f on f.storm_id = c.storm_id and f.point_seq = c.flag_seq"
    ),
    "native": (
        "select f.storm_id, f.point_seq as seg, 0 as j, 1 as native_only, 'native' as detection_method, timestamp_utc as exact_time, longitude as exact_lon, latitude as exact_lat,"
        " max_wind_kt as exact_wind_kt, min_pressure_mb as exact_pressure_mb, status as status_at_landfall, not is_synoptic as exact_is_offcadence, "
        f" {HELD.format(x='longitude', y='latitude')} as unit_id, cast(null as double) as before_lon, cast(null as double) as before_lat"
        " from fixes f"
        " where record_identifier = 'L' and storm_id in (select storm_id from fixes group by 1 having count(*) > 1)"
        " and not exists (select 1 from claims c where c.storm_id = f.storm_id and c.flag_seq = f.point_seq)"
    ),
    "found": "select * from geometric union all select * from native",
    "nearest": (
        f"select {_KEY}, b.unit_id, {arc('exact_lon', 'exact_lat', 'nx', 'ny')} as km from"
        " (select f.*, b.unit_id as near_unit, greatest(xa, least(xb, exact_lon)) as nx, greatest(ya, least(yb, exact_lat)) as ny from found f cross join box b where f.unit_id is null) f"
        " join box b on b.unit_id = f.near_unit"
        f" qualify row_number() over (partition by {_KEY} order by round(sqrt(pow(nx - exact_lon, 2) + pow(ny - exact_lat, 2)), 12), near_unit) = 1"
    ),
    "attributed": (
        "select f.* exclude (unit_id), coalesce(f.unit_id, x.unit_id) as unit_id, f.unit_id is not null as is_attribution_exact, coalesce(x.km, 0) as landfall_admin_distance_km,"
        " u.admin1_name as landfall_admin1, u.country_name as landfall_country, u.iso_country as landfall_iso, m.landmass_id, m.landmass_area_km2,"
        " coalesce(m.landmass_id = (select landmass_id from mainland), false) as is_mainland_landfall"
        " from found f left join nearest x using (storm_id, seg, j, native_only) left join units u on u.unit_id = coalesce(f.unit_id, x.unit_id)"
        " left join landmass m on m.unit_id = u.unit_id"
        " qualify row_number() over (partition by f.storm_id, exact_time, round(exact_lat, 9), round(exact_lon, 9) order by native_only, seg, j) = 1"
    ),
    "wet": f"select storm_id, timestamp_utc as t from fixes f where {HELD.format(x='longitude', y='latitude')} is null",
    "soaked": (
        f"select {', '.join('a.' + k for k in _KEY.split(', '))}, count(t) filter (t < exact_time) as below, count(t) filter (t <= exact_time) as upto"
        " from attributed a left join wet w on w.storm_id = a.storm_id group by all"
    ),
    "ordered": (
        "select *, row_number() over w as nth, lag(landmass_id) over w as mass_before, lag(upto) over w as upto_before from attributed join soaked using (storm_id, seg, j, native_only)"
        " window w as (partition by storm_id order by exact_time, native_only, seg, j)"
    ),
    "judged": (
        "select *, detection_method <> 'inferred' or nth = 1 or landmass_id is distinct from mass_before or below > upto_before as is_landfall from ordered"
    ),
    "sequenced": "select *, cast(sum(cast(is_landfall as int)) over (partition by storm_id order by nth) as int) as landfall_seq from judged",
    "synoptic": "select * from fixes where is_synoptic qualify row_number() over (partition by storm_id, timestamp_utc order by point_seq) = 1",
    "timed": (
        "select s.*, y.timestamp_utc as sixhr_time, y.latitude as sixhr_lat, y.longitude as sixhr_lon, y.max_wind_kt as sixhr_wind_kt, y.min_pressure_mb as sixhr_pressure_mb"
        " from sequenced s asof left join synoptic y on s.storm_id = y.storm_id and s.exact_time >= y.timestamp_utc"
    ),
    "gate_hits": (
        f"select {_KEY}, gate_id, x1 as nx, greatest(y1, least(y2, exact_lat)) as ny, 0 as far from timed t join gates g on before_lon is not null"
        " and least(before_lon, exact_lon) <= x2 and x1 <= greatest(before_lon, exact_lon) and least(before_lat, exact_lat) <= y2 and y1 <= greatest(before_lat, exact_lat)"
        f" and {_turn(_A, _B, _C)} * {_turn(_A, _B, _D)} <= 0 and {_turn(_C, _D, _A)} * {_turn(_C, _D, _B)} <= 0"
        f" union all select {_KEY}, gate_id, x1, greatest(y1, least(y2, exact_lat)), 1 from timed cross join gates"
    ),
    "gated": (
        f"select {', '.join('t.' + k for k in _KEY.split(', '))}, gate_id, far, {arc('exact_lon', 'exact_lat', 'nx', 'ny')} as gate_distance_km from gate_hits h join timed t using (storm_id, seg, j, native_only)"
        f" qualify row_number() over (partition by {', '.join('t.' + k for k in _KEY.split(', '))}"
        " order by far, case when far = 0 then round(pow(nx - exact_lon, 2) + pow(ny - exact_lat, 2), 12) else round(sqrt(pow(nx - exact_lon, 2) + pow(ny - exact_lat, 2)), 12) end, gate_id) = 1"
    ),
    "landfalls": (
        f"select t.*, {category('exact_wind_kt')} as exact_ss_category, {category('sixhr_wind_kt')} as sixhr_ss_category, {event_class('status_at_landfall', 'exact_wind_kt')} as event_class,"
        " case when not is_landfall then 'overland_reentry' when landfall_seq = 1 then 'first_landfall' else 'subsequent_landfall' end as landfall_type,"
        " (epoch_us(exact_time) - epoch_us(sixhr_time)) / 3.6e9 as hours_from_6hr_to_landfall, coalesce(landfall_iso = 'US', false) as is_us_landfall,"
        f" coalesce(status_at_landfall in ({TROPICAL}), false) as is_tropical_at_landfall,"
        f" season >= 1991 or season <= 1970 and (season >= 1951 or landfall_iso = 'US' and landfall_admin1 in ({QUOTED}) and season >= 1851) as native_flagging_complete,"
        " d.gate_id, g.region as gate_region, far = 0 as gate_is_crossing, gate_distance_km"
        " from timed t join seasons s using (storm_id) left join gated d using (storm_id, seg, j, native_only) left join gates g on g.gate_id = d.gate_id"
    ),
    "shore": (
        "select storm_id, point_seq, nx, ny from (select storm_id, point_seq, longitude, latitude, greatest(x1, least(x2, longitude)) as nx, greatest(y1, least(y2, latitude)) as ny from fixes cross join coast)"
        " qualify row_number() over (partition by storm_id, point_seq order by round(sqrt(pow(nx - longitude, 2) + pow(ny - latitude, 2)), 12), nx, ny) = 1"
    ),
    "track_points": (
        f"select f.*, {arc('longitude', 'latitude', 'nx', 'ny')} as min_distance_to_coast_km, nx as nearest_coast_lon, ny as nearest_coast_lat, {category('max_wind_kt')} as ss_category,"
        f" {event_class('status', 'max_wind_kt')} as event_class, coalesce(record_identifier = 'L', false) as is_native_landfall_record,"
        f" {HELD.format(x='longitude', y='latitude')} is not null as is_over_land"
        " from fixes f join shore using (storm_id, point_seq)"
    ),
    "storms": (
        "select p.storm_id, season, name, basin, min(timestamp_utc) as start_time_utc, max(timestamp_utc) as end_time_utc, max(max_wind_kt) as peak_wind_kt,"
        " min(min_pressure_mb) as min_pressure_mb, min(min_distance_to_coast_km) as min_distance_to_coast_km, count(*) as n_track_points,"
        f" arg_min(event_class, {RANK.format(c='event_class')}) as event_class, {category('max(max_wind_kt)')} as peak_ss_category,"
        " any_value(coalesce(h.n, 0)) as n_landfalls, any_value(coalesce(h.us, 0)) as n_us_landfalls, any_value(coalesce(h.n, 0)) > 0 as made_landfall"
        " from track_points p join seasons using (storm_id)"
        " left join (select storm_id, count(*) as n, count(*) filter (is_us_landfall) as us from landfalls where is_landfall group by 1) h using (storm_id) group by 1, 2, 3, 4"
    ),
    "bypasses": (
        "select storm_id, timestamp_utc as bypass_time_utc, latitude as bypass_lat, longitude as bypass_lon, min_distance_to_coast_km as bypass_distance_to_coast_km,"
        " nearest_coast_lon, nearest_coast_lat, max_wind_kt as bypass_wind_kt, min_pressure_mb as bypass_pressure_mb, ss_category as bypass_ss_category, status as bypass_status, is_over_land"
        " from track_points where storm_id not in (select storm_id from landfalls where is_landfall)"
        " qualify row_number() over (partition by storm_id order by min_distance_to_coast_km, point_seq) = 1"
    ),
    "near_misses": f"select *, {event_class('bypass_status', 'bypass_wind_kt')} as event_class from bypasses where bypass_distance_to_coast_km <= {RADIUS_KM}",
    "falls": "select l.*, s.season, s.name, s.basin from landfalls l join storms s using (storm_id)",
    "conus": f"select * from falls where is_landfall and is_us_landfall and landfall_admin1 in ({QUOTED})",
    "years": "select unnest(range(min(season), max(season) + 1)) as season from conus",
    "classes": "select unnest([" + ", ".join(f"'{c}'" for c in domain.CLASSES) + "]) as event_class, unnest(range(5)) as rank",
    "grid": "select season, event_class, rank from years cross join classes",
    "yearly": "select g.season, g.event_class, g.rank, count(c.storm_id) as n, count(c.storm_id) filter (detection_method <> 'inferred') as flagged from grid g left join conus c using (season, event_class) group by all",
    "flagged": "select *, detection_method = 'native' as missed from falls where detection_method in ('native', 'native_confirmed')",
    "offshore": "select * from flagged where missed and not is_attribution_exact",
    "peak": "select * from conus qualify row_number() over (partition by storm_id order by exact_wind_kt desc nulls last, exact_time, native_only, seg, j) = 1",
    "listed": "select season as year, name, storm_id % 7 = 0 as missed, storm_id % 13 = 0 as in_mexico from seasons where storm_id % 3 <> 0",
    "timing": "select *, exact_wind_kt - sixhr_wind_kt as delta_kt from conus where exact_wind_kt is not null and sixhr_wind_kt is not null",
}
#: Those that others read several times.
_HELD = {"fixes", "seasons", "box", "coast", "segs", "placed", "crossings", "claims", "found", "attributed", "sequenced", "timed", "landfalls", "track_points", "storms", "falls", "conus", "yearly"}
_PARTS = {name: set(re.findall(r"[a-z_]+", text)) for name, text in TABLES.items()}


def over_tables(select: str) -> str:
    """``select`` with the table expressions that it needs."""
    wanted, open_ = set(), [w for w in re.findall(r"[a-z_]+", select) if w in TABLES]
    while open_:
        name = open_.pop()
        if name not in wanted:
            wanted.add(name)
            open_ += [w for w in _PARTS[name] if w in TABLES and w != name]
    made = [f"{n} as {'materialized ' if n in _HELD else ''}({TABLES[n]})" for n in TABLES if n in wanted]
    return f"with {', '.join(made)} {select}"
