"""Registered queries over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galetrack.functions import domain, sql
from galetrack.functions.geodesy import haversine_km
from galetrack.operators import cover, geometry, landfall, summary
from galetrack.plans import land_queries, planar, planar_queries, storms

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Inputs and databases of this process, by application and the state of the files: built once, as written tables.
_INPUTS: dict[tuple, storms.Inputs] = {}
_BUILT: dict[tuple, storms.Database] = {}
_LANDS: dict[tuple, storms.Land] = {}


def state(spark: SparkSession, sf_dir: str) -> tuple:
    """The application, the folder, and a digest of paths, sizes and times of the files that inputs are made from.

    Missing files have no digest; it is the reading of the inputs that refuses them.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([f"{sf_dir}/{n}.parquet" for n in ("events", "nation", "region")])
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.sparkContext.applicationId, sf_dir, 0, None
    # Only the listing is read, not the files; the sums don't depend on an order.
    seen = files.select(F.xxhash64("path", "length", "modificationTime").cast("decimal(38, 0)").alias("h")).agg(F.count("*"), F.sum("h")).first()
    return spark.sparkContext.applicationId, sf_dir, *seen


def inputs(spark: SparkSession, sf_dir: str) -> storms.Inputs:
    key = state(spark, sf_dir)
    if key not in _INPUTS:
        _INPUTS[key] = storms.inputs(spark, sf_dir)
    return _INPUTS[key]


def land(spark: SparkSession, sf_dir: str) -> storms.Land:
    """The synthetic units, made ready once for both builds."""
    key = state(spark, sf_dir)
    if key not in _LANDS:
        i = inputs(spark, sf_dir)
        _LANDS[key] = storms.prepare(i.edges, i.units, i.gates)
    return _LANDS[key]


def database(spark: SparkSession, sf_dir: str, flat: bool = False) -> storms.Database:
    """The tables of the synthetic tracks, sampled every km: on geodesics, or in the plane of degrees."""
    key = (*state(spark, sf_dir), flat)
    if key not in _BUILT:
        i = inputs(spark, sf_dir)
        options = {"step_km": planar.STEP_KM, "planar": True, "conus": list(planar.CONUS), "radius_km": planar.RADIUS_KM} if flat else {"step_km": 1.0}
        _BUILT[key] = storms.build(i.points, i.seasons, i.edges, i.units, i.gates, land=land(spark, sf_dir), **options)
    return _BUILT[key]


_CTE = f"with fixes as ({storms.FIXES_SQL}), seasons as ({storms.SEASONS_SQL}), units as ({storms.UNITS_SQL})"
_CATEGORY, _CLASS = planar.category("max_wind_kt"), planar.event_class("status", "max_wind_kt")
_LAND = (
    f"box as ({planar.TABLES['box']}), sides as ({planar.TABLES['sides']}), coast as ({planar.TABLES['coast']}),"
    f" located as (select f.*, {planar.HELD.format(x='f.longitude', y='f.latitude')} as unit_id from fixes f)"
)


def query(name: str, sql: str | None = None):
    def put(make: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = make
        if sql:
            ORACLE[name] = sql
        return make

    return put


def _flag(c):
    return c.cast("int")


@query("track_points", f"{_CTE} select storm_id, point_seq, strftime(timestamp_utc, '%Y-%m-%d %H:%M:%S') as at, longitude, latitude, status, max_wind_kt, {_CATEGORY} as ss_category, {_CLASS} as event_class, cast(coalesce(max_wind_kt >= 96, false) as int) as is_major, cast(status in ('TD','TS','HU','SD','SS') as int) as is_tropical from fixes")
def track_points(spark, sf_dir):
    w = F.col("max_wind_kt")
    return inputs(spark, sf_dir).points.select(
        "storm_id", "point_seq", F.date_format("timestamp_utc", "yyyy-MM-dd HH:mm:ss").alias("at"), "longitude", "latitude", "status", "max_wind_kt",
        domain.ss_category(w).alias("ss_category"), domain.event_class(F.col("status"), w).alias("event_class"), _flag(domain.is_major(w)).alias("is_major"), _flag(domain.is_tropical(F.col("status"))).alias("is_tropical"),
    )


@query("track_segments", f"{_CTE}, s as (select storm_id, point_seq as seg, longitude as x1, latitude as y1, lead(longitude) over w as x2, lead(latitude) over w as y2, greatest(max_wind_kt, lead(max_wind_kt) over w) as wind from fixes window w as (partition by storm_id order by point_seq)) select storm_id, seg, round(2 * 6371.0088 * asin(sqrt(pow(sin(radians(y2 - y1) / 2), 2) + cos(radians(y1)) * cos(radians(y2)) * pow(sin(radians(x2 - x1) / 2), 2))), 6) as km, wind as strongest_kt from s where x2 is not null")
def track_segments(spark, sf_dir):
    s = landfall.segments(inputs(spark, sf_dir).points)
    km = haversine_km(F.col("a_longitude"), F.col("a_latitude"), F.col("b_longitude"), F.col("b_latitude"))
    return s.select("storm_id", "seg", F.round(km, 6).alias("km"), F.greatest("a_max_wind_kt", "b_max_wind_kt").alias("strongest_kt"))


@query("pip_over_land", f"{_CTE}, {_LAND} select storm_id, point_seq, unit_id from located where unit_id is not null")
def pip_over_land(spark, sf_dir):
    i = inputs(spark, sf_dir)
    return cover.with_unit(i.points, land(spark, sf_dir).index).where("unit_id is not null").select("storm_id", "point_seq", "unit_id")


@query("landfalls_by_unit_category", f"{_CTE}, {_LAND}, moved as (select *, lag(unit_id) over (partition by storm_id order by point_seq) as was from located) select admin1_name, {_CATEGORY} as ss_category, cast(count(*) as bigint) as n from moved m join units u on m.unit_id = u.unit_id where m.was is null and m.point_seq > 0 group by 1, 2")
def landfalls_by_unit_category(spark, sf_dir):
    i = inputs(spark, sf_dir)
    rows = cover.with_unit(i.points, land(spark, sf_dir).index)
    rows = rows.withColumn("was", F.lag("unit_id").over(Window.partitionBy("storm_id").orderBy("point_seq")))
    rows = rows.where("unit_id is not null and was is null and point_seq > 0").withColumn("ss_category", domain.ss_category(F.col("max_wind_kt")))
    return rows.join(i.units, "unit_id").groupBy("admin1_name", "ss_category").agg(F.count("*").alias("n"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landfalls_by_unit_category(spark, sf_dir)


@query("landmass_components", f"{_CTE}, b as (select unit_id, case when unit_id % 5 = 0 or unit_id % 2 = 0 or unit_id in (3, 17) then 1 else 0 end as starts from units), r as (select unit_id, sum(starts) over (order by unit_id) as run from b) select unit_id, min(unit_id) over (partition by run) as root from r")
def landmass_components(spark, sf_dir):
    return geometry.connected_units(inputs(spark, sf_dir).edges).select("unit_id", "root")


@query("boundary_edges", f"{_CTE}, e as (select unnest([[ix1, iy1, ix2, iy1], [ix1, iy2, ix2, iy2], [ix1, iy1, ix1, iy2], [ix2, iy1, ix2, iy2]]) as e from units) select e[1] as x1, e[2] as y1, e[3] as x2, e[4] as y2 from e group by e having count(*) % 2 = 1")
def boundary_edges(spark, sf_dir):
    whole = lambda c: F.round(F.col(c) * 10000).cast("long").alias(c)
    return geometry.boundary_edges(inputs(spark, sf_dir).edges).select(*[whole(c) for c in ("x1", "y1", "x2", "y2")])


_Q = "(1 - {e2}) * (sin(radians({y} / 10000.0)) / (1 - {e2} * pow(sin(radians({y} / 10000.0)), 2)) - 1 / (2 * sqrt({e2})) * ln((1 - sqrt({e2}) * sin(radians({y} / 10000.0))) / (1 + sqrt({e2}) * sin(radians({y} / 10000.0)))))"
_E2 = "0.0066943799901413165"


@query("polygon_area", f"{_CTE} select unit_id, round(6378.137 * 6378.137 * radians((ix2 - ix1) / 10000.0) * ({_Q.format(e2=_E2, y='iy2')} - {_Q.format(e2=_E2, y='iy1')}) / 2, 3) as area_km2 from units")
def polygon_area(spark, sf_dir):
    return geometry.unit_areas(inputs(spark, sf_dir).edges).select("unit_id", F.round("area_km2", 3).alias("area_km2"))


@query("storm_sums", f"{_CTE} select storm_id, strftime(min(timestamp_utc), '%Y-%m-%d %H:%M:%S') as start_at, strftime(max(timestamp_utc), '%Y-%m-%d %H:%M:%S') as end_at, max(max_wind_kt) as peak_wind_kt, min(min_pressure_mb) as min_pressure_mb, count(*) as n from fixes group by storm_id")
def storm_sums(spark, sf_dir):
    fmt = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    rows = summary.extremes(inputs(spark, sf_dir).points)
    return rows.select("storm_id", fmt("start_time_utc").alias("start_at"), fmt("end_time_utc").alias("end_at"), "peak_wind_kt", "min_pressure_mb", F.col("n_track_points").alias("n"))


_RANK = "case " + " ".join(f"when c = '{c}' then {i}" for i, c in enumerate(domain.CLASSES)) + " end"


@query("lifetime_class", f"{_CTE}, k as (select storm_id, {_CLASS} as c from fixes), r as (select storm_id, c, {_RANK} as rank from k) select storm_id, arg_min(c, rank) as lifetime_class from r group by storm_id")
def lifetime_class(spark, sf_dir):
    return summary.lifetime_class(inputs(spark, sf_dir).points).select("storm_id", "lifetime_class")


@query(
    "asof_synoptic",
    f"{_CTE}, ev as (select storm_id, point_seq, timestamp_utc from fixes where record_identifier = 'L'),"
    " syn as (select * from fixes where is_synoptic qualify row_number() over (partition by storm_id, timestamp_utc order by point_seq) = 1)"
    " select e.storm_id, e.point_seq, strftime(s.timestamp_utc, '%Y-%m-%d %H:%M:%S') as sixhr_at, s.max_wind_kt as sixhr_wind_kt, s.longitude as sixhr_lon"
    " from ev e asof left join syn s on e.storm_id = s.storm_id and e.timestamp_utc >= s.timestamp_utc",
)
def asof_synoptic(spark, sf_dir):
    points = inputs(spark, sf_dir).points
    flags = points.where("record_identifier = 'L'").select("storm_id", F.col("point_seq").alias("seg"), F.lit(0).alias("j"), F.lit(1).alias("native_only"), F.col("timestamp_utc").alias("exact_time"))
    met = landfall.preceding_synoptic(flags, points)
    return met.select("storm_id", F.col("seg").alias("point_seq"), F.date_format("sixhr_time", "yyyy-MM-dd HH:mm:ss").alias("sixhr_at"), "sixhr_wind_kt", "sixhr_lon")


@query(
    "nonmonotonic_time",
    "with e as (select user_id as storm_id, event_id % 97 * 100000000 + event_id as place, cast(ts as timestamp) as t from events), w as (select *, lag(t) over (partition by storm_id order by place) as before from e) select storm_id, place from w where t < before",
)
def nonmonotonic_time(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("storm_id"), (F.col("event_id") % 97 * 100_000_000 + F.col("event_id")).alias("place"), F.col("ts").cast("timestamp").alias("timestamp_utc"))
    return summary.time_breaks(rows, "place")


_SEASONAL = f"f as (select season, {_CLASS} as c, max_wind_kt, min_pressure_mb, status from fixes join seasons using (storm_id))"


def seasonal(spark, sf_dir):
    i = inputs(spark, sf_dir)
    return i.points.join(i.seasons, "storm_id").withColumn("c", domain.event_class(F.col("status"), F.col("max_wind_kt")))


@query("season_class_matrix", f"{_CTE}, {_SEASONAL}, y as (select unnest(range(min(season), max(season) + 1)) as season from f), g as (select * from y cross join (select distinct c from f)), n as (select season, c, count(*) as n from f group by 1, 2) select cast(g.season as int) as season, g.c as class, coalesce(n, 0) as n from g left join n using (season, c)")
def season_class_matrix(spark, sf_dir):
    rows = seasonal(spark, sf_dir)
    span = rows.agg(F.min("season").alias("a"), F.max("season").alias("b")).select(F.explode(F.sequence("a", "b")).alias("season"))
    grid = span.withColumn("c", F.explode(F.array(*[F.lit(c) for c in domain.CLASSES]))).join(F.broadcast(rows.select("c").distinct()), "c", "left_semi")
    counts = rows.groupBy("season", "c").agg(F.count("*").alias("n"))
    return grid.join(counts, ["season", "c"], "left").select("season", F.col("c").alias("class"), F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "sql_functions",
    f"{_CTE}, s as (select storm_id, point_seq, status, max_wind_kt, longitude as x1, latitude as y1, lead(longitude) over w as x2, lead(latitude) over w as y2 from fixes window w as (partition by storm_id order by point_seq))"
    f" select storm_id, point_seq, {_CATEGORY} as category, {_CLASS} as class, round({planar.arc('x1', 'y1', 'x2', 'y2')}, 6) as km from s",
)
def sql_functions(spark, sf_dir):
    """The registered functions, called from SQL text."""
    sql.register(spark)
    return spark.sql(
        "select storm_id, point_seq, gale_category(max_wind_kt) as category, gale_class(status, max_wind_kt) as class, round(gale_arc_km(longitude, latitude, lead(longitude) over w, lead(latitude) over w), 6) as km"
        " from {fixes} window w as (partition by storm_id order by point_seq)",
        fixes=inputs(spark, sf_dir).points,
    )


@query(
    "sql_positions",
    f"{_CTE}, s as (select storm_id, point_seq, longitude as x1, latitude as y1, lead(longitude) over w as x2, lead(latitude) over w as y2 from fixes window w as (partition by storm_id order by point_seq)),"
    f" n as (select *, greatest(1, cast(ceil({planar.arc('x1', 'y1', 'x2', 'y2')} / 50.0) as int)) as n from s where x2 is not null), j as (select *, unnest(range(n + 1)) as j from n)"
    " select storm_id, point_seq, cast(j as int) as j, round(x1 + (x2 - x1) * (j / n), 6) as lon, round(y1 + (y2 - y1) * (j / n), 6) as lat from j",
)
def sql_positions(spark, sf_dir):
    """Positions every 50 km, by the table function from SQL text."""
    sql.register(spark)
    return spark.sql(
        "select storm_id, point_seq, p.j, round(p.lon, 6) as lon, round(p.lat, 6) as lat from (select storm_id, seg as point_seq, a_longitude as x1, a_latitude as y1, b_longitude as x2, b_latitude as y2 from {segs}) s,"
        " lateral gale_along(s.x1, s.y1, s.x2, s.y2, 50.0D) p",
        segs=landfall.segments(inputs(spark, sf_dir).points),
    )


@query("season_rolling_mean", f"{_CTE}, {_SEASONAL}, n as (select season, count(*) as n from f group by 1) select season, case when count(*) over w >= 6 then round(avg(n) over w, 6) end as smoothed from n window w as (order by season rows between 5 preceding and 4 following)")
def season_rolling_mean(spark, sf_dir):
    counts = seasonal(spark, sf_dir).groupBy("season").agg(F.count("*").alias("n"))
    w = Window.partitionBy(F.lit(0)).orderBy("season").rowsBetween(-5, 4)
    return counts.select("season", F.when(F.count("*").over(w) >= 6, F.round(F.avg("n").over(w), 6)).alias("smoothed"))


@query("field_availability", f"{_CTE}, {_SEASONAL} select season, c as class, round(avg(cast(max_wind_kt is not null as double)), 6) as wind, round(avg(cast(min_pressure_mb is not null as double)), 6) as pressure from f group by 1, 2")
def field_availability(spark, sf_dir):
    share = lambda c: F.round(F.avg(F.col(c).isNotNull().cast("double")), 6)
    return seasonal(spark, sf_dir).groupBy("season", F.col("c").alias("class")).agg(share("max_wind_kt").alias("wind"), share("min_pressure_mb").alias("pressure"))


@query("category_class_crosstab", f"{_CTE} select {_CATEGORY} as ss_category, " + ", ".join(f"count(*) filter ({_CLASS} = '{c}') as \"{c}\"" for c in domain.CLASSES) + " from fixes group by 1")
def category_class_crosstab(spark, sf_dir):
    rows = inputs(spark, sf_dir).points.withColumns({"ss_category": domain.ss_category(F.col("max_wind_kt")), "c": domain.event_class(F.col("status"), F.col("max_wind_kt"))})
    return rows.groupBy("ss_category").pivot("c", list(domain.CLASSES)).count().fillna(0)


@query("wind_pressure", f"{_CTE}, {_SEASONAL} select c as class, round(corr(max_wind_kt, min_pressure_mb), 6) as r, median(max_wind_kt) as wind, median(min_pressure_mb) as pressure from f where max_wind_kt is not null and min_pressure_mb is not null group by 1")
def wind_pressure(spark, sf_dir):
    rows = seasonal(spark, sf_dir).where("max_wind_kt is not null and min_pressure_mb is not null")
    return rows.groupBy(F.col("c").alias("class")).agg(F.round(F.corr("max_wind_kt", "min_pressure_mb"), 6).alias("r"), F.median("max_wind_kt").alias("wind"), F.median("min_pressure_mb").alias("pressure"))


@query("decade_counts", f"{_CTE}, {_SEASONAL} select season // 10 * 10 as decade, count(*) as n, quantile_cont(max_wind_kt, 0.95) as p95, cast(count(distinct season) as bigint) as seasons from f group by 1")
def decade_counts(spark, sf_dir):
    return seasonal(spark, sf_dir).groupBy(domain.decade(F.col("season")).alias("decade")).agg(F.count("*").alias("n"), F.percentile("max_wind_kt", 0.95).alias("p95"), F.count_distinct("season").alias("seasons"))


@query("era_summary", f"{_CTE}, {_SEASONAL} select case when season <= 1970 then '1851-1970' when season <= 1990 then '1971-1990' else '1991 onward' end as era, count(*) as n, round(100.0 * count(*) filter (max_wind_kt >= 64) / count(*), 4) as hurricane_pct, cast(max(case when season between 1851 and 1970 or season >= 1991 then 1 else 0 end) as int) as conus_complete from f group by 1")
def era_summary(spark, sf_dir):
    rows = seasonal(spark, sf_dir)
    return rows.groupBy(domain.flag_era(F.col("season")).alias("era")).agg(
        F.count("*").alias("n"), F.round(100.0 * F.count_if(F.col("max_wind_kt") >= 64) / F.count("*"), 4).alias("hurricane_pct"),
        F.max(domain.flagging_complete(F.col("season"), F.lit(True)).cast("int")).alias("conus_complete"),
    )


@query("strongest_fix", f"{_CTE} select storm_id, point_seq, max_wind_kt from fixes qualify row_number() over (partition by storm_id order by max_wind_kt desc nulls last, timestamp_utc, point_seq) = 1")
def strongest_fix(spark, sf_dir):
    w = Window.partitionBy("storm_id").orderBy(F.desc_nulls_last("max_wind_kt"), "timestamp_utc", "point_seq")
    return inputs(spark, sf_dir).points.withColumn("r", F.row_number().over(w)).where("r = 1").select("storm_id", "point_seq", "max_wind_kt")


# The tables of the geodesic build, whose sampling SQL engines spell out differently in
# the last digits, have no SQL; the planar build's have.


def _planar(make):
    return lambda spark, sf_dir: make(database(spark, sf_dir, flat=True))


for _name, (_make, _sql) in land_queries.QUERIES.items():
    QUERIES[_name] = lambda spark, sf_dir, make=_make: make(inputs(spark, sf_dir), land(spark, sf_dir).index)
    ORACLE[_name] = _sql
for _name, (_make, _sql) in planar_queries.QUERIES.items():
    QUERIES[_name], ORACLE[_name] = _planar(_make), _sql
for _table in storms.TABLES:
    QUERIES[f"table_{_table}"] = lambda spark, sf_dir, t=_table: getattr(database(spark, sf_dir), t)
