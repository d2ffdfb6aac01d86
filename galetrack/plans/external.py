"""A built database against an external list of hurricanes (year, name, missed, in_mexico, wind_kt)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galetrack.functions import domain
from galetrack.plans import analytics
from galetrack.plans.storms import Database
from galetrack.plans.workload import countable
from galetrack.sources import hurricane_list

#: Units of the United States outside of the list's scope.
OUTSIDE = ("Alaska", "Hawaii", "Puerto Rico", "United States Virgin Islands")
ERAS = (("1851-1970", 1851, 1970), ("1971-1990", 1971, 1990), ("1991-present", 1991, 9999))


def events(db: Database, conus: tuple[str, ...] = domain.CONUS_UNITS) -> DataFrame:
    """One row for each storm that struck the scope at hurricane strength: its earliest such landfall."""
    strong = F.coalesce("exact_wind_kt", F.lit(0)) >= domain.HURRICANE_FLOOR
    w = Window.partitionBy("storm_id").orderBy("exact_time", "native_only", "seg", "j")
    return analytics.scope(db, conus).where(strong).withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def weak_events(db: Database, conus: tuple[str, ...] = domain.CONUS_UNITS) -> DataFrame:
    """season, name and the strongest wind below hurricane strength of landfalls in the scope."""
    weak = F.coalesce("exact_wind_kt", F.lit(0)) < domain.HURRICANE_FLOOR
    return analytics.scope(db, conus).where(weak).groupBy("season", F.upper(F.trim("name")).alias("name")).agg(F.max("exact_wind_kt").alias("weak_kt")).where("weak_kt is not null")


def outside_count(db: Database, outside: tuple[str, ...] = OUTSIDE) -> DataFrame:
    return countable(db).where(F.col("is_us_landfall") & F.col("landfall_admin1").isin(*outside)).agg(F.count("*").alias("n"))


def counted(listed: DataFrame) -> DataFrame:
    return listed.where("not missed and not in_mexico")


def by_year(db: Database, listed: DataFrame, conus: tuple[str, ...] = domain.CONUS_UNITS) -> DataFrame:
    """year with both counts and their difference, for all years that either has."""
    theirs = counted(listed).groupBy("year").agg(F.count("*").alias("listed"))
    ours = events(db, conus).groupBy(F.col("season").alias("year")).agg(F.count("*").alias("detected"))
    rows = theirs.join(ours, "year", "full").fillna(0, ["listed", "detected"])
    return rows.withColumn("diff", F.col("detected") - F.col("listed"))


def by_era(db: Database, listed: DataFrame, conus: tuple[str, ...] = domain.CONUS_UNITS) -> DataFrame:
    """The same by era of flagging, with whether the archive's flags are complete there."""
    rows = by_year(db, listed, conus)
    eras = rows.sparkSession.createDataFrame(list(ERAS), "era string, first int, last int")
    met = eras.join(rows, F.col("year").between(F.col("first"), F.col("last")), "left")
    sums = met.groupBy("era", "first").agg(F.coalesce(F.sum("listed"), F.lit(0)).alias("listed"), F.coalesce(F.sum("detected"), F.lit(0)).alias("detected"))
    return sums.select("era", domain.in_eras(F.col("first"), domain.CONUS_ERAS).cast("int").alias("flags_complete"), "listed", "detected", (F.col("detected") - F.col("listed")).alias("diff"))


def by_name(db: Database, listed: DataFrame, conus: tuple[str, ...] = domain.CONUS_UNITS, since: int = 1950) -> DataFrame:
    """season, name and verdict of every named storm that either has, from ``since`` on.

    matched; below_hurricane (listed, detected below that strength only); only_listed;
    annotated (detected, and the list marks it as missed or Mexican); only_detected.
    """
    name = F.upper(F.trim("name"))
    rows = listed.where("name is not null").select(F.col("year").alias("season"), name.alias("name"), "missed", "in_mexico")
    theirs = rows.groupBy("season", "name").agg(F.bool_or(~F.col("missed") & ~F.col("in_mexico")).alias("listed"), F.bool_or(F.col("missed") | F.col("in_mexico")).alias("marked"))
    ours = events(db, conus).where(F.col("season") >= since).select("season", name.alias("name")).where("name not in ('', 'UNNAMED')").distinct().withColumn("detected", F.lit(True))
    met = theirs.join(ours, ["season", "name"], "full").join(weak_events(db, conus), ["season", "name"], "left").fillna(False, ["listed", "marked", "detected"])
    verdict = (
        F.when(F.col("listed") & F.col("detected"), "matched").when(F.col("listed") & F.col("weak_kt").isNotNull(), "below_hurricane").when(F.col("listed"), "only_listed")
        .when(F.col("detected") & F.col("marked"), "annotated").when(F.col("detected"), "only_detected")
    )
    return met.select("season", "name", verdict.alias("verdict"), F.when(verdict == "below_hurricane", F.col("weak_kt")).alias("weak_kt")).where("verdict is not null")


#: The least share of the list's lines that must be read, and the greatest share of its named storms that may be missing.
LEAST_PARSED, MOST_MISSING = 0.95, 0.10


def passes(db: Database, rows: DataFrame, conus: tuple[str, ...] = domain.CONUS_UNITS) -> DataFrame:
    """One row: rate, named, missing and ``passed``.

    ``rows`` is the whole list. It passes if enough of it was read, if storms are named,
    and if few of those are missing. Storms detected below hurricane strength count
    neither way.
    """
    named = verdicts(db, rows.where("kind = 'landfall'"), conus)
    counts = named.agg(*[F.coalesce(F.sum(F.when(F.col("verdict").isin(*v), F.col("n"))), F.lit(0)).alias(c) for c, v in (("matched", ["matched"]), ("missing", ["only_listed"]))])
    both = hurricane_list.parse_rate(rows).select("rate").join(counts)  # one row each
    n = F.col("matched") + F.col("missing")
    return both.select("rate", n.alias("named"), "missing", ((F.col("rate") >= LEAST_PARSED) & (n > 0) & F.coalesce(F.col("missing") / n <= MOST_MISSING, F.lit(False))).alias("passed"))


def verdicts(db: Database, listed: DataFrame, conus: tuple[str, ...] = domain.CONUS_UNITS) -> DataFrame:
    return by_name(db, listed, conus).groupBy("verdict").agg(F.count("*").alias("n"))


def report(db: Database, listed: DataFrame, conus: tuple[str, ...] = domain.CONUS_UNITS, shown: int = 40) -> str:
    """The comparison as text: totals, eras, years that differ and names, each list cut at ``shown`` for reading."""
    analytics.guard(db, conus)
    years = by_year(db, listed, conus)
    total = years.agg(F.sum("listed").alias("a"), F.sum("detected").alias("b"), F.count_if(F.col("diff") == 0).alias("same"), F.count("*").alias("n")).first()
    out = ["# Comparison with the external list", "", f"Listed {total['a']}, detected {total['b']}; {total['same']} of {total['n']} years agree.", "", "| era | flags complete | listed | detected | diff |", "|---|---|---|---|---|"]
    out += [f"| {r['era']} | {'yes' if r['flags_complete'] else 'no'} | {r['listed']} | {r['detected']} | {r['diff']:+d} |" for r in by_era(db, listed, conus).orderBy("era").collect()]
    out += ["", "## Years that differ", ""] + [f"- {r['year']}: listed {r['listed']}, detected {r['detected']}" for r in years.where("diff != 0").orderBy("year").limit(shown).collect()]
    names = by_name(db, listed, conus)
    for verdict in ("below_hurricane", "only_listed", "annotated", "only_detected"):
        rows = names.where(F.col("verdict") == verdict).orderBy("season", "name").limit(shown).collect()
        out += ["", f"## {verdict.replace('_', ' ').capitalize()}", ""] + [f"- {r['season']} {r['name'].title()}" + (f", {r['weak_kt']} kt" if r["weak_kt"] else "") for r in rows]
    return "\n".join(out) + "\n"
