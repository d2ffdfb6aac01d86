"""Best-track text archives as DataFrames: points, storms, issues and provenance.

A file is read whole (archives are some MB), so lines keep their numbers; files
spread over the cluster. Every rule is a column expression; a broken rule is a row
of ``issues``, and :func:`read` raises for the first one unless told otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galetrack.functions import domain

#: Numbers of fields of a header, a legacy line and a line with the radius of maximum wind.
HEADER_FIELDS, LEGACY_FIELDS, FULL_FIELDS = 3, 20, 21
RADII = [f"r{kt}_{q}_nm" for kt in (34, 50, 64) for q in ("ne", "se", "sw", "nw")]


class BestTrackError(ValueError):
    """A line that breaks a rule: path, line number, rule and text."""


@dataclass
class BestTrack:
    points: DataFrame
    storms: DataFrame
    issues: DataFrame
    provenance: DataFrame


def _fields(line: Column) -> Column:
    """Comma-separated, trimmed, without one empty field at the end."""
    parts = F.transform(F.split(line, ","), lambda t: F.trim(t))
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def _degrees(token: Column, positive: str, negative: str) -> Column:
    pattern = rf"^(\d+(?:\.\d+)?)([{positive}{negative}])$"
    size = F.regexp_extract(token, pattern, 1).try_cast("double")
    return F.when(F.regexp_extract(token, pattern, 2) == negative, -size).otherwise(size)


def parse(files: DataFrame) -> BestTrack:
    """From rows of path and content (binary), as Spark's binary source gives them."""
    text = F.decode("content", "UTF-8")
    provenance = files.select("path", F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("n_bytes"))
    lines = files.select("path", F.posexplode(F.split(text, "\r?\n")).alias("at", "line")).select("path", (F.col("at") + 1).alias("line_no"), "line")
    lines = lines.where((F.trim("line") != "") & ~F.startswith(F.ltrim("line"), F.lit("<"))).withColumn("f", _fields(F.col("line")))
    is_header = F.col("line").rlike(r"^\s*[A-Za-z]{2}\d{6}\s*,")
    along = Window.partitionBy("path").orderBy("line_no")
    lines = lines.withColumn("is_header", is_header).withColumn("header_no", F.last(F.when(F.col("is_header"), F.col("line_no")), ignorenulls=True).over(along))
    heads = lines.where("is_header")
    heads = heads.select(
        "path", "line_no", "line", F.size("f").alias("n_fields"), F.get("f", F.lit(0)).alias("storm_id"), F.get("f", F.lit(1)).alias("name"), F.get("f", F.lit(2)).try_cast("int").alias("declared"),
    ).withColumns({"basin": F.upper(F.substring("storm_id", 1, 2)), "number": F.substring("storm_id", 3, 2).try_cast("int"), "season": F.substring("storm_id", 5, 4).try_cast("int")})
    data = lines.where("not is_header").withColumn("__n", F.row_number().over(Window.partitionBy("path", "header_no").orderBy("line_no")))
    at = lambda i: F.get("f", F.lit(i))
    when = F.try_to_timestamp(F.concat(at(0), at(1)), F.lit("yyyyMMddHHmm"))
    made = data.select(
        "path", "line_no", "line", "header_no", (F.col("__n") - 1).cast("int").alias("point_seq"), F.size("f").alias("n_fields"),
        F.when(at(0).rlike(r"^\d{8}$") & at(1).rlike(r"^\d{4}$"), when).alias("timestamp_utc"), F.nullif(at(2), F.lit("")).alias("record_identifier"), at(3).alias("status"),
        _degrees(at(4), "N", "S").alias("latitude"), domain.wrapped_longitude(_degrees(at(5), "E", "W")).alias("longitude"),
        domain.measured(at(6)).alias("max_wind_kt"), domain.measured(at(7)).alias("min_pressure_mb"),
        *[domain.measured(at(8 + i)).alias(c) for i, c in enumerate(RADII)], domain.measured(at(20)).alias("radius_max_wind_nm"),
        F.exists(F.slice("f", 7, 15), lambda t: (t != "") & t.try_cast("int").isNull()).alias("bad_number"),
    )
    points = made.join(heads.select("path", F.col("line_no").alias("header_no"), "storm_id", "basin", "season"), ["path", "header_no"], "left").withColumn("is_synoptic", domain.is_synoptic(F.col("timestamp_utc")))

    def issue(rows: DataFrame, rule: str, broken: Column) -> DataFrame:
        return rows.where(F.coalesce(broken, F.lit(False))).select("path", "line_no", F.lit(rule).alias("rule"), F.col("line").alias("text"))

    counts = made.groupBy("path", F.col("header_no").alias("line_no")).agg(F.count("*").alias("n"))
    counted = heads.join(counts, ["path", "line_no"], "left")
    again = Window.partitionBy("storm_id").orderBy("path", "line_no")
    back = F.col("timestamp_utc") < F.lag("timestamp_utc").over(Window.partitionBy("path", "header_no").orderBy("line_no"))
    issues = issue(heads, "header_fields", F.col("n_fields") != HEADER_FIELDS)
    for found in (
        issue(heads, "basin", ~F.col("basin").isin(*domain.BASINS)),
        issue(counted, "row_count", F.col("declared").isNull() | (F.col("declared") <= 0) | (F.col("declared") != F.coalesce("n", F.lit(0)))),
        issue(heads.withColumn("r", F.row_number().over(again)), "duplicate_id", F.col("r") > 1),
        issue(made, "orphan", F.col("header_no").isNull()),
        issue(made, "field_count", ~F.col("n_fields").isin(LEGACY_FIELDS, FULL_FIELDS)),
        issue(made, "time", F.col("timestamp_utc").isNull()),
        issue(made, "record_identifier", ~F.col("record_identifier").isin(*domain.RECORD_IDENTIFIERS)),
        issue(made, "status", ~F.coalesce(F.col("status").isin(*domain.STATUSES), F.lit(False))),
        issue(made, "latitude", F.coalesce(~F.col("latitude").between(-90, 90), F.lit(True))),
        issue(made, "longitude", F.coalesce(~F.col("longitude").between(-180, 180), F.lit(True))),
        issue(made, "number", F.col("bad_number")),
        issue(made.withColumn("back", back), "time_order", F.col("back")),
    ):
        issues = issues.unionByName(found)
    storms = heads.select("storm_id", "name", "basin", "number", "season", F.col("declared").alias("n_declared"), F.col("path").alias("source_path"), F.col("line_no").alias("source_line_no"))
    kept = ["storm_id", "basin", "season", "point_seq", "timestamp_utc", "record_identifier", "status", "latitude", "longitude", "max_wind_kt", "min_pressure_mb", *RADII, "radius_max_wind_nm", "is_synoptic"]
    return BestTrack(points.select(*kept, F.col("line_no").alias("source_line_no")), storms, issues, provenance)


def read(spark: SparkSession, paths: str | list[str], strict: bool = True) -> BestTrack:
    """All files of ``paths`` as one set. ``strict`` raises for the first broken rule.

    Times that run backwards are a warning: they stay in ``issues`` and never raise.
    """
    found = parse(spark.read.format("binaryFile").load(paths).select("path", "content"))
    if strict and (bad := found.issues.where("rule != 'time_order'").orderBy("path", "line_no", "rule").first()):
        raise BestTrackError(f"{bad['path']}:{bad['line_no']}: {bad['rule']}: {bad['text']}")
    return found
