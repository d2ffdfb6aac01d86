"""Land, gates and built tables from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RINGS = "array<array<array<array<double>>>>"


def read_geojson(spark: SparkSession, path: str, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(units, edges) of a feature collection; ``names`` maps our columns to its properties.

    Features are numbered in file order. Polygons and multipolygons become edges
    ring by ring; rings are closed where they aren't.
    """
    schema = "features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.posexplode("features").alias("unit_id", "feature"))
    units = rows.select("unit_id", *[F.element_at("feature.properties", F.lit(v)).alias(k) for k, v in names.items()])
    text = F.when(F.col("feature.geometry.type") == "Polygon", F.concat(F.lit("["), F.col("feature.geometry.coordinates"), F.lit("]"))).otherwise(F.col("feature.geometry.coordinates"))
    rings = rows.where(F.col("feature.geometry.type").isin("Polygon", "MultiPolygon")).select("unit_id", F.explode(F.flatten(F.from_json(text, RINGS))).alias("ring"))
    closed = F.when(F.element_at("ring", 1) == F.element_at("ring", -1), F.col("ring")).otherwise(F.concat("ring", F.slice("ring", 1, 1)))
    rings = rings.select("unit_id", closed.alias("ring")).where("size(ring) >= 4")
    turn = F.transform(F.sequence(F.lit(1), F.size("ring") - 1), lambda i: F.struct(F.element_at("ring", i).alias("a"), F.element_at("ring", i + 1).alias("b")))
    edges = rings.select("unit_id", F.explode(turn).alias("e")).select("unit_id", F.col("e.a")[0].alias("x1"), F.col("e.a")[1].alias("y1"), F.col("e.b")[0].alias("x2"), F.col("e.b")[1].alias("y2"))
    return units, edges.where("x1 != x2 or y1 != y2")


def read_land(spark: SparkSession, path: str, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(units, edges) of a file by its name: ``.shp`` or GeoJSON. Edges are mended: see :func:`galetrack.operators.rings.repair`."""
    from galetrack.operators import rings
    from galetrack.sources import shapefile

    units, edges = shapefile.read_land(spark, path, names) if path.endswith(".shp") else read_geojson(spark, path, names)
    good, _ = rings.repair(edges)
    return units, good.select("unit_id", "x1", "y1", "x2", "y2")


GATE_SCHEMA = "gate_id string, gate_name string, region string, lon1 double, lat1 double, lon2 double, lat2 double"


def read_gates_csv(spark: SparkSession, path: str) -> DataFrame:
    """Gates with endpoint columns; sort_order follows the file."""
    head = spark.read.text(path).first()
    missing = {"gate_id", "lon1", "lat1", "lon2", "lat2"} - {c.strip() for c in (head["value"] if head else "").split(",")}
    if missing:
        raise ValueError(f"gate file without columns {sorted(missing)}")
    whole = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.rtrim("value"), "\r?\n")).alias("n", "line")).where("n > 0 and trim(line) != ''")
    names = [c.strip() for c in head["value"].split(",")]
    types = dict(p.split() for p in GATE_SCHEMA.split(", "))
    parsed = whole.select("n", F.from_csv("line", F.lit(", ".join(f"{c} {types.get(c, 'string')}" for c in names))).alias("g"))
    get = lambda c: F.col(f"g.{c}") if c in names else F.lit(None).cast("string")
    return parsed.select(get("gate_id").cast("string").alias("gate_id"), get("gate_name").alias("gate_name"), get("region").alias("region"), (F.col("n") - 1).cast("int").alias("sort_order"), *[F.col(f"g.{c}").alias(o) for c, o in (("lon1", "x1"), ("lat1", "y1"), ("lon2", "x2"), ("lat2", "y2"))])


def validate_gates(gates: DataFrame) -> None:
    """Raises for an empty set, null or repeated ids, or lines without two ends."""
    r = gates.agg(F.count("*").alias("n"), F.count_if(F.col("gate_id").isNull()).alias("none"), F.count_distinct("gate_id").alias("kinds"), F.count_if(F.col("x1").isNull() | F.col("y1").isNull() | F.col("x2").isNull() | F.col("y2").isNull()).alias("open")).first()
    for broken, what in ((r["n"] == 0, "no gates"), (r["none"], "gates without id"), (r["kinds"] < r["n"] - r["none"], "repeated gate ids"), (r["open"], "gates without two ends")):
        if broken:
            raise ValueError(what)


def read_built(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table that :func:`galetrack.sources.sinks.write_tables` wrote."""
    return spark.read.parquet(f"{path}/{name}")
