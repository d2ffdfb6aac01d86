"""Built tables to Parquet, SQLite, DDL text and GeoJSON."""

from __future__ import annotations

import sqlite3

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galetrack.functions.domain import point_wkt

SQL_TYPES = {T.StringType: "TEXT", T.DoubleType: "REAL", T.FloatType: "REAL", T.IntegerType: "INTEGER", T.LongType: "INTEGER", T.BooleanType: "INTEGER", T.TimestampType: "TEXT"}
WAREHOUSE_TYPES = SQL_TYPES | {T.StringType: "VARCHAR", T.DoubleType: "DOUBLE", T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.BooleanType: "BOOLEAN", T.TimestampType: "TIMESTAMP_NTZ"}


def with_point(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """``df`` with its position as WKT; null where a coordinate is."""
    return df.withColumn("geometry", point_wkt(F.col(lon), F.col(lat)))


def write_tables(tables: dict[str, DataFrame], path: str, partition_by: dict[str, list[str]] | None = None) -> None:
    """A Parquet folder for each table, empty ones too, with their schema."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if keys := (partition_by or {}).get(name):
            writer = writer.partitionBy(*keys)
        writer.parquet(f"{path}/{name}")


def flat(df: DataFrame) -> DataFrame:
    """For plain SQL: times as ISO text, booleans as 0 and 1, NaN as null."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def write_sqlite(tables: dict[str, DataFrame], path: str, keys: dict[str, list[str]] | None = None, indexes: dict[str, list[str]] | None = None) -> None:
    """One SQLite file; rows stream through the driver, a batch at a time."""
    with sqlite3.connect(path) as db:
        for name, df in tables.items():
            columns = [f'"{f.name}" {SQL_TYPES.get(type(f.dataType), "TEXT")}' for f in df.schema.fields]
            if key := (keys or {}).get(name):
                columns.append(f"PRIMARY KEY ({', '.join(key)})")
            db.execute(f'DROP TABLE IF EXISTS "{name}"')
            db.execute(f'CREATE TABLE "{name}" ({", ".join(columns)})')
            marks = ", ".join("?" * len(df.columns))
            db.executemany(f'INSERT INTO "{name}" VALUES ({marks})', (tuple(r) for r in flat(df).toLocalIterator()))
            for c in (indexes or {}).get(name, []):
                db.execute(f'CREATE INDEX "ix_{name}_{c}" ON "{name}" ("{c}")')


def ddl(tables: dict[str, DataFrame], cluster: dict[str, list[str]] | None = None) -> str:
    """CREATE TABLE statements for a warehouse, from the tables' schemas."""
    out = []
    for name, df in tables.items():
        columns = ",\n".join(f"  {f.name.upper()} {WAREHOUSE_TYPES.get(type(f.dataType), 'VARCHAR')}" for f in df.schema.fields)
        by = f"\nCLUSTER BY ({', '.join(c.upper() for c in cluster[name])})" if cluster and name in cluster else ""
        out.append(f"CREATE TABLE IF NOT EXISTS {name.upper()} (\n{columns}\n){by};")
    return "\n\n".join(out) + "\n"


def copy_text(tables: dict[str, DataFrame], stage: str) -> str:
    """COPY statements that load each table's Parquet folder from a warehouse's stage."""
    return "\n\n".join(f"COPY INTO {n.upper()}\nFROM @{stage}/{n}/\nFILE_FORMAT = (TYPE = PARQUET)\nMATCH_BY_COLUMN_NAME = CASE_INSENSITIVE;" for n in tables) + "\n"


def view_text(points: dict[str, tuple[str, str]], lines: dict[str, str]) -> str:
    """CREATE VIEW statements with a geography column: of positions (table to longitude and latitude), and of well-known text (table to column)."""
    shape = {n: f"ST_MAKEPOINT({x.upper()}, {y.upper()})" for n, (x, y) in points.items()} | {n: f"TO_GEOGRAPHY({c.upper()})" for n, c in lines.items()}
    return "\n\n".join(f"CREATE OR REPLACE VIEW V_{n.upper()} AS\nSELECT *, {s} AS GEOGRAPHY\nFROM {n.upper()};" for n, s in shape.items()) + "\n"


def gates_geojson(gates: DataFrame) -> DataFrame:
    """One row of text: the gates as a feature collection, by sort_order."""
    line = F.struct(F.lit("LineString").alias("type"), F.array(F.array("x1", "y1"), F.array("x2", "y2")).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct("gate_id", "gate_name", "region").alias("properties"), line.alias("geometry"))
    rows = gates.agg(F.array_sort(F.collect_list(F.struct("sort_order", "gate_id", feature.alias("feature")))).alias("all"))
    return rows.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.transform("all", lambda r: r["feature"]).alias("features"))).alias("value"))
