"""Command line: build, compare, gates, provenance.

Exit codes: 0 done, 1 the comparison doesn't pass (too little of the list was read, or too
many of its named storms are missing), 2 a wrong call or missing file.
"""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galetrack.operators import coastgates, geometry
from galetrack.plans import external, storms
from galetrack.sources import besttrack, geoparquet, hurricane_list, shapefile, sinks, tables
from galetrack.sources.config import Config


def session() -> SparkSession:
    return SparkSession.builder.appName("galetrack").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def land(spark: SparkSession, config: Config) -> tuple[DataFrame, DataFrame]:
    """The user's own land if there is an override, else the one of the settings."""
    path = config.path("coastline.override_path" if config.get("coastline.override_path") else "coastline.path")
    if not path.exists():
        raise FileNotFoundError(f"no land at {path}; set coastline.override_path or coastline.path")
    return tables.read_land(spark, str(path), dict(config.get("coastline.columns", {})))


def gates(spark: SparkSession, config: Config, units: DataFrame, edges: DataFrame) -> DataFrame:
    """The user's own gates, or even ones along the coast."""
    if config.get("gates.override_path"):
        path = str(config.path("gates.override_path"))
        found = shapefile.read_gates(spark, path) if path.endswith(".shp") else tables.read_gates_csv(spark, path)
    else:
        fine, countries = geometry.split_edges(edges), list(config.get("gates.countries", []))
        coast = geometry.country_coastline(fine, units, countries) if countries else geometry.boundary_edges(fine)
        found = coastgates.generate(coast, config.calibration("gate_spacing_km"), config.calibration("gate_half_width_km"), edges, units)
    tables.validate_gates(found)
    return found


#: What a build may write beside its Parquet tables.
FORMATS = ("parquet", "geoparquet", "warehouse")


def build(config: Config, options: argparse.Namespace) -> int:
    formats = list(config.get("output.formats") or ["parquet"])
    if unknown := sorted(set(formats) - set(FORMATS)):
        raise ValueError(f"unknown output.formats {unknown}; there are {list(FORMATS)}")
    spark = session()
    units, edges = land(spark, config)
    track = besttrack.read(spark, [str(p) for p in config.basin_paths().values()])
    given = {}
    for c in config.calibrations.values():
        given |= {f"calibration.{c.name}": f"{c.value:g}", f"calibration.{c.name}.status": c.status, f"calibration.{c.name}.source": " ".join(c.source.split())}
    sources = track.provenance.collect()  # a row for each file
    given |= {f"source.{Path(r['path']).name}": r["sha256"] for r in sources}
    land_path = config.get("coastline.override_path") or config.get("coastline.path")
    given |= {
        "generated_at_utc": datetime.now(UTC).isoformat(timespec="seconds"), "track_sources": ", ".join(r["path"] for r in sources), "track_sha256": ", ".join(r["sha256"] for r in sources),
        "coastline_source": str(config.get("coastline.name") or Path(str(land_path)).stem), "coastline_path": str(land_path),
        "gate_set_origin": str(config.get("gates.override_path") or "generated"), "parse_warnings": str(track.issues.count()),
    }
    step = config.calibration("landfall_segment_step_km")
    db = storms.build(track.points, track.storms, edges, units, gates(spark, config, units, edges), step, radius_km=config.calibration("bypass_radius_km"), provenance=given)
    built, out = {n: getattr(db, n) for n in storms.TABLES}, config.path("output.path")
    sinks.write_tables(built, str(out))
    # What was written is read for the other formats, so that nothing is worked out again.
    db = storms.Database(*[tables.read_built(spark, str(out), n) for n in storms.TABLES])
    if "geoparquet" in formats:
        for name, rows in db.geometric().items():
            if name != "metadata":
                geoparquet.write(rows, str(out / "geo" / name))
    if "warehouse" in formats:
        places = {"track_points": ("longitude", "latitude"), "landfalls": ("exact_lon", "exact_lat"), "bypasses": ("bypass_lon", "bypass_lat")}
        text = "\n".join([sinks.ddl(built), sinks.copy_text(built, str(config.get("output.stage") or "GALETRACK")), sinks.view_text(places, {"storms": "track_wkt"})])
        (out / "warehouse.sql").write_text(text, encoding="utf-8")
    return 0


def compare(config: Config, options: argparse.Namespace) -> int:
    spark, out = session(), str(config.path("output.path"))
    db = storms.Database(*[tables.read_built(spark, out, n) for n in storms.TABLES])
    path = options.list or str(config.path("qa.list_path"))
    if not Path(path).exists():
        raise FileNotFoundError(f"no list at {path}")
    listed = hurricane_list.read(spark, path)
    text = external.report(db, listed.where("kind = 'landfall'"))
    found = external.passes(db, listed).first()
    text += f"\n{'PASS' if found['passed'] else 'FAIL'}: {found['rate']:.1%} of the list read, {found['missing']} of {found['named']} named storms missing\n"
    if options.report:
        Path(options.report).write_text(text, encoding="utf-8")
    print(text)
    return int(not found["passed"])


def show_gates(config: Config, options: argparse.Namespace) -> int:
    spark = session()
    units, edges = land(spark, config)
    found = gates(spark, config, units, edges)
    print(f"{found.count()} gates")
    if options.export:
        # The columns that the reader of gate files takes.
        found = found.orderBy("sort_order").select("gate_id", "gate_name", "region", *[F.col(a).alias(b) for a, b in (("x1", "lon1"), ("y1", "lat1"), ("x2", "lon2"), ("y2", "lat2"))])
        found.coalesce(1).write.mode("overwrite").option("header", True).csv(options.export)
    return 0


def provenance(config: Config, options: argparse.Namespace) -> int:
    print(config.provenance(), end="")
    return 0


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="galetrack", description="Landfalls and near misses of tropical cyclones from best tracks.")
    parser.add_argument("--config", required=True, help="the settings, a YAML file")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, run, text in (("build", build, "all tables"), ("compare", compare, "against an external list"), ("gates", show_gates, "count or export the gates"), ("provenance", provenance, "the register of calibrations")):
        command = commands.add_parser(name, help=text)
        command.set_defaults(run=run)
        if name == "compare":
            command.add_argument("--list", help="the list's web page; else that of the settings, qa.list_path")
            command.add_argument("--report", help="a file for the comparison")
        if name == "gates":
            command.add_argument("--export", help="a folder for the gates as CSV")
    options = parser.parse_args(arguments)
    try:
        return options.run(Config.load(options.config), options)
    except (FileNotFoundError, KeyError, ValueError) as wrong:
        print(f"galetrack: {wrong}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
