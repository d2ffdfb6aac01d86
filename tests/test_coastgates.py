import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from galetrack import __main__ as command
from galetrack.functions import wkb
from galetrack.functions.geodesy import inverse
from galetrack.operators import coastgates, geometry
from galetrack.sources import geoparquet, tables
from test_domain import squares


def test_gates_around_squares(spark):
    edges = squares(spark)
    units = spark.createDataFrame([(1, "A", "Land"), (2, "B", "Land")], "unit_id int, admin1_name string, country_name string")
    got = coastgates.generate(geometry.boundary_edges(edges), 50.0, 10.0, edges, units).orderBy("sort_order").collect()
    # Each square is one ring of about 443 km: nine gates, in the order of the squares.
    assert [r["gate_id"] for r in got] == [f"G{i:05d}" for i in range(18)]
    assert [r["region"] for r in got] == ["A"] * 9 + ["B"] * 9 and got[0]["gate_name"] == "A, Land"
    x1, y1, x2, y2 = (np.array([r[c] for r in got]) for c in ("x1", "y1", "x2", "y2"))
    assert inverse(x1, y1, x2, y2, 12)[0] == pytest.approx(20.0, abs=1e-6)
    # The middle lies on the square's side, and the gate stands across it (one of nine stands at a corner).
    mx, my = (x1 + x2) / 2 % 2, (y1 + y2) / 2
    side = np.minimum(np.minimum(abs(mx), abs(mx - 1)), np.minimum(abs(my), abs(my - 1)))
    assert side.max() < 1e-3
    assert sum(min(abs(a), abs(b)) < 1e-3 for a, b in zip(x2 - x1, y2 - y1)) == 16


def test_lines(spark):
    rows = [(0.0, 0.0, 1.0, 0.0), (2.0, 0.0, 1.0, 0.0), (5.0, 5.0, 5.1, 5.0), (1.0, 0.0, 1.0, 0.0)]
    lines = coastgates.coast_lines(spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double")).collect()
    assert len(lines) == 3 and len({r["line"] for r in lines}) == 2
    assert coastgates.walk(np.array(rows[:2])).tolist() == [[0, 0], [1, 0], [2, 0]]
    short = coastgates.place(np.array([[5.0, 5.0], [5.1, 5.0]]), 50.0, 1.0)
    assert len(short) == 1 and short[0][0] == pytest.approx(5.05) and math.isclose(short[0][6], 11.09, abs_tol=0.01)
    with pytest.raises(coastgates.GateError):
        coastgates.generate(spark.createDataFrame([], "x1 double, y1 double, x2 double, y2 double"), 50.0, 1.0)
    with pytest.raises(coastgates.GateError):
        coastgates.generate(spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double"), 0.0, 1.0)


def test_command_line(spark, tmp_path, capsys):
    box = [[-95, 28], [-94, 28], [-94, 29], [-95, 29], [-95, 28]]
    feature = {"type": "Feature", "properties": {"n": "Texas", "a": "United States", "c": "US"}, "geometry": {"type": "Polygon", "coordinates": [box]}}
    (tmp_path / "land.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}))
    (tmp_path / "al.txt").write_text("AL011999, QUILL, 2,\n" + "".join(f"19990801, {t},  , HU, 28.5N,  {x}W,  {w}, {p}, {'0, ' * 12}20\n" for t, x, w, p in (("0000", "93.0", 90, 960), ("0600", "94.6", 80, 970))))
    (tmp_path / "list.html").write_text("<tr><td>1999</td><td>Aug</td><td>TX, 1</td><td>1</td><td>970</td><td>85</td><td>Quill</td></tr>")
    entry = lambda v: {"value": v, "status": "sourced", "source": "a test"}
    settings = {
        "coastline": {"path": "land.json", "columns": {"admin1_name": "n", "country_name": "a", "iso_country": "c"}}, "basins": {"AL": {"path": "al.txt"}}, "output": {"path": "out", "formats": ["parquet", "geoparquet", "warehouse"]},
        "calibration": {n: entry(v) for n, v in (("gate_spacing_km", 50), ("gate_half_width_km", 10), ("landfall_segment_step_km", 1), ("bypass_radius_km", 111.12))},
    }
    (tmp_path / "pyproject.toml").write_text("")
    (tmp_path / "c.yaml").write_text(json.dumps(settings))
    run = lambda *a: command.main(["--config", str(tmp_path / "c.yaml"), *a])
    assert run("provenance") == 0 and "gate_spacing_km" in capsys.readouterr().out
    assert run("build") == 0
    falls = spark.read.parquet(str(tmp_path / "out/landfalls"))
    assert [r["landfall_admin1"] for r in falls.where("is_landfall").collect()] == ["Texas"]
    drawn = {n: geoparquet.read(spark, str(tmp_path / "out/geo" / n)) for n in ("storms", "track_points", "landfalls", "landfall_gates")}
    assert drawn["storms"].select(F.size(wkb.as_line(F.col("geometry")))).first()[0] == 2
    assert drawn["track_points"].select(wkb.as_point(F.col("geometry"))["x"].alias("x")).orderBy("x").collect() == [(-94.6,), (-93.0,)]
    assert drawn["landfalls"].count() == falls.count() and drawn["landfall_gates"].where("geometry is null").isEmpty()
    text = (tmp_path / "out/warehouse.sql").read_text()
    assert all(t in text for t in ("CREATE TABLE IF NOT EXISTS LANDFALLS", "COPY INTO STORMS\nFROM @GALETRACK/storms/", "CREATE OR REPLACE VIEW V_LANDFALLS AS", "ST_MAKEPOINT(EXACT_LON, EXACT_LAT)"))
    assert run("compare", "--list", str(tmp_path / "list.html")) == 0 and "detected 1" in capsys.readouterr().out
    (tmp_path / "list.html").write_text("<tr><td>1998</td><td>Aug</td><td>TX, 1</td><td>1</td><td>970</td><td>85</td><td>Other</td></tr>")
    assert run("compare", "--list", str(tmp_path / "list.html")) == 1
    assert run("gates", "--export", str(tmp_path / "gates")) == 0
    again = tables.read_gates_csv(spark, str(next((tmp_path / "gates").glob("*.csv"))))
    tables.validate_gates(again)
    meta = {r["key"]: r["value"] for r in spark.read.parquet(str(tmp_path / "out/metadata")).collect()}
    assert {"generated_at_utc", "track_sha256", "coastline_source", "gate_set_origin", "parse_warnings", "calibration.gate_spacing_km.source"} <= set(meta)
    (tmp_path / "c.yaml").write_text(json.dumps(settings | {"output": {"path": "out", "formats": ["parquets"]}}))
    assert run("build") == 2
    (tmp_path / "c.yaml").write_text(json.dumps(settings))
    (tmp_path / "al.txt").unlink()
    assert run("build") == 2
