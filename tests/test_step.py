"""The registered database samples tracks as finely as the reference's settings say: every km."""

import datetime as dt

from pyspark.sql import functions as F

from galetrack.plans import registry, storms
from test_domain import squares


def test_a_cut_corner_is_a_landfall(spark, monkeypatch):
    # Over the north-west corner of A: 1.6 km of land in 157 km.
    t, ends = dt.datetime(2020, 9, 1), [(-0.45, 0.54), (0.55, 1.54)]
    rows = [(1, i, t + dt.timedelta(hours=6 * i), x, y, "TS", None, 60, 990, True) for i, (x, y) in enumerate(ends)]
    points = spark.createDataFrame(rows, "storm_id int, point_seq int, timestamp_utc timestamp, longitude double, latitude double, status string, record_identifier string, max_wind_kt int, min_pressure_mb int, is_synoptic boolean")
    seasons = points.select("storm_id").distinct().select("storm_id", F.lit(2020).alias("season"), F.lit("X").alias("name"), F.lit("AL").alias("basin"))
    units = spark.createDataFrame([(1, "A", "Land", "US"), (2, "B", "Land", "US")], "unit_id int, admin1_name string, country_name string, iso_country string")
    gates = spark.createDataFrame([("g1", "west", 0.0, 0.4, 0.0, 0.6)], "gate_id string, region string, x1 double, y1 double, x2 double, y2 double")
    monkeypatch.setattr(registry, "inputs", lambda *_: storms.Inputs(points, seasons, units, squares(spark), gates))
    built = registry.database(spark, "a cut corner")
    assert [r["landfall_admin1"] for r in built.landfalls.collect()] == ["A"]
