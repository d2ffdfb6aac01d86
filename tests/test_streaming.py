import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from galetrack.operators import cover
from galetrack.operators.stage import settle
from galetrack.plans import storms
from galetrack.streaming import live
from test_domain import squares

SCHEMA = "storm_id int, point_seq int, timestamp_utc timestamp, longitude double, latitude double, status string, record_identifier string, max_wind_kt int, min_pressure_mb int, is_synoptic boolean"
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def at(h):
    return dt.datetime(2020, 9, 1) + dt.timedelta(hours=h)


def fixes(rng, storm):
    xs = [rng.uniform(-2, 4) for _ in range(8)]
    return [(storm, i, at(6 * i), x, 0.5, "TS", "L" if rng.random() < 0.2 else None, 60 + i, 990, True) for i, x in enumerate(xs)]


@pytest.fixture
def store(spark):
    old = spark.conf.get(STORE[0])
    spark.conf.set(*STORE)
    yield
    spark.conf.set(STORE[0], old)


def source(spark, path, batches):
    """A stream that gives one batch of rows at a time."""
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_labels_and_peaks(spark, tmp_path):
    index = settle(cover.build(squares(spark)), "stream-index")
    row = lambda s, i, h, x, status, wind: (s, i, at(h), x, 0.5, status, None, wind, 990, True)
    batches = [[row(1, 0, 0, -1.0, "HU", 70), row(2, 0, 0, 0.5, "TS", 50)], [row(1, 2, 6, 0.5, "HU", 90), row(2, 1, 6, 1.5, "TS", 40)], [row(1, 1, 3, 1.5, "HU", 80), row(2, 2, 30, 2.5, "TD", 30)]]
    stream = source(spark, str(tmp_path / "in"), batches)
    for name, rows, mode in (("peaks", live.daily_peaks(stream), "complete"), ("labels", live.labelled(stream, index), "append")):
        query = rows.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        query.awaitTermination(240)
    assert {(r["storm_id"], r["day"], r["peak_wind_kt"], r["n"]) for r in spark.table("peaks").collect()} == {(1, at(0), 90, 3), (2, at(0), 50, 2), (2, at(24), 30, 1)}
    assert spark.table("labels").where("is_over_land and event_class = 'Hurricane (Cat 1+)'").count() == 1


def test_landfalls_of_a_shuffled_stream(spark, tmp_path, store):
    """Fixes that come out of order, by less than the delay, give what the batch build gives; later ones are kept aside."""
    rng = random.Random(6)
    rows = [r for s in range(4) for r in fixes(rng, s)]
    # Each fix comes up to 11 hours late; the delay is 12. The last fixes of all storms let the others go.
    order = sorted(rows, key=lambda r: r[2] + dt.timedelta(hours=rng.uniform(0, 11)))
    late = (0, 90, at(1), 3.9, 0.5, "TS", None, 20, 990, True)
    end = [(s, 99, at(200), 9.0, 9.0, "TS", None, 20, 990, True) for s in range(4)]
    batches = [order[:15], [*order[15:], *end], [late]]
    units = spark.createDataFrame([(1, "A", "Land", "US"), (2, "B", "Land", "US")], "unit_id int, admin1_name string, country_name string, iso_country string")
    gates = spark.createDataFrame([("g1", "west", 0.0, 0.4, 0.0, 0.6)], "gate_id string, region string, x1 double, y1 double, x2 double, y2 double")
    seasons = spark.createDataFrame([(s, 2020, "X", "AL") for s in range(4)], "storm_id int, season int, name string, basin string")
    land, folder = storms.prepare(squares(spark), units, gates), str(tmp_path / "out")
    stream = source(spark, str(tmp_path / "in"), batches)
    query = live.keep_landfalls(stream, seasons, land, folder, idle_s=10_000, step_km=5.0).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(600)
    assert query.exception() is None
    assert [tuple(r) for r in spark.read.parquet(f"{folder}/late").drop("batch").collect()] == [late]
    ordered = spark.read.parquet(f"{folder}/ordered").drop("batch")
    assert sorted(map(tuple, ordered.collect()), key=str) == sorted(rows, key=str)  # the last fixes still wait
    points = spark.createDataFrame(rows, SCHEMA)
    want = storms.landfalls(points, seasons, land.edges, units, gates, land.index, land.masses, land.mainland, 5.0)
    key = lambda df: sorted(map(tuple, df.select(sorted(want.columns)).collect()), key=str)
    got = live.current_landfalls(spark, folder)
    assert key(got) == key(want) and got.count() > 3 and got.where(F.col("landfall_seq") > 1).count() > 0


def test_a_timer_lets_the_rest_go(spark, tmp_path, store):
    rows = fixes(random.Random(1), 3)
    stream = source(spark, str(tmp_path / "in"), [rows[::-1], [(9, 0, at(0), 0.0, 0.0, "TS", None, 20, 990, True)]])
    query = live.ordered(stream, delay_s=1e6, idle_s=0.1).writeStream.format("memory").queryName("let_go").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="2 seconds").start()
    try:
        for _ in range(60):
            query.awaitTermination(2)
            if spark.table("let_go").count() >= len(rows) + 1:
                break
    finally:
        query.stop()
    got = [r["point_seq"] for r in spark.table("let_go").where("storm_id = 3 and kind = 'ordered'").collect()]
    assert got == list(range(len(rows)))
