import duckdb
import pytest
from pyspark.errors import AnalysisException

import __spark_entry__ as entry
from galetrack.plans import analytics, planar, registry, storms

DIR = "/root/testdata/sf0.001"


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_against_sql(spark, name):
    db = duckdb.connect()
    for t in ("events", "nation", "region"):
        db.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    got = registry.QUERIES[name](spark, DIR)
    cols = sorted(got.columns)
    want = db.execute(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from ({registry.ORACLE[name]})").fetchall()
    key = lambda r: tuple((v is None, str(v)) for v in r)
    mine = sorted([tuple(r[c] for c in cols) for r in got.collect()], key=key)
    assert len(mine) == len(want)
    for a, b in zip(mine, sorted([tuple(r) for r in want], key=key)):
        assert all(x == y or (x is not None and y is not None and float(x) == pytest.approx(float(y))) for x, y in zip(a, b))


@pytest.mark.parametrize("name", [f"table_{t}" for t in storms.TABLES])
def test_tables_of_the_geodesic_build(spark, name):
    assert registry.QUERIES[name](spark, DIR).count() > (-1 if name == "table_bypasses" else 0)


def test_scope_guard(spark):
    db = registry.database(spark, DIR, flat=True)
    analytics.guard(db, planar.CONUS)
    with pytest.raises(analytics.EmptyScope, match="NATION_1"):
        analytics.guard(db)


def test_views(spark):
    db = registry.database(spark, DIR, flat=True)
    db.register("t_")
    assert spark.sql("select count(*) from t_v_us_landfalls where basin is not null").first()[0] > 0
    for name, start in (("v_track_points", "POINT"), ("v_landfalls", "POINT"), ("v_storms", "LINESTRING"), ("v_landfall_gates", "LINESTRING")):
        rows = db.views()[name]
        wkt = next(c for c in rows.columns if c.endswith("_wkt"))
        assert rows.where(f"{wkt} like '{start} (%'").count() == rows.count() > 0


def test_subpackage_is_optional():
    import sys
    from unittest import mock

    with mock.patch.dict(sys.modules, {"galetrack.llm": None, "galetrack.llm.queries": None}):
        assert set(entry.queries()) >= set(registry.QUERIES)


def test_changed_files_are_noticed(spark, tmp_path):
    import shutil

    for name in ("events", "nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = registry.inputs(spark, str(tmp_path))
    assert registry.inputs(spark, str(tmp_path)) is before
    fewer = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("user_id < 5")
    shutil.rmtree(tmp_path / "events.parquet")
    fewer.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    after = registry.inputs(spark, str(tmp_path))
    assert after is not before and after.points.count() == fewer.count() < before.points.count()


def test_missing_inputs_are_refused_by_their_reading(spark, tmp_path):
    assert registry.state(spark, str(tmp_path)) == registry.state(spark, str(tmp_path))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        registry.inputs(spark, str(tmp_path))
