"""Queries that SQL can express, against it."""

import duckdb
import pytest

from galetrack.llm import queries

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        db.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    got = queries.QUERIES[name](spark, DIR)
    want = db.execute(f"select {', '.join(sorted(got.columns))} from ({queries.ORACLE[name]})").fetchall()
    assert sorted((tuple(r[c] for c in sorted(got.columns)) for r in got.collect()), key=str) == sorted(want, key=str)
