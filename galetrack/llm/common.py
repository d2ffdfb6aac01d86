"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import pickle
import uuid
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galetrack.operators.stage import settle, shared_root

#: White space of every word-level contract: `[\x20\x09-\x0D]`.
SPACE_CLASS = r"\x20\x09-\x0D"


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder name below the folder that driver and executors share."""
    return f"{shared_root(spark)}/{tag}-{uuid.uuid4().hex}"


#: ``materialise(df, tag)``: written once below that folder and read back.
materialise = settle


def importable(spark: SparkSession) -> None:
    """Readies a session for this package's Python functions: their import, and batches.

    Where the session has Spark's default of rows in an Arrow batch, it is lowered to
    ``BATCH_ROWS``: batches hold whole texts. A setting of the user's own stays.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) in (None, "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


BATCH_ROWS = 2048
#: Of texts, a batch need not hold more than so many bytes.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Lets Arrow batches end at ``BATCH_BYTES`` too, which bounds what a task holds of
    texts on both sides. Where the session has a limit of its own, that stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


#: What this Python worker has built, with its token: later tasks find it, caches warm.
_WORKER: dict[str, object] = {}


def per_worker(token: str, build: Callable[[], object]):
    """``build()``, once in each Python worker for a token. Only the last one is kept,
    so that the models and caches of stages that are over take no memory."""
    if token not in _WORKER:
        release()
        _WORKER[token] = build()
    return _WORKER[token]


def release() -> None:
    """Gives back what this Python worker holds of a stage that is over. For the first
    tasks of a stage: those that need no model would carry the former one along."""
    _WORKER.clear()
    pa.default_memory_pool().release_unused()


def send(spark: SparkSession, value: object):
    """A broadcast of ``value`` in pickled form. Spark's workers keep what they have read
    of a broadcast; of this they keep the bytes, not the objects made from them."""
    return spark.sparkContext.broadcast(pickle.dumps(value, pickle.HIGHEST_PROTOCOL))


def received(held) -> object:
    """A copy of what :func:`send` was given."""
    return pickle.loads(held.value)


def new_token() -> str:
    return uuid.uuid4().hex


def map_rows(
    df: DataFrame,
    schema: str,
    make: Callable[[], Callable[[dict[str, list]], dict[str, list]]],
    rows: int = 2048,
) -> DataFrame:
    """Maps columns to columns, in Arrow batches of at most ``rows`` rows.

    ``make`` runs once in each task and returns the function for a batch; it
    takes and returns a dict of equally long Python lists.
    """
    importable(df.sparkSession)
    out_schema = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                got = step({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[f.name], f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, out_schema)


def fold(column, n: int):
    """crc32 of the decimal text of an id, modulo ``n``: the folds of the contracts."""
    return F.crc32(F.encode(column.cast("string"), "UTF-8")) % n


def fold_of(value: int | None, n: int) -> int | None:
    """The same in Python."""
    return None if value is None else zlib.crc32(str(value).encode()) % n


def stable_order(*names: str):
    """Order columns that rank rows alike in every run, nulls first."""
    return [F.col(n).asc_nulls_first() for n in names]
