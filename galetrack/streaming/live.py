"""Structured Streaming over fixes (storm_id, timestamp_utc, longitude, latitude, status, max_wind_kt, ...)."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

from galetrack.functions import domain
from galetrack.functions.workers import importable
from galetrack.operators import cover
from galetrack.operators.stage import settle
from galetrack.plans import storms


def labelled(fixes: DataFrame, index: DataFrame) -> DataFrame:
    """``fixes`` with the unit they lie over and their labels: a join with the written index, without state."""
    rows = cover.with_unit(fixes, index, out="over_unit")
    wind = F.col("max_wind_kt")
    return rows.withColumns({"is_over_land": F.col("over_unit").isNotNull(), "ss_category": domain.ss_category(wind), "event_class": domain.event_class(F.col("status"), wind)})


def daily_peaks(fixes: DataFrame, late: str = "12 hours") -> DataFrame:
    """Strongest wind of each storm and day; a day is final once the watermark has passed it."""
    rows = fixes.withWatermark("timestamp_utc", late).groupBy(F.window("timestamp_utc", "1 day").alias("day"), "storm_id")
    return rows.agg(F.max("max_wind_kt").alias("peak_wind_kt"), F.count("*").alias("n")).select("storm_id", F.col("day.start").alias("day"), "peak_wind_kt", "n")


IDLE_S = 600.0
_BUFFER = "payload binary, at timestamp"


class Ordering(StatefulProcessor):
    """Holds a storm's fixes until they can be put in order.

    State for each storm: the fixes that wait, the newest time seen, and the time up to
    which fixes have been let go. A fix is let go once a fix of its storm is newer by the
    delay, or when a timer ends because nothing of the storm has come for a while; fixes
    of equal time go in the order of ``point_seq``. One that comes for a time already let
    go is marked late and handed on at once.
    """

    def __init__(self, columns: list[str], delay_s: float, idle_s: float):
        self.columns, self.delay, self.idle = columns, pd.Timedelta(seconds=delay_s), int(idle_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _BUFFER)
        self.marks = handle.getValueState("marks", "newest timestamp, gone timestamp")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        marks = self.marks.get() if self.marks.exists() else None
        newest, gone = (pd.Timestamp(marks[0]), None if marks[1] is None else pd.Timestamp(marks[1])) if marks else (None, None)
        come = pd.concat(list(rows), ignore_index=True)
        late = come[come["timestamp_utc"] <= gone] if gone is not None else come.iloc[:0]
        fresh = come.drop(late.index)
        if len(late):
            yield self._out(late, "late")
        if not len(fresh):
            return
        newest = max(x for x in (newest, fresh["timestamp_utc"].max()) if x is not None)
        held = self._held()
        held = fresh if held is None else pd.concat([held, fresh], ignore_index=True)
        yield from self._let_go(held, newest, newest - self.delay, gone)
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old[0] if isinstance(old, tuple | list) else old)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        if held is not None:
            marks = self.marks.get()
            newest = pd.Timestamp(marks[0])
            yield from self._let_go(held, newest, newest, None if marks[1] is None else pd.Timestamp(marks[1]))

    def close(self) -> None:
        pass

    def _held(self) -> pd.DataFrame | None:
        rows = [pickle.loads(r[0]) for r in self.waiting.get()] if self.waiting.exists() else []
        return pd.DataFrame(rows, columns=self.columns) if rows else None

    def _let_go(self, held: pd.DataFrame, newest, upto, gone) -> Iterator[pd.DataFrame]:
        ready = held["timestamp_utc"] <= upto
        rest = held[~ready]
        self.waiting.clear()
        if len(rest):
            self.waiting.put([(pickle.dumps(r), r[self.columns.index("timestamp_utc")].to_pydatetime()) for r in rest.itertuples(index=False, name=None)])
        out = held[ready].sort_values(["timestamp_utc", "point_seq"], kind="stable")
        if len(out):
            gone = out["timestamp_utc"].max()
        self.marks.update((newest.to_pydatetime(), None if gone is None else gone.to_pydatetime()))
        if len(out):
            yield self._out(out, "ordered")

    def _out(self, rows: pd.DataFrame, kind: str) -> pd.DataFrame:
        return rows[self.columns].astype(object).where(rows[self.columns].notna(), None).assign(kind=kind)


def ordered(fixes: DataFrame, delay_s: float = 12 * 3600.0, idle_s: float = IDLE_S) -> DataFrame:
    """``fixes`` with ``kind``: 'ordered' rows come in the order of their storm's times, 'late'
    ones came too late for that. Needs Spark's RocksDB state store."""
    importable(fixes.sparkSession)
    out = StructType([*fixes.schema.fields, StructField("kind", StringType())])
    return fixes.groupBy("storm_id").transformWithStateInPandas(Ordering(fixes.columns, delay_s, idle_s), out, "Append", "ProcessingTime")


def keep_landfalls(fixes: DataFrame, seasons: DataFrame, land: storms.Land, folder: str, delay_s: float = 12 * 3600.0, idle_s: float = IDLE_S, **options):
    """A stream writer that keeps the landfall table of all fixes that have come, below ``folder``.

    Each batch appends its ordered fixes to ``fixes`` and its late ones to ``late``, both
    by batch, so that a batch that runs again replaces what it wrote. The landfalls of
    the storms that the batch touched are then made anew by the batch build from all
    their fixes: a storm has some hundred, so a batch costs what its own storms cost, and
    events, sequence and types are those of the batch build. ``landfalls`` has them by
    batch, and :func:`current_landfalls` the latest of each storm.
    """
    spark = fixes.sparkSession

    def batch(rows: DataFrame, number: int) -> None:
        rows = settle(rows, f"stream-{number}")
        for kind in ("ordered", "late"):
            rows.where(F.col("kind") == kind).drop("kind").write.mode("overwrite").parquet(f"{folder}/{kind}/batch={number:09d}")
        touched = rows.where("kind = 'ordered'").select("storm_id").distinct()
        if touched.isEmpty():
            return
        whole = spark.read.parquet(f"{folder}/ordered").drop("batch").join(touched, "storm_id", "left_semi")
        # Places in the track follow the times, whatever order the fixes came in.
        track = Window.partitionBy("storm_id").orderBy("timestamp_utc", "point_seq")
        whole = settle(whole.withColumn("point_seq", (F.row_number().over(track) - 1).cast("int")), f"stream-tracks-{number}")
        found = storms.landfalls(whole, seasons, land.edges, land.units, land.gates, land.index, land.masses, land.mainland, **options)
        marked = touched.join(found, "storm_id", "left")  # a storm without landfalls is a row too
        marked.write.mode("overwrite").parquet(f"{folder}/landfalls/batch={number:09d}")

    return ordered(fixes, delay_s, idle_s).writeStream.foreachBatch(batch).outputMode("append")


def current_landfalls(spark: SparkSession, folder: str) -> DataFrame:
    """The landfall table as of the last batch of each storm."""
    rows = spark.read.parquet(f"{folder}/landfalls")
    last = rows.groupBy("storm_id").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["storm_id", "batch"], "left_semi").where("landfall_seq is not null").drop("batch")
