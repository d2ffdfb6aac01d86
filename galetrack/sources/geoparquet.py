"""Tables with a geometry column as GeoParquet 1.1: well-known binary, a box for each row.

``point``, ``line``, ``polygon`` and ``polygons`` make ``geometry`` and ``bbox`` columns.
:func:`write` puts near rows together (a curve through the boxes' middles ranges the
rows over files and sorts them within), so that the statistics of ``bbox`` in a file's row
groups say where its rows lie; :func:`read` filters on ``bbox``, and Spark's own Parquet
reader skips the row groups elsewhere.

Files are written by Arrow, a task at a time, with the metadata that Spark's writer can't
add. A task buffers ``GROUP_BYTES`` at most, or one batch. Files get their place at the commit only: what a
lost task left is removed. Paths are those that Arrow knows: local, ``hdfs``, ``s3``, ``gs``.

Defined results: a row without geometry has no box, is kept, and is read back unless a box is
asked for; a table without any geometry is written as plain Parquet without these two
columns; an empty table gives no rows and keeps its schema. A geometry that meets the
antimeridian is not split.
"""

from __future__ import annotations

import json
import os
import uuid
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from galetrack.functions import wkb
from galetrack.functions.workers import importable

VERSION = "1.1.0"
BOX = ("xmin", "ymin", "xmax", "ymax")
#: A row group is written when its rows or bytes reach these.
GROUP_ROWS, GROUP_BYTES = 50_000, 64 << 20
NAME = "galetrack-geoparquet"


def _with(df: DataFrame, geometry: Column, spots: Column) -> DataFrame:
    """``df`` with a geometry and the box of its vertices ``spots``."""
    x, y = F.transform(spots, lambda s: s["x"]), F.transform(spots, lambda s: s["y"])
    box = F.struct(*[end.alias(n) for n, end in zip(BOX, (F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)))])
    return df.withColumn("geometry", geometry).withColumn("bbox", F.when(F.col("geometry").isNotNull(), box))


def point(df: DataFrame, lon: str, lat: str) -> DataFrame:
    x, y = F.col(lon), F.col(lat)
    return _with(df, wkb.point(x, y), F.array(F.struct(x.alias("x"), y.alias("y"))))


def line(df: DataFrame, spots: Column) -> DataFrame:
    """Lines of two vertices or more; others are null."""
    return _with(df, F.when(F.size(spots) >= 2, wkb.line(spots)), spots)


def polygon(df: DataFrame, rings: Column) -> DataFrame:
    return _with(df, wkb.polygon(rings), F.flatten(rings))


def polygons(df: DataFrame, parts: Column) -> DataFrame:
    return _with(df, wkb.polygons(parts), F.flatten(F.flatten(parts)))


def _spread(c: Column) -> Column:
    """The lowest 16 bits of a long, a gap after each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return c


def curve() -> Column:
    """Place of a box's middle along a Z curve over the sphere; rows without a box come last."""
    cell = lambda a, b, span: F.least(F.greatest(F.floor(((F.col(f"bbox.{a}") + F.col(f"bbox.{b}")) / 2 / span + 0.5) * 65536).cast("long"), F.lit(0)), F.lit(65535))
    key = _spread(cell("xmin", "xmax", 360.0)).bitwiseOR(F.shiftleft(_spread(cell("ymin", "ymax", 180.0)), 1))
    return F.coalesce(F.when(F.col("bbox").isNotNull(), key), F.lit(1 << 33))


def write(df: DataFrame, path: str, files: int | None = None, group_rows: int = GROUP_ROWS) -> None:
    """Replaces the table at ``path``. ``files``: how many at most; Spark's choice if not given."""
    if df.where("geometry is not null").isEmpty():
        df.drop("geometry", "bbox").write.mode("overwrite").parquet(path)
        return
    spark = df.sparkSession
    importable(spark)
    spark.dataSource.register(GeoParquetSink)
    ranged = df.withColumn("_curve", curve())
    ranged = ranged.repartitionByRange(files, "_curve") if files else ranged.repartitionByRange("_curve")
    kept = ranged.sortWithinPartitions("_curve").drop("_curve")
    kept.write.format(NAME).mode("overwrite").option("group_rows", group_rows).save(path)


def metadata(kinds: set[int], box: list[float] | None) -> str:
    """The ``geo`` entry of a file."""
    column = {"encoding": "WKB", "geometry_types": sorted(wkb.NAMES[k] for k in kinds), "covering": {"bbox": {n: ["bbox", n] for n in BOX}}}
    if box:
        column["bbox"] = box
    return json.dumps({"version": VERSION, "primary_column": "geometry", "columns": {"geometry": column}})


def filesystem(path: str):
    """(file system, path within it) of a path or address, as Arrow knows them."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(path)
    if path.startswith("file:"):  # file:/a and file:///a
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


class GeoParquetSink(DataSource):
    @classmethod
    def name(cls):
        return NAME

    def writer(self, schema, overwrite):
        return GeoParquetWriter(self.options["path"], int(self.options["group_rows"]))


class Written(WriterCommitMessage):
    def __init__(self, file: str):
        self.file = file


class GeoParquetWriter(DataSourceArrowWriter):
    """A file for each task with rows, in a folder of this write; moved to its place at the commit."""

    def __init__(self, path: str, group_rows: int):
        self.path, self.group_rows = path, group_rows
        self.work = f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        first = next((b for b in iterator if b.num_rows), None)
        if first is None:
            return Written("")
        files, root = filesystem(self.path)
        files.create_dir(f"{root}/{self.work}", recursive=True)
        file = f"{self.work}/part-{uuid.uuid4().hex}.parquet"
        schema = first.schema
        kinds, ends, held, size = set(), [], [], 0
        with pq.ParquetWriter(f"{root}/{file}", schema, filesystem=files, compression="snappy") as out:

            def flush():
                out.write_table(pa.Table.from_batches(held, schema), row_group_size=self.group_rows)
                held.clear()

            for batch in chain([first], iterator):
                shapes = batch["geometry"].drop_null()
                if len(shapes):
                    # The kind is the fifth byte of what this module writes; other writers' low byte comes second.
                    heads = pc.unique(pc.binary_slice(shapes, 0, 5)).to_pylist()
                    kinds.update(int.from_bytes(h[1:], "little" if h[0] else "big") for h in heads)
                    box = batch["bbox"].drop_null()
                    least = [pc.min(box.field(i)).as_py() for i in (0, 1)]
                    ends.append(least + [pc.max(box.field(i)).as_py() for i in (2, 3)])
                held.append(batch)
                size += batch.nbytes
                if size >= GROUP_BYTES or sum(b.num_rows for b in held) >= self.group_rows:
                    flush()
                    size = 0
            if held:
                flush()
            box = [min(e[i] for e in ends) for i in (0, 1)] + [max(e[i] for e in ends) for i in (2, 3)] if ends else None
            out.add_key_value_metadata({"geo": metadata(kinds, box)})
        return Written(file)

    def commit(self, messages):
        files, root = filesystem(self.path)
        old = self._tables(files, root)
        for m in messages:
            if m is not None and m.file:
                files.move(f"{root}/{m.file}", f"{root}/{m.file.rsplit('/', 1)[1]}")
        for name in old:
            files.delete_file(name)
        self._clear(files, root)

    def abort(self, messages):
        self._clear(*filesystem(self.path))

    def _clear(self, files, root):
        from pyarrow import fs

        if files.get_file_info(f"{root}/{self.work}").type == fs.FileType.Directory:
            files.delete_dir(f"{root}/{self.work}")

    @staticmethod
    def _tables(files, root):
        from pyarrow import fs

        inside = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return [i.path for i in inside if i.type == fs.FileType.File and not i.base_name.startswith((".", "_"))]


def described(path: str) -> dict | None:
    """The ``geo`` entry of a table's first file; None where it has none."""
    import pyarrow.parquet as pq

    files, root = filesystem(path)
    for name in sorted(GeoParquetWriter._tables(files, root)):
        found = (pq.read_metadata(name, filesystem=files).metadata or {}).get(b"geo")
        return json.loads(found) if found else None
    return None


def read(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """The table at ``path``; with a ``box`` (west, south, east, north), the rows whose own box meets it."""
    rows = spark.read.parquet(path)
    if box is None:
        return rows
    geo = described(path)
    if not geo or geo["columns"][geo["primary_column"]]["encoding"] != "WKB":
        raise ValueError(f"no geometry in {path}")
    covering = geo["columns"][geo["primary_column"]].get("covering", {}).get("bbox")
    if not covering:
        raise ValueError(f"no boxes in {path}")
    at = {n: F.col(".".join(f"`{p}`" for p in covering[n])) for n in BOX}
    west, south, east, north = box
    return rows.where((at["xmin"] <= east) & (at["xmax"] >= west) & (at["ymin"] <= north) & (at["ymax"] >= south))
