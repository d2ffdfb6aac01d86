"""Written intermediate tables, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only on a single machine where it is unset
    (tests) a temporary folder is made; a cluster without it is refused, since its
    executors couldn't read one another's folders."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="galetrack-")
    atexit.register(shutil.rmtree, made, True)
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def settle(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once and read back: later steps neither repeat it nor lose it."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
