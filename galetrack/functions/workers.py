"""Python workers of this package's functions."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package where it isn't installed but shared."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
