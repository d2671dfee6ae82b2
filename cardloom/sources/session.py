"""What jobs need of the running session."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(df: DataFrame) -> DataFrame:
    """The frame, after making sure that Python workers of its session can import this package from where it is."""
    sc = df.sparkSession.sparkContext
    known = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in known:
        sc.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *known])
    return df


def work_folder(spark: SparkSession, name: str = "work") -> str:
    """A new folder that all executors see, below ``spark.checkpoint.dir``; a local session without that setting gets one of its own."""
    sc = spark.sparkContext
    shared = sc.getConf().get("spark.checkpoint.dir")
    if shared is None and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(shared or tempfile.mkdtemp()).rstrip('/')}/{name}-{uuid.uuid4()}"
