"""What the operators share about the running session."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a small frame that one task takes, and rows up to which a frame may be broadcast.
ROWS, SMALL = 200_000, 50_000
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_held: dict[str, dict] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package and make sure of a checkpoint folder.

    The folder is the one in ``spark.checkpoint.dir``.  Only a local session
    without that setting (tests) gets one of its own; a cluster without it is an
    error, since executors would not see each other's files.
    """
    sc = spark.sparkContext
    known = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in known:
        sc.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *known])
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if shared is None and not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or os.path.join(tempfile.gettempdir(), "checkpoints"))
    return spark


def settle(df: DataFrame, n: int | None = None, rows: int = ROWS) -> DataFrame:
    """Compute a frame once and keep it in the shared checkpoint folder.

    With n, about how many rows it has, it is computed and kept in no more parts than hold
    ``rows`` each, so that a small frame isn't as many files and tasks as a large one has.
    """
    prepare(df.sparkSession)
    return gathered(df, n, rows).checkpoint()


def gathered(df: DataFrame, n: int | None, rows: int = ROWS) -> DataFrame:
    """The frame in no more parts than n rows fill."""
    return df if n is None else df.coalesce(max(1, -(-n // rows)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def held(name: str) -> dict:
    """What the operators of this name keep in this Python worker from task to task.

    A worker lives on from stage to stage: what others kept in it goes, and its memory goes back to the system.
    """
    if name not in _held:
        others = bool(_held)
        _held.clear()
        _held[name] = {}
        if others:
            give_back()
    return _held[name]


def give_back() -> None:
    """Memory that this process no longer uses goes back to the system, where that can be asked for."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def identity(text: Column) -> Column:
    """Two hashes of different seed, as one struct, that stand for a text."""
    return F.struct(F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y"))
