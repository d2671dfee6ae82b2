"""Upserts in levels: a table keyed by columns that takes many small batches and stays cheap to read.

Batch n is written as a run of its own.  Whenever ``FANOUT`` runs of one level are full they are merged into one
run of the next level, with the last row of each key.  So after n batches the runs that count are the digits of n to
the base ``FANOUT``: which they are follows from n alone, a read touches a logarithmic number of them, and a row
is written again once for each level.  Within a run rows lie by bucket of their key, and look-ups of some keys read their
buckets only.

Every step overwrites runs of its own name from runs that stay, so a batch that comes again after a failure does no harm, and readers of
an earlier number of batches are not disturbed; forget() empties what no later reader needs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import keep_last

FANOUT, BUCKETS = 4, 16


def runs_of(n: int, fanout: int = FANOUT) -> list[tuple[int, int]]:
    """(level, first batch) of the runs that hold batches 0 to n - 1."""
    found, at, level = [], 0, 0
    while fanout ** (level + 1) <= n:
        level += 1
    while level >= 0:
        while at + fanout**level <= n:
            found.append((level, at))
            at += fanout**level
        level -= 1
    return found


@dataclass(frozen=True)
class Levels:
    """A table at a path with one row per key, the last by batch and then by ``order``; rows with a null key are dropped."""

    path: str
    keys: tuple[str, ...]
    order: str
    fanout: int = FANOUT
    buckets: int = BUCKETS

    def run(self, level: int, first: int) -> str:
        """The place of a run."""
        return f"{self.path}/level={level}/first={first}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _last(self, rows: DataFrame) -> DataFrame:
        return keep_last(rows.withColumn("_ord", F.struct("_batch", F.col(f"`{self.order}`"))), list(self.keys), "_ord").drop("_ord")

    def _write(self, rows: DataFrame, level: int, first: int) -> None:
        # by key too, so that more tasks than there are buckets write a large run
        dealt = rows.withColumn("_bucket", self._bucket()).repartition("_bucket", *[F.col(f"`{k}`") for k in self.keys])
        dealt.write.partitionBy("_bucket").mode("overwrite").parquet(self.run(level, first))

    def _read(self, spark: SparkSession, runs: list[tuple[int, int]]) -> DataFrame | None:
        read = None
        for run in runs:
            rows = spark.read.parquet(self.run(*run))
            read = rows if read is None else read.unionByName(rows, allowMissingColumns=True)
        return read

    def put(self, batch: DataFrame, number: int) -> None:
        """Take a batch, the numbers being 0, 1, 2 and so on; then merge every level that it fills."""
        spark = batch.sparkSession
        own = self._last(batch.withColumn("_batch", F.lit(number).cast("bigint")))
        self._write(own, 0, number)
        level = 1
        while (number + 1) % self.fanout**level == 0:
            below = self.fanout ** (level - 1)
            first = number + 1 - self.fanout**level
            parts = self._read(spark, [(level - 1, first + i * below) for i in range(self.fanout)])
            self._write(self._last(parts.drop("_bucket")), level, first)
            level += 1

    def read(self, spark: SparkSession, n: int) -> DataFrame:
        """The table after n batches, n at least 1."""
        return self._last(self._read(spark, runs_of(n, self.fanout)).drop("_bucket")).drop("_batch")

    def look_up(self, wanted: DataFrame, n: int) -> DataFrame:
        """The rows of the keys in wanted (each once) after n batches, from their buckets only; the buckets are a bounded list."""
        spark = wanted.sparkSession
        own = [r[0] for r in wanted.select(self._bucket()).distinct().collect()]
        rows = self._read(spark, runs_of(n, self.fanout)).where(F.col("_bucket").isin(*own)).drop("_bucket")
        return self._last(rows.join(wanted.select(*self.keys), list(self.keys), "left_semi")).drop("_batch")

    def forget(self, spark: SparkSession, n: int) -> None:
        """Empty the runs that reads of n batches and later ones do not touch and the last merges have left behind."""
        for level, first in runs_of(n, self.fanout):
            for below in range(level):
                step = self.fanout**below
                for at in range(first, first + self.fanout**level, step):
                    path = self.run(below, at)
                    rows = spark.read.parquet(path)
                    if not rows.isEmpty():
                        spark.createDataFrame([], rows.drop("_bucket").schema).write.mode("overwrite").parquet(path)

    def work(self) -> Callable[[DataFrame, int], None]:
        """For resume.each_batch()."""
        return self.put
