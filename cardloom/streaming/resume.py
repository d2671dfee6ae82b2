"""Incremental work as Structured Streaming: the checkpoint folder remembers what is done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.layout import cards
from ..operators.state import keep_last
from ..sources.session import work_folder as work_folder


def page_stream(spark: SparkSession, folder: str, schema: str = schemas.PAGE, files_at_once: int = 1000) -> DataFrame:
    """Results of pages as they arrive in a folder as JSON lines."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).json(folder)


def new_cards(pages: DataFrame) -> DataFrame:
    """Cards of good pages, without state: every page is cut by itself."""
    lines = F.coalesce("raw.data.line_rects", F.array().cast(f"array<{schemas.RECT}>"))
    return cards(pages.where("ok").select("file", "page", "line_texts", lines.alias("line_rects")))


def first_seen(rows: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """Each key once, for repeats up to ``late`` behind the newest time; state older than that is dropped."""
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def append(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Work off what is there, append it to Parquet exactly once, stop."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def each_batch(rows: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Work off what is there batch by batch with a function, as for calls to a service.

    A batch may come again after a failure, so work must write under the batch number
    or be idempotent, as upserts are.
    """
    return rows.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_into(spark: SparkSession, path: str, keys: list[str], order: str) -> Callable[[DataFrame, int], None]:
    """Work for each_batch(): appends a batch's last row of each key; read with latest()."""

    def work(batch: DataFrame, number: int) -> None:
        keep_last(batch, keys, order).withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/_number={number}")

    return work


def latest(spark: SparkSession, path: str, keys: list[str], order: str) -> DataFrame:
    """The table that upsert_into() keeps: the last row of each key over all batches.

    It reads every batch since the last compacted() table took their place.
    """
    rows = spark.read.option("basePath", path).parquet(f"{path}/*")
    return keep_last(rows.withColumn("_ord", F.struct("_batch", order)), keys, "_ord").drop("_batch", "_ord", "_number")


def compacted(spark: SparkSession, path: str, target: str, keys: list[str], order: str) -> None:
    """Write what latest() reads as the first batch of a new table, to go on with there; batches of the stream have numbers from 0 on."""
    latest(spark, path, keys, order).withColumn("_batch", F.lit(-1)).write.mode("overwrite").parquet(f"{target}/_number=-1")
