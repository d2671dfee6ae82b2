"""Enrichment in micro-batches: calls go on across restarts, and a final error stops them for all tasks.

Each micro-batch is asked as one frame and appended to the answers under its number.  Before the next one
the answers are read: if this attempt has met a final error, no more calls are made and the stream ends without
having taken the batch, so a later attempt begins with it.  What failed earlier is put again by ``unanswered``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import enrich
from ..operators.state import keep_last, logged
from ..sources import files
from .resume import each_batch

_SEEN = "card_key string, error string, fatal boolean, tokens bigint, attempt string, at timestamp, number bigint"


class Stopped(RuntimeError):
    """A batch was not asked because an earlier one of the attempt met a final error."""


def answers(spark: SparkSession, path: str) -> DataFrame:
    """All answers so far, a row per card and attempt; the columns of STANDARD and tokens, error, fatal, attempt, at, number."""
    return files.parquet_if_there(spark, path, _SEEN)


def last_answers(spark: SparkSession, path: str) -> DataFrame:
    """The last answer of each card, a good one before any failed one."""
    rows = answers(spark, path).withColumn("_order", F.struct(F.col("error").isNull(), F.col("at"), F.col("number")))
    return keep_last(rows, ["card_key"], "_order").drop("_order")


def unanswered(cards: DataFrame, path: str) -> DataFrame:
    """Cards without a good answer yet."""
    good = answers(cards.sparkSession, path).where("error IS NULL").select("card_key").distinct()
    return cards.join(good, "card_key", "left_anti")


def run_log(spark: SparkSession, path: str, run: str, input_fingerprint: str) -> DataFrame:
    """The answers as rows of a run log, for state.status() and state.pending_units()."""
    own = answers(spark, path).select(F.lit(run).alias("run"), F.lit(input_fingerprint).alias("input_fingerprint"), F.col("card_key").alias("unit"), F.col("error").isNull().alias("ok"), "fatal", "error", "tokens", "at")
    return logged(own)


def final_error(spark: SparkSession, path: str, attempt: str) -> str | None:
    """The final error that an attempt has met, if any."""
    row = answers(spark, path).where(F.col("fatal") & (F.col("attempt") == attempt)).select("error").first()
    return row["error"] if row else None


def asked(provider: enrich.Provider, model: str, path: str, attempt: str, **options):
    """Work for resume.each_batch(): asks for the cards of a batch that have no good answer and keeps what comes under the batch's number.

    A batch that comes again after a failure overwrites its own answers of this attempt and asks again only for
    cards that no other batch has answered.  Raises Stopped, without a call, after a final error of the attempt.
    """

    def work(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        error = final_error(spark, path, attempt)
        if error is not None:
            raise Stopped(error)
        left = unanswered(batch, path).dropDuplicates(["card_key"])
        rows = enrich.with_answers(left, enrich.call(left, provider, **options), model)
        marked = rows.withColumns({"attempt": F.lit(attempt), "at": F.current_timestamp(), "number": F.lit(number).cast("bigint")})
        marked.write.mode("overwrite").parquet(f"{path}/part=attempt-{attempt}-{number}")

    return work


def enriched(cards: DataFrame, provider: enrich.Provider, model: str, path: str, checkpoint: str, attempt: str, **options) -> StreamingQuery:
    """A stream of cards asked batch by batch into ``path``; it ends when all is asked, or as failed with Stopped after a final error.

    Give each start a new ``attempt``; the checkpoint stays.  Failed cards of batches that are done: catch_up().
    """
    return each_batch(cards, asked(provider, model, path, attempt, **options), checkpoint)


def catch_up(cards: DataFrame, provider: enrich.Provider, model: str, path: str, attempt: str, **options) -> None:
    """Ask once more for those of the cards (a table) that a stream has taken and that have no good answer."""
    spark = cards.sparkSession
    taken = answers(spark, path).select("card_key").distinct()
    asked(provider, model, path, f"{attempt}-again", **options)(cards.join(taken, "card_key", "left_semi"), -1)
