"""What is done and what is left: keyed tables, run logs, pending work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def free(rows: DataFrame, name: str) -> str:
    """A column name that rows doesn't have."""
    while name in rows.columns:
        name += "_"
    return name


def keep_last(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key by ``order``, null coming first, by partial maxima; rows with a null key are dropped."""
    whole = rows.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    own = free(rows, "last")
    last = whole.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct(order)).alias(own))
    return last.select(f"{own}.*")


def upserted(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """old and new as one table with the last row of each key by ``order``; among equals a row of new wins."""
    mine = free(old.select(*old.columns, *[F.lit(0).alias(c) for c in new.columns if c not in old.columns]), "place")
    sides = [rows.withColumn(mine, F.struct(F.col(order), F.lit(newer).alias("newer"))) for rows, newer in ((old, False), (new, True))]
    return keep_last(sides[0].unionByName(sides[1], allowMissingColumns=True), keys, mine).drop(mine)


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of work whose key is not among those done."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def pending_pages(work: DataFrame, results: DataFrame, keys: list[str], ok: str = "ok") -> DataFrame:
    """Rows of work without a good result; failed ones come again.

    With the input's fingerprint among the keys a changed input starts anew.
    """
    return pending(work, results.where(F.coalesce(F.col(ok), F.lit(False))), keys)


def split_ok(rows: DataFrame, ok: str = "ok") -> tuple[DataFrame, DataFrame]:
    """Good rows and all others; a missing mark counts as failed."""
    good = F.coalesce(F.col(ok), F.lit(False))
    return rows.where(good), rows.where(~good)


def counters(rows: DataFrame, ok: str = "ok") -> DataFrame:
    good = F.coalesce(F.col(ok), F.lit(False))
    return rows.agg(F.count("*").alias("n"), F.count_if(good).alias("n_ok"), F.count_if(~good).alias("n_failed"))


def card_counters(cards: DataFrame) -> DataFrame:
    """(pages, cards, empty_cards, lines) of a table of cards, in one pass."""
    return cards.agg(
        F.count_if(F.col("card_no") == 1).alias("pages"), F.count("*").alias("cards"), F.count_if(~F.col("has_text")).alias("empty_cards"),
        F.coalesce(F.sum(F.size("line_texts")), F.lit(0)).alias("lines"),
    )


def logged(results: DataFrame) -> DataFrame:
    """Rows for the run log from results with run, input_fingerprint, unit and ok; what else a log holds is taken where results have it.

    ``input_fingerprint`` is that of the input that was read (sources.files.inputs()).  Append the rows to the log.
    """
    have = {"fatal": F.lit(False), "error": F.lit(None).cast("string"), "tokens": F.lit(0).cast("bigint"), "at": F.current_timestamp()}
    more = [F.coalesce(F.col(c), x).alias(c) if c in results.columns else x.alias(c) for c, x in have.items()]
    return results.select("run", "input_fingerprint", F.col("unit").cast("string").alias("unit"), F.coalesce("ok", F.lit(False)).alias("ok"), *more)


def pending_units(units: DataFrame, log: DataFrame) -> DataFrame:
    """Units (run, input_fingerprint, unit) that the log has no good entry for; a changed input has another fingerprint and starts anew."""
    return pending_pages(units.withColumn("unit", F.col("unit").cast("string")), log, ["run", "input_fingerprint", "unit"])


def status(inputs: DataFrame, log: DataFrame) -> DataFrame:
    """State of every input by run log: pending, running, interrupted, fatal or completed, with counts.

    ``inputs`` has run, input_fingerprint and total_units; log rows of another
    fingerprint do not count.  An input is complete when all its units are good.
    """
    units = keep_last(log, ["run", "input_fingerprint", "unit"], "at")
    state = units.groupBy("run", "input_fingerprint").agg(
        F.count_if("ok").alias("n_ok"),
        F.count_if(~F.coalesce("ok", F.lit(False))).alias("n_failed"),
        F.bool_or(F.coalesce("fatal", F.lit(False))).alias("is_fatal"),
        F.sum(F.coalesce("tokens", F.lit(0))).alias("tokens"),
        F.max("at").alias("updated_at"),
        F.max_by("error", F.when(F.col("error").isNotNull(), F.col("at"))).alias("last_error"),
    )
    name = (
        F.when(F.col("n_ok").isNull(), "pending")
        .when(F.col("is_fatal"), "fatal")
        .when(F.col("n_ok") >= F.col("total_units"), "completed")
        .when(F.col("n_failed") > 0, "interrupted")
        .otherwise("running")
    )
    return inputs.join(state, ["run", "input_fingerprint"], "left").withColumn("status", name).drop("is_fatal")


def latest_run(files: DataFrame, name_pattern: str) -> DataFrame:
    """(path, modified) of the newest entry whose name matches; no row if none does."""
    own = files.where(F.element_at(F.split("path", "/"), -1).rlike(name_pattern))
    return own.agg(F.max_by("path", "modified").alias("path"), F.max("modified").alias("modified")).where("path IS NOT NULL")


def without_parts(runs: DataFrame, skipped: list[str], tag: str = "tag") -> DataFrame:
    """Runs whose tag and whose zone (its last letter) are not to be skipped."""
    return runs.where(~F.col(tag).isin(*skipped) & ~F.right(F.col(tag), F.lit(1)).isin(*skipped)) if skipped else runs
