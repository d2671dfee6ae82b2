"""Partitions as one table, and their summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed


def partition_dim(spark: SparkSession, partitions: list[tuple[str, str]] | None = None) -> DataFrame:
    """(ord, run_name, source_label): the partitions in their order, those of the published run by default.

    A list held by the caller, so it is a local table of a known, small size.
    """
    rows = [(i, *p) for i, p in enumerate(fixed.PARTITIONS if partitions is None else partitions)]
    return spark.createDataFrame(rows, "ord int, run_name string, source_label string")


def not_blank(rows: DataFrame) -> DataFrame:
    """Rows with a value other than null and empty text in any column."""
    filled = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) != "" for c, kind in rows.dtypes if not kind.startswith(("array", "struct", "map"))]
    return rows.where(reduce(lambda a, b: a | b, filled)) if filled else rows


def merged(parts: dict[str, DataFrame], columns: list[str] | None = None, dataset: str = fixed.DATASET) -> DataFrame:
    """UNION ALL of labelled partitions with source_label and source_dataset in front.

    Columns are those given, else of the first partition; what a partition lacks is
    empty text, what it has besides is dropped.  Blank rows are left out.
    """
    if not parts:
        raise ValueError("no partitions to merge")
    columns = columns or next(iter(parts.values())).columns
    columns = [c for c in columns if c not in ("source_label", "source_dataset")]

    def labelled(label: str, rows: DataFrame) -> DataFrame:
        own = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in columns]
        return not_blank(rows).select(F.lit(label).alias("source_label"), F.lit(dataset).alias("source_dataset"), *own)

    return reduce(DataFrame.unionByName, (labelled(*p) for p in parts.items()))


def summary(rows: DataFrame, dim: DataFrame, total: str = fixed.TOTAL) -> DataFrame:
    """(ord, source_label, row_count) for every partition of dim, 0 included, and their total, ordered by ord.

    Rows are counted by label before the join, so it meets one row per label.
    """
    counts = rows.groupBy("source_label").agg(F.count("*").alias("n"))
    each = dim.join(counts, "source_label", "left").select("ord", "source_label", F.coalesce("n", F.lit(0)).alias("row_count"))
    by_label = each.groupBy("ord", "source_label").agg(F.sum("row_count").alias("row_count"))
    whole = each.agg((F.coalesce(F.max("ord"), F.lit(-1)) + 1).alias("ord"), F.lit(total).alias("source_label"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"))
    return by_label.unionByName(whole).orderBy("ord")
