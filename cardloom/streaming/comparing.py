"""The comparison of the two chains, kept up to date from new rows only.

What is known of a card and of a number is a state that merges with the state of more rows: sets of phones, the first filled value of
each field with its order, sums and flags.  Both lie in levels (``levels``), so new rows read only the buckets of the
cards and numbers that they touch.  Metrics are sums over cards and numbers: each increment adds what the touched ones
give now and takes away what they gave before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import card_key, strip
from ..operators import compare
from .levels import Levels

#: Fields whose first filled value counts, by side.
_FIELDS = {"a": ("name", "company"), "b": ("name_std", "company_std")}


def _partial(rows: DataFrame, side: str, order: str, phone: str) -> DataFrame:
    """A state for each row of one side; the other side's part is empty."""

    def filled(name: str) -> Column:
        return F.nullif(strip(F.col(name).cast("string")), F.lit("")) if name in rows.columns else F.lit(None).cast("string")

    number = filled(phone)
    key_person = F.coalesce(F.col("is_key_person").cast("boolean"), F.lit(False)) if "is_key_person" in rows.columns else F.lit(False)
    columns = [card_key("source_label", "file", "page", "card_no").alias("card_key")]
    for own, fields in _FIELDS.items():
        mine = own == side
        none = F.array().cast("array<string>")
        columns += [
            (F.when(number.isNotNull(), F.array(number)).otherwise(none) if mine else none).alias(f"phones_{own}"),
            F.lit(1 if mine else 0).cast("long").alias(f"n_rows_{own}"),
            (key_person.cast("long") if mine else F.lit(0).cast("long")).alias(f"n_key_rows_{own}"),
        ]
        for field in fields:
            value = F.struct(F.col(order).alias("ord"), filled(field).alias("value"))
            columns.append((F.when(filled(field).isNotNull(), value) if mine else F.lit(None).cast(f"struct<ord:{rows.schema[order].dataType.simpleString()},value:string>")).alias(f"{field}_{own}"))
    return rows.select(*columns)


def _merged(states: DataFrame) -> DataFrame:
    """One state for each card."""
    every = []
    for own, fields in _FIELDS.items():
        every += [F.array_sort(F.array_distinct(F.flatten(F.collect_set(f"phones_{own}")))).alias(f"phones_{own}")]
        every += [F.sum(f"{c}_{own}").alias(f"{c}_{own}") for c in ("n_rows", "n_key_rows")] + [F.min(f"{c}_{own}").alias(f"{c}_{own}") for c in fields]
    return states.groupBy("card_key").agg(*every)


def _sides(states: DataFrame) -> DataFrame:
    """States in the form of compare.card_sides()."""

    def side(own: str) -> Column:
        fields = [F.coalesce(f"{c}_{own}.value", F.lit("")).alias(c) for c in _FIELDS[own]]
        struct = F.struct(F.col(f"phones_{own}").alias("phones"), F.col(f"n_rows_{own}").alias("n_rows"), F.col(f"n_key_rows_{own}").alias("n_key_rows"), (F.col(f"n_key_rows_{own}") > 0).alias("is_key_person"), *fields)
        return F.when(F.col(f"n_rows_{own}") > 0, struct).alias(own)

    return states.select("card_key", side("a"), side("b"))


@dataclass(frozen=True)
class Comparing:
    """A comparison at a path, which takes new phone rows of either chain as increments 0, 1, 2 and so on."""

    path: str
    order: str = "ord"
    phone: str = "phone_normalized"
    fanout: int = 4
    buckets: int = 16

    def _levels(self, name: str, key: str) -> Levels:
        return Levels(f"{self.path}/{name}", (key,), "number", self.fanout, self.buckets)

    def take(self, a: DataFrame, b: DataFrame, number: int) -> None:
        """New rows of both chains, either of which may be none.  An increment that comes again after a failure replaces itself."""
        spark = a.sparkSession
        cards, phones = self._levels("cards", "card_key"), self._levels("phones", "phone")
        new = _merged(_partial(a, "a", self.order, self.phone).unionByName(_partial(b, "b", self.order, self.phone)))
        numbers = compare.phone_sides(a, b, self.phone)
        before = self.metrics(spark, number) if number else None
        sums = []
        for levels, own, key, join, metrics in (
            (cards, new, "card_key", _merged, lambda x: compare.card_metrics(_sides(x))),
            (phones, numbers, "phone", lambda x: x.groupBy("phone").agg(F.bool_or("in_a").alias("in_a"), F.bool_or("in_b").alias("in_b")), compare.phone_metrics),
        ):
            # what is read several times is computed once
            own = self._written(own, f"new-{key}", number)
            old = self._written(levels.look_up(own.select(key), number).drop("number"), f"old-{key}", number) if number else None
            now = join(own if old is None else own.unionByName(old))
            levels.put(now.withColumn("number", F.lit(number)), number)
            # what was put is read back, so that it is computed once
            sums.append((metrics(spark.read.parquet(levels.run(0, number)).drop("number", "_batch", "_bucket")), None if old is None else metrics(old)))
        total = sums[0][0].crossJoin(sums[1][0]).select(*compare.METRICS)  # single rows
        if before is not None:
            less = sums[0][1].crossJoin(sums[1][1]).select(*[(-F.col(c)).alias(c) for c in compare.METRICS])
            total = total.unionByName(less).unionByName(before).agg(*[F.sum(c).alias(c) for c in compare.METRICS])
        total.write.mode("overwrite").parquet(f"{self.path}/metrics/number={number}")

    def _written(self, rows: DataFrame, name: str, number: int) -> DataFrame:
        path = f"{self.path}/{name}/number={number}"
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def metrics(self, spark: SparkSession, n: int) -> DataFrame:
        """The 20 metrics after n increments, as compare.overview() gives them for all rows at once."""
        return spark.read.parquet(f"{self.path}/metrics/number={n - 1}")

    def card_sides(self, spark: SparkSession, n: int) -> DataFrame:
        """Both sides of every card after n increments."""
        return _sides(self._levels("cards", "card_key").read(spark, n).drop("number"))
