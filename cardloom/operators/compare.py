"""Comparison of the two chains, card by card and number by number."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import card_key, strip

FIELDS = ("name", "company", "title", "name_std", "company_std", "title_std", "kp_role")
MOST_CARDS, MOST_PHONES = 500, 2000


def by_card(rows: DataFrame, order: str = "ord", phone: str = "phone_normalized") -> DataFrame:
    """One row per card: sorted distinct phones, the first filled value of each field, whether any row is a key person.

    "First" is by ``order``, a column that numbers the rows.  Missing columns count as
    null; null, empty and blank values as not filled.  n_rows and n_key_rows count a card's rows and those
    of key persons.  Nothing but partial minima and sets of a card's own phones is shuffled.
    """
    have = {c: strip(F.col(c).cast("string")) if c in rows.columns else F.lit(None).cast("string") for c in (phone, *FIELDS)}
    key_person = F.coalesce(F.col("is_key_person").cast("boolean"), F.lit(False)) if "is_key_person" in rows.columns else F.lit(False)
    keyed = rows.select(
        card_key("source_label", "file", "page", "card_no").alias("card_key"),
        *[F.col(c).cast("string").alias(f"_{c}") for c in ("source_label", "file", "page", "card_no")],
        F.col(order).alias("_ord"), key_person.alias("_key"), F.nullif(have[phone], F.lit("")).alias("_phone"),
        *[F.nullif(have[c], F.lit("")).alias(f"_{c}") for c in FIELDS],
    )
    firsts = [F.min_by(f"_{c}", F.when(F.col(f"_{c}").isNotNull(), F.col("_ord"))).alias(c) for c in FIELDS]
    return keyed.groupBy("card_key").agg(
        *[F.min_by(f"_{c}", "_ord").alias(c) for c in ("source_label", "file", "page", "card_no")],
        F.array_sort(F.collect_set("_phone")).alias("phones"),
        *[F.coalesce(x, F.lit("")).alias(c) for x, c in zip(firsts, FIELDS)],
        F.bool_or("_key").alias("is_key_person"),
        F.count("*").alias("n_rows"),
        F.count_if("_key").alias("n_key_rows"),
    )


@dataclass(frozen=True)
class Comparison:
    """The sheets of a report."""

    overview: DataFrame
    conclusion: DataFrame
    card_diff: DataFrame
    phone_diff: DataFrame

    def sheets(self) -> dict[str, DataFrame]:
        return {"overview": self.overview, "conclusion": self.conclusion, "card_diff": self.card_diff, "phone_diff": self.phone_diff}


def phone_sides(a: DataFrame, b: DataFrame, phone: str = "phone_normalized") -> DataFrame:
    """(phone, in_a, in_b): distinct filled phones of both sides, from one shuffle of partial sums."""

    def side(rows: DataFrame, in_a: bool) -> DataFrame:
        own = strip(F.col(phone).cast("string"))
        return rows.select(own.alias("phone"), F.lit(in_a).alias("in_a"), F.lit(not in_a).alias("in_b")).where("phone <> ''")

    both = side(a, True).unionByName(side(b, False))
    return both.groupBy("phone").agg(F.bool_or("in_a").alias("in_a"), F.bool_or("in_b").alias("in_b"))


def card_sides(a: DataFrame, b: DataFrame, order: str = "ord") -> DataFrame:
    """Full outer join of both chains' cards by card_key; every column of a side is a struct member of a or b."""
    left, right = by_card(a, order), by_card(b, order)
    return left.select("card_key", F.struct(*left.columns).alias("a")).join(right.select("card_key", F.struct(*right.columns).alias("b")), "card_key", "full_outer")


def _classified(sides: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    pa, pb = F.coalesce("a.phones", none), F.coalesce("b.phones", none)
    kind = (
        F.when((F.size(pa) > 0) & (pa == pb), "equal")
        .when((F.size(pa) > 0) & (F.size(pb) > 0), "different")
        .when(F.size(pa) > 0, "a_only")
        .when(F.size(pb) > 0, "b_only")
        .otherwise("none")
    )
    return sides.withColumns({"phones_a": pa, "phones_b": pb, "kind": kind})


def phone_metrics(sides: DataFrame) -> DataFrame:
    """The five metrics of numbers as one row, from what phone_sides() gives."""
    return sides.agg(
        F.count_if("in_a").alias("rule_unique_phones"),
        F.count_if("in_b").alias("llm_unique_phones"),
        F.count_if(F.col("in_a") & F.col("in_b")).alias("phones_in_both"),
        F.count_if(F.col("in_a") & ~F.col("in_b")).alias("phones_only_in_rule"),
        F.count_if(F.col("in_b") & ~F.col("in_a")).alias("phones_only_in_llm"),
    )


def card_metrics(sides: DataFrame) -> DataFrame:
    """The fifteen metrics of cards as one row, from what card_sides() gives."""
    rows_a, rows_b, key_rows = (F.coalesce(F.sum(c), F.lit(0)) for c in ("a.n_rows", "b.n_rows", "b.n_key_rows"))
    return _classified(sides).agg(
        rows_a.alias("rule_phone_rows"),
        rows_b.alias("llm_phone_rows"),
        key_rows.alias("llm_kp_rows"),
        (rows_b - key_rows).alias("llm_non_kp_rows"),
        F.count_if(F.size("phones_a") > 0).alias("rule_cards_with_phone"),
        F.count_if(F.col("b").isNotNull()).alias("llm_cards_in_export"),
        F.count_if(F.col("b.is_key_person")).alias("llm_kp_cards"),
        F.count_if(F.col("kind") == "equal").alias("cards_phone_set_equal"),
        F.count_if(F.col("kind") == "different").alias("cards_phone_set_diff"),
        F.count_if(F.col("kind") == "a_only").alias("cards_only_rule_has_phone"),
        F.count_if(F.col("kind") == "b_only").alias("cards_only_llm_has_phone"),
        F.count_if(F.col("a.name") != "").alias("cards_with_name_rule"),
        F.count_if(F.col("b.name_std") != "").alias("cards_with_name_std_llm"),
        F.count_if(F.col("a.company") != "").alias("cards_with_company_rule"),
        F.count_if(F.col("b.company_std") != "").alias("cards_with_company_std_llm"),
    )


def overview(a: DataFrame, b: DataFrame, order: str = "ord") -> DataFrame:
    """The 20 metrics as one row; each side is read twice, once by card and once by number."""
    # two rows of one line each
    return phone_metrics(phone_sides(a, b)).crossJoin(card_metrics(card_sides(a, b, order))).select(*METRICS)


METRICS = [
    "rule_phone_rows", "rule_unique_phones", "rule_cards_with_phone", "llm_phone_rows", "llm_unique_phones", "llm_cards_in_export", "llm_kp_rows",
    "llm_non_kp_rows", "llm_kp_cards", "phones_in_both", "phones_only_in_rule", "phones_only_in_llm", "cards_phone_set_equal", "cards_phone_set_diff",
    "cards_only_rule_has_phone", "cards_only_llm_has_phone", "cards_with_name_rule", "cards_with_name_std_llm", "cards_with_company_rule", "cards_with_company_std_llm",
]


def as_metrics(row: DataFrame) -> DataFrame:
    """(ord, metric, value) from a row of numbers."""
    each = [F.struct(F.lit(i).alias("ord"), F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for i, c in enumerate(row.columns)]
    return row.select(F.inline(F.array(*each)))


def card_diffs(a: DataFrame, b: DataFrame, order: str = "ord", most: int = MOST_CARDS) -> DataFrame:
    """The first cards by key whose phones differ, with what differs."""
    note = F.when(F.col("kind") == "different", fixed.NOTE_DIFFERENT).when(F.col("kind") == "a_only", fixed.NOTE_A).otherwise(fixed.NOTE_B)
    return (
        _classified(card_sides(a, b, order))
        .where(F.col("kind").isin("different", "a_only", "b_only"))
        .select(
            "card_key",
            F.coalesce("a.source_label", "b.source_label").alias("source_label"),
            F.array_join("phones_a", ";").alias("phones_a"),
            F.array_join("phones_b", ";").alias("phones_b"),
            note.alias("note"),
        )
        .orderBy("card_key")
        .limit(most)
    )


def phone_diffs(a: DataFrame, b: DataFrame, most: int = MOST_PHONES) -> DataFrame:
    """(kind, phone): the first numbers of each side that the other lacks."""
    sides = phone_sides(a, b)
    only_a = sides.where("in_a AND NOT in_b").orderBy("phone").limit(most).select(F.lit(fixed.KIND_A).alias("kind"), "phone")
    only_b = sides.where("in_b AND NOT in_a").orderBy("phone").limit(most).select(F.lit(fixed.KIND_B).alias("kind"), "phone")
    return only_a.unionByName(only_b)


def conclusion(metrics: DataFrame, calls: int | None = None, tokens: int | None = None) -> DataFrame:
    """(ord, topic, chain_a, chain_b, advice) in words, all figures taken from the metrics.

    Calls and tokens come from the run log; without them the line says so.
    """
    more = F.when(F.col("rule_unique_phones") > F.col("llm_unique_phones"), "A").when(F.col("rule_unique_phones") < F.col("llm_unique_phones"), "B").otherwise("neither")
    cost = f"{calls} calls, {tokens} tokens" if calls is not None and tokens is not None else "not recorded"
    text = [
        ("unique phones", F.format_string("%d", "rule_unique_phones"), F.format_string("%d", "llm_unique_phones"),
         F.format_string("%s has more; %d only in B and %d only in A: merge by purpose", more, F.col("phones_only_in_llm"), F.col("phones_only_in_rule"))),
        ("phones in both", F.format_string("%d", "phones_in_both"), F.format_string("%d", "phones_in_both"),
         F.format_string("check samples of the %d and %d that one side lacks", "phones_only_in_rule", "phones_only_in_llm")),
        ("names", F.format_string("%d cards, first line that fits", "cards_with_name_rule"), F.format_string("%d cards, standardised", "cards_with_name_std_llm"),
         F.lit("A lists only cards with a phone, B all cards")),
        ("key persons", F.lit("none"), F.format_string("%d cards", "llm_kp_cards"), F.lit("take B to choose by rank")),
        ("cost", F.lit("recognition and rules"), F.lit(cost), F.lit("A is the base, B adds to it")),
        ("overall", F.lit("-"), F.lit("-"),
         F.format_string("numbers of A are the base (%d), B adds %d more, standardised fields and %d cards of key persons: deliver A with B's key persons, or both merged after a check of samples",
                         "rule_unique_phones", "phones_only_in_llm", "llm_kp_cards")),
    ]
    rows = [F.struct(F.lit(i).alias("ord"), F.lit(t).alias("topic"), a.alias("chain_a"), b.alias("chain_b"), c.alias("advice")) for i, (t, a, b, c) in enumerate(text)]
    return metrics.select(F.inline(F.array(*rows)))


def compared(a: DataFrame, b: DataFrame, order: str = "ord", calls: int | None = None, tokens: int | None = None) -> Comparison:
    """All sheets of the comparison of phone rows of chains A and B."""
    metrics = overview(a, b, order)
    return Comparison(as_metrics(metrics), conclusion(metrics, calls, tokens), card_diffs(a, b, order), phone_diffs(a, b))


def export_sheets(a: DataFrame, b: DataFrame, standard: DataFrame) -> dict[str, DataFrame]:
    """The deliverable of chain B: its phone rows b and the 14 figures that compare it with chain A's rows a."""
    return {fixed.PHONE_SHEET: b, fixed.STATS_SHEET: as_metrics(rule_and_llm(a, b, standard))}


def rule_and_llm(a: DataFrame, b: DataFrame, standard: DataFrame) -> DataFrame:
    """The 14 figures of an export as one row; the share is in whole tenths, half to even, 0 without cards."""
    key_person = F.coalesce(F.col("is_key_person").cast("boolean"), F.lit(False))
    rows_a = a.agg(F.count("*").alias("rule_pipeline_rows"))
    rows_b = b.agg(F.count("*").alias("llm_total_rows"), F.count_if(key_person).alias("llm_kp_rows"), F.count_if(~key_person).alias("llm_non_kp_rows"))
    phones = phone_metrics(phone_sides(a, b))
    # in whole numbers, so that a tie is one in every engine
    n_key, n = F.count_if(key_person), F.greatest(F.count("*"), F.lit(1))
    tenths, rest = ((n_key * 1000 - (n_key * 1000) % n) / n).cast("long"), 2 * ((n_key * 1000) % n)
    up = ((rest > n) | ((rest == n) & (tenths % 2 == 1))).cast("long")
    cards = standard.agg(
        F.count("*").alias("llm_cards_processed"), F.count_if(key_person).alias("llm_kp_cards"), F.count_if(~key_person).alias("llm_non_kp_cards"),
        ((tenths + up) / 10).alias("llm_kp_rate_pct"),
        F.count_if(F.size("mobiles") > 0).alias("llm_cards_with_mobile"),
    )
    return rows_a.crossJoin(rows_b).crossJoin(phones).crossJoin(cards)
