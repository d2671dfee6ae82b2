"""Phone rows of the two chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cleaned, joined, mobiles, model_tag, truthy
from ..schemas import PHONE_ROW_B


def contacts(cards: DataFrame) -> DataFrame:
    """Flat projection of cards: arrays as text separated by semicolons, other columns of cards unchanged."""
    fields = [F.col(f"extracted.{c}").alias(c) for c in ("name", "company", "title")]
    lists = [joined(F.col(f"extracted.{c}")).alias(c) for c in ("phones", "emails", "websites", "wechat_ids", "qq_ids")]
    kept = [c for c in cards.columns if c not in ("line_texts", "extracted", "name", "company", "title", "phones", "emails", "websites", "wechat_ids", "qq_ids", "address")]
    return cards.select(*kept, *fields, *lists, F.col("extracted.address").alias("address"))


def phone_rows(contacts: DataFrame, phones: str = "phones", out: str = "phone_normalized") -> DataFrame:
    """Chain A: one row per card and mobile; cards without a mobile are dropped, null phones count as none."""
    kept = [c for c in contacts.columns if c != out]
    return contacts.select(*kept, F.explode(mobiles(phones)).alias(out))


def phone_rows_outer(standard: DataFrame, default_model: str = "") -> DataFrame:
    """Chain B: one row per card and mobile; cards without a mobile are kept with an empty one.

    ``standard`` has the columns of schemas.STANDARD; the result those of schemas.PHONE_ROW_B.
    """
    model = F.coalesce(F.nullif(F.col("llm_model"), F.lit("")), F.lit(default_model))
    rows = standard.select("*", F.explode_outer("mobiles").alias("_mobile")).withColumns(
        {
            "phone_normalized": F.coalesce("_mobile", F.lit("")),
            "is_key_person": F.coalesce("is_key_person", F.lit(False)),
            "pipeline": model_tag(model),
        }
    )
    return rows.select(*PHONE_ROW_B)


def standardised(answer: Column | str) -> dict[str, Column]:
    """Columns of a standardised card from the fields of an answer.

    ``answer`` is a struct of name, title, company, address, kp_role, mobiles
    (array<string>) and is_key_person (JSON text).  Mobiles are taken from each string as
    it is, so one that is spaced is lost; that is how the chain is defined.
    """
    own = F.col(answer) if isinstance(answer, str) else answer
    fields = {f"{c}_std": cleaned(own[c]) for c in ("name", "title", "company", "address")}
    return fields | {"mobiles": mobiles(joined(own["mobiles"])), "is_key_person": truthy(own["is_key_person"]), "kp_role": cleaned(own["kp_role"])}
