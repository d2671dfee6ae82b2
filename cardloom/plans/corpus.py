"""A card corpus derived from the driver's tables, the same in Spark and in the oracle's SQL.

Every customer is a card; its region is its partition.  Chain A reads the phones as
they are, chain B drops, blanks or changes some by rule.  The text of each view is
plain SQL that both engines read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_NUMBER = "concat('1', cast(3 + c_custkey % 7 as {text}), lpad(cast({key} % 1000000000 as {text}), 9, '0'))"


def cards_sql(text: str = "string") -> str:
    """Cards: source_label, file, page, card_no, ord, name, company, phones."""
    first, second = (_NUMBER.format(text=text, key=k) for k in ("(c_custkey * 7919)", "(c_custkey * 104729 + 17)"))
    return f"""
    SELECT concat('P', cast(n_regionkey as {text})) AS source_label, concat('f', cast(c_nationkey as {text}), '.pdf') AS file,
        cast(floor(c_custkey / 6) as bigint) AS page, cast(c_custkey % 6 + 1 as bigint) AS card_no, cast(c_custkey as bigint) AS ord,
        CASE WHEN c_custkey % 13 = 0 THEN '' ELSE c_name END AS name, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat(c_mktsegment, ' Co., Ltd') END AS company,
        CASE WHEN c_custkey % 11 = 0 THEN ''
            WHEN c_custkey % 5 = 0 THEN concat('+86 ', {first}, ' / 0086', {second}, '; ', {first})
            WHEN c_custkey % 29 = 0 THEN concat('+86-', {first}, ',', {first})
            ELSE concat('86', {first}) END AS phones,
        c_acctbal
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def answers_sql(text: str = "string") -> str:
    """Chain B's answers: the cards with rules for what is missing, blank or different."""
    other = _NUMBER.format(text=text, key="(c_custkey * 31 + 5)").replace("c_custkey", "ord")
    return f"""
    SELECT source_label, file, page, card_no, ord, CASE WHEN ord % 9 = 0 THEN '***' ELSE name END AS name, 'Sales' AS title,
        CASE WHEN ord % 8 = 0 THEN 'www.x.com' ELSE company END AS company, 'x' AS address, CASE WHEN ord % 4 = 0 THEN 'Manager' ELSE '' END AS kp_role,
        CASE WHEN ord % 17 = 0 THEN '' WHEN ord % 23 = 0 THEN {other} ELSE phones END AS mobiles, c_acctbal > 0 AS is_key_person
    FROM ({cards_sql(text)}) cards WHERE ord % 19 <> 0"""


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, cards_sql())


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, answers_sql())


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(
        text.replace("FROM customer JOIN nation", "FROM {customer} AS customer JOIN {nation} AS nation"),
        customer=table(spark, sf_dir, "customer"), nation=table(spark, sf_dir, "nation"),
    )
