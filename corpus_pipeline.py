"""The corpus pipeline: toxicity, quality, near copies, secrets, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm import packing, quality, secrets, simhash, toxicity
from cardloom.llm.runtime import settle, table


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    model = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(model, F.col("text")) < toxicity.LEAST_SCORE)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as low quality go."""
    model = quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(quality.score(model, F.col("text")) >= quality.LEAST_SCORE)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.near_copies_dropped(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts become a mark; n_chars follows the text."""
    return secrets.redacted(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of training length, a row per piece of a document."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", not_toxic),
    ("quality", good_quality),
    ("near_copies", one_of_near_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]
#: Learned scores and a tokenizer are nothing that SQL can express; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
