"""From raw documents to encoded training text: five stages, each written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.llm.encoding import encode
from shardlift.llm.mixing import mix
from shardlift.llm.rules import quality_rules
from shardlift.llm.simhash import one_of_each
from shardlift.llm.toxicity import learn, score, training_rows
from shardlift.shared import write_shared

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

MODEL = "piece_bpe_32k.model"
# Scores from here on are toxic.
TOXIC = 0.5

# Token ids come from a vocabulary file and fingerprints from a hash that SQL does not have.
ORACLE_SQL = None


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and their host's verdict keep."""
    return quality_rules(docs).where("kept").select(docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a lexicon learned from the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score(docs, learn(training_rows(docs, labels)))
    return scored.where(F.col("score") < TOXIC).select(docs.columns)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mixed = mix(docs).where("copies > 0")
    again = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return again.select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the token ids of their texts, an end id last."""
    return encode(docs, public_tokenizers.path(MODEL))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", rules),
    ("toxicity", toxicity),
    ("simhash_dedup", dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), name)
    return docs
