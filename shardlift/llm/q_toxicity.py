"""Query of the toxicity scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.llm.registry import query, table
from shardlift.llm.toxicity import held_out, learn, score, training_rows


@query()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    lexicon = learn(training_rows(docs, table(spark, folder, "labels")))
    return score(docs, lexicon).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits"
    )
