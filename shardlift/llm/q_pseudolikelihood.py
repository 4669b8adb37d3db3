"""Query of the language-model scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardlift.llm.pseudolikelihood import learn_and_score
from shardlift.llm.registry import query, table


@query()
def op9_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return learn_and_score(docs, keep_text=False).select("doc_id", "n_words", "log_likelihood", "per_word")
