"""Query of the main texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardlift.llm.registry import query, table
from shardlift.llm.styletree import extract


@query()
def op12_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")
