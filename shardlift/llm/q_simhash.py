"""Query of the SimHash near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardlift.llm.registry import query, table
from shardlift.llm.simhash import near_duplicates


@query()
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
