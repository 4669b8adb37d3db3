"""Query of the mixing of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.llm.mixing import mix
from shardlift.llm.registry import query, table


@query()
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )
