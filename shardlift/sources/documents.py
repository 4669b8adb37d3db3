"""Document tables: one row per stored document, partitioned by index and shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.schemas import DOCUMENT


def read_documents(
    spark: SparkSession, path: str, index: str | None = None, shard: int | None = None
) -> DataFrame:
    """Documents of a table; naming an index or shard prunes to its partitions."""
    table = spark.read.parquet(path)
    absent = [n for n in DOCUMENT.names if n not in table.columns]
    if absent:
        raise ValueError(f"document table lacks columns: {', '.join(absent)}")
    # Partition values come back with inferred types.
    table = table.withColumns({"index": F.col("index").cast("string"), "shard": F.col("shard").cast("int")})
    if index is not None:
        table = table.where(F.col("index") == index)
    if shard is not None:
        table = table.where(F.col("shard") == shard)
    return table
