"""Query of the token counts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.llm.prefixes import longest_prefix, prefix_counts
from shardlift.llm.registry import query, table
from shardlift.shared import write_shared

MODEL = "piece_bpe_32k.model"
LIMIT = 4096


@query()
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = prefix_counts(docs, public_tokenizers.path(MODEL), budget=LIMIT)
    stored = write_shared(counted.select("doc_id", "n_bytes", "steps"), "prefixes")
    return longest_prefix(stored, LIMIT, total="n_tokens").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "fits_chars"
    )
