"""Query of the encoding and decoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.llm.encoding import encode, ids_digest
from shardlift.llm.registry import query, table

MODEL = "piece_bpe_32k.model"


@query()
def op3_encoding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = encode(docs, public_tokenizers.path(MODEL), decoded="decoded")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        ids_digest().alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
