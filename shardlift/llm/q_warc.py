"""Query of the WARC archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardlift.llm.registry import query, table
from shardlift.llm.warc import read_warc, write_warc

_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query(_SQL)
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = write_warc(table(spark, folder, "pages"))
    read = read_warc(index, content=False).where("last")
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
