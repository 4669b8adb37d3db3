"""Query of the embedding near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardlift.llm.multiindex import near_vectors
from shardlift.llm.registry import query, table


_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), r(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (
  SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a
), n AS (
  SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a
)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN n ON n.vec_id = e.vec_id LEFT JOIN c ON c.vec_id = e.vec_id
"""


@query(_SQL)
def op8_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))
