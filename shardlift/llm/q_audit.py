"""Query of the filter audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardlift.llm.audit import audit, failure_counts
from shardlift.llm.registry import query, table
from shardlift.shared import write_shared

_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), m AS (
  SELECT doc_id, part,
         (len(words) < 200)::INT
         + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask
  FROM d
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), c AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask
), f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS b
), o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.b | b.b | c.b | d.b | e.b = 31
), s AS (
  SELECT filter_order, i AS step, bits[i] AS own, coalesce(list_sum(bits[1:i - 1]), 0)::INT AS earlier
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS i)
), r AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN mask & (earlier | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & own <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & own <> 0 AND mask & earlier = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""


@query(_SQL)
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    counts = failure_counts(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return audit(write_shared(counts, "coalitions"))
