"""Query of the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardlift.llm.registry import query, table
from shardlift.llm.rules import judge_ids

_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), c AS (
  SELECT doc_id, source, words, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), w AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM c WHERE len(words) >= 3)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM w) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), b AS (
  SELECT c.doc_id, source, n_words, word_chars, n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM c LEFT JOIN rep USING (doc_id)
), f AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM b
), h AS (
  SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS failed FROM f GROUP BY source
), m AS (
  SELECT sum(failed) / sum(n) AS mean, sum(failed * failed / n) / sum(n) - (sum(failed) / sum(n)) ** 2 AS var FROM h
), v AS (
  SELECT source,
         CASE WHEN var <= 1e-12 THEN mean
              ELSE (failed + mean * greatest(0, mean * (1 - mean) / var - 1))
                   / (n + greatest(0, mean * (1 - mean) / var - 1)) END AS rate
  FROM h, m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND NOT rate > 0.5) AS kept
FROM f LEFT JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""


@query(_SQL)
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge_ids(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
