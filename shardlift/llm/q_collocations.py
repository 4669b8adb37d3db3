"""Query of the phrase mining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardlift.llm.collocations import collocations
from shardlift.llm.registry import query, table

_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM p
), g AS (
  SELECT lang, d, words[i:i + d - 1] AS g
  FROM (SELECT lang, words, d, unnest(range(1, len(words) - d + 2)) AS i
        FROM w, (SELECT unnest([1, 2, 3]) AS d) WHERE len(words) >= d)
), f AS (
  SELECT lang, d, g, count(*) AS n FROM g GROUP BY lang, d, g
), t AS (
  SELECT lang, sum(n)::BIGINT AS total FROM f WHERE d = 1 GROUP BY lang
), k AS (
  SELECT f.lang, f.g, f.d, f.n AS a, k, l.n AS l, r.n AS r,
         ((1000000::HUGEINT * f.n * f.n) // (l.n::HUGEINT * r.n))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, d)) AS k FROM f WHERE d > 1 AND n >= 10) f
  JOIN f l ON l.lang = f.lang AND l.g = f.g[1:k] JOIN f r ON r.lang = f.lang AND r.g = f.g[k + 1:]
), c AS (
  SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), around AS (
  SELECT lang, g[1:2] AS g, n FROM f WHERE d = 3 AND n >= 10
  UNION ALL SELECT lang, g[2:3], n FROM f WHERE d = 3 AND n >= 10
), most AS (
  SELECT lang, g, max(n) AS n FROM around GROUP BY lang, g
), kept AS (
  SELECT c.lang, array_to_string(c.g, ' ') AS phrase, a, l, r, score
  FROM c LEFT JOIN most USING (lang, g) WHERE most.n IS NULL OR 100 * most.n < 50 * a
)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, total AS n, score
FROM kept JOIN t ON t.lang = kept.lang
QUALIFY rank <= 2000
"""


@query(_SQL)
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))
