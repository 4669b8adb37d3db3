"""Request queries: allow-lists, creation plans, stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.operators import preflight
from shardlift.operators.documents import target_name
from shardlift.operators.requests import (
    allowed,
    in_movement,
    missing_names,
    template_requests,
    union_requests,
    with_decisions,
)
from shardlift.queries.registry import query, table, text

LISTS = {"template": ["hot ring", "old bolt", "no such", "hot ring"], "component_template": [], "index_template": None}


def part_templates(spark: SparkSession, folder: str) -> DataFrame:
    """part rows as one template each, kind by type, in the repository of its brand."""
    kind = (
        F.when(F.col("p_type").isin("SMALL", "LARGE"), "template")
        .when(F.col("p_type") == "MEDIUM", "component_template")
        .otherwise("index_template")
    )
    return table(spark, folder, "part").select(
        F.col("p_brand").alias("repo_id"),
        kind.alias("kind"),
        F.col("p_size").cast("int").alias("ord"),
        F.col("p_name").alias("name"),
        text("p_partkey").alias("body"),
        F.lit(None).cast("string").alias("problem"),
    )


_T = """
    SELECT p_brand AS repo_id, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 'template'
      WHEN p_type = 'MEDIUM' THEN 'component_template' ELSE 'index_template' END AS kind,
      CAST(p_size AS INTEGER) AS ord, p_name AS name, CAST(p_partkey AS VARCHAR) AS body FROM part
"""


@query(
    f"""
    SELECT repo_id, kind, CASE WHEN kind = 'index_template' THEN ord WHEN name = 'hot ring' THEN 0 ELSE 1 END AS ord,
           name, body
    FROM ({_T}) WHERE kind = 'index_template' OR (kind = 'template' AND name IN ('hot ring', 'old bolt'))
    """
)
def allow_list(spark: SparkSession, folder: str) -> DataFrame:
    """One kind with a list, one with an empty list, one with none."""
    return allowed(part_templates(spark, folder), LISTS).drop("problem")


@query(
    f"""
    WITH t AS ({_T}), r AS (SELECT DISTINCT repo_id FROM t),
    w AS (SELECT repo_id, 'template' AS kind, unnest(['hot ring', 'old bolt', 'no such']) AS name FROM r)
    SELECT repo_id, kind, name FROM w
    WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.repo_id = w.repo_id AND t.kind = w.kind AND t.name = w.name)
    """
)
def allow_missing(spark: SparkSession, folder: str) -> DataFrame:
    templates = part_templates(spark, folder)
    return missing_names(templates, templates, LISTS)


@query(
    """
    WITH w AS (
      SELECT CAST(c_custkey AS VARCHAR) AS name, unnest(['template', 'component_template', 'index_template', 'index'])
             AS kind FROM customer),
    s AS (SELECT CAST(o_custkey AS VARCHAR) AS name, CASE WHEN max(o_totalprice) > 400000 THEN 503 ELSE 200 END AS status
          FROM orders GROUP BY o_custkey)
    SELECT w.kind, w.name,
      CASE w.kind WHEN 'template' THEN '_template/' WHEN 'component_template' THEN '_component_template/'
                  WHEN 'index_template' THEN '_index_template/' ELSE '' END || w.name AS path,
      CASE WHEN s.status IS NULL THEN 'create' WHEN s.status = 200 THEN 'skip: already exists'
           ELSE 'skip: could not confirm' END AS decision,
      CAST(CASE w.kind WHEN 'template' THEN 0 WHEN 'component_template' THEN 1 WHEN 'index_template' THEN 2
                       ELSE 3 END AS INTEGER) AS stage
    FROM w LEFT JOIN s ON s.name = w.name AND w.kind IN ('index', 'template')
    """
)
def create_plan(spark: SparkSession, folder: str) -> DataFrame:
    """customer rows wanted as every kind of entity; customers with orders exist as indices and templates."""
    customers = table(spark, folder, "customer")
    kinds = ("template", "component_template", "index_template", "index")
    wanted = union_requests(
        *[
            customers.select(
                F.lit("r").alias("repo_id"),
                F.lit(kind).alias("kind"),
                F.lit(0).alias("ord"),
                text("c_custkey").alias("name"),
                F.lit("{}").alias("body"),
                F.lit(None).cast("string").alias("problem"),
            )
            for kind in kinds
        ]
    )
    status = F.when(F.max("o_totalprice") > 400000, 503).otherwise(200)
    state = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(status.alias("status"))
        .select(
            F.explode(F.array(F.lit("index"), F.lit("template"))).alias("kind"),
            text("o_custkey").alias("name"),
            "status",
        )
    )
    return with_decisions(template_requests(wanted), state).select("kind", "name", "path", "decision", "stage")


@query(
    """
    SELECT 'metadata' AS movement, event_id, event_type AS kind FROM events WHERE event_type <> 'view'
    UNION ALL SELECT 'data', event_id, 'document' FROM events WHERE event_type = 'view'
    UNION ALL SELECT 'everything', event_id, CASE event_type WHEN 'view' THEN 'document' ELSE event_type END FROM events
    """
)
def movements(spark: SparkSession, folder: str) -> DataFrame:
    """What each movement covers, views standing for documents."""
    rows = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") == "view", "document").otherwise(F.col("event_type")).alias("kind")
    )
    return union_requests(
        *[
            in_movement(rows, m).select(F.lit(m).alias("movement"), "event_id", "kind")
            for m in ("metadata", "data", "everything")
        ]
    )


@query(
    """
    SELECT min(p_brand) AS repo_id, 'target_collision' AS rule, p_name || '_reindexed' AS subject,
           count(*) || ' sources for one target' AS detail
    FROM part GROUP BY p_name HAVING count(*) > 1
    """
)
def target_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """part rows as indices of the repository of their brand, several with one name."""
    indices = table(spark, folder, "part").select(
        F.col("p_brand").alias("repo_id"), target_name(F.col("p_name")).alias("target_index")
    )
    return preflight.target_collisions(indices, ["target_index"], "target_collision")


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS repo_id, 'catalog_missing' AS rule, CAST(o_orderkey AS VARCHAR) AS subject,
           'no index-<n> file' AS detail
    FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    """
)
def catalog_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as repositories that are asked for; those with a returned line have a catalog."""
    asked = table(spark, folder, "orders").select(text("o_orderkey").alias("repo_id"))
    returned = table(spark, folder, "lineitem").where("l_returnflag = 'R'")
    return preflight.missing_catalogs(asked, returned.select(text("l_orderkey").alias("repo_id")).distinct())


@query(
    """
    WITH d AS (SELECT source AS repo_id, lang AS index_name, n_chars % 11 = 0 AS lost FROM documents),
    known AS (SELECT DISTINCT repo_id FROM d WHERE repo_id NOT IN ('src1', 'src2')),
    plan AS (SELECT repo_id, unnest(['en', 'fr', 'xx']) AS index_name FROM known)
    SELECT repo_id, 'document_repository' AS rule, repo_id AS subject,
           count(*) || ' documents of an unknown repository' AS detail
    FROM d WHERE repo_id NOT IN (SELECT repo_id FROM known) GROUP BY repo_id
    UNION ALL
    SELECT repo_id, 'index_without_documents', index_name, 'no documents'
    FROM plan WHERE (repo_id, index_name) NOT IN (SELECT (repo_id, index_name) FROM d)
    UNION ALL
    SELECT repo_id, 'document_order', index_name, sum(lost::INT) || ' documents without shard or order'
    FROM d GROUP BY repo_id, index_name HAVING sum(lost::INT) > 0
    """
)
def doc_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """documents by source as repository and language as index, against a plan that leaves two sources out."""
    docs = table(spark, folder, "documents").select(
        F.col("source").alias("repo_id"),
        F.col("lang").alias("index"),
        F.when(F.col("n_chars") % 11 != 0, 0).alias("shard"),
        F.col("doc_id").alias("ord"),
    )
    known = docs.select("repo_id").distinct().where("repo_id not in ('src1', 'src2')")
    plan = known.withColumn("index", F.explode(F.array(F.lit("en"), F.lit("fr"), F.lit("xx"))))
    return preflight.document_coverage(docs, plan, known)
