"""Catalog queries: every order is a repository, its customer and order keys name snapshots and indices."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.functions import paths
from shardlift.functions.versions import version_of
from shardlift.operators import preflight, report
from shardlift.operators.catalog import index_file_ids, indices_in_snapshot, list_snapshots, snapshot_id
from shardlift.operators.files import shard_rows
from shardlift.operators.report import index_summary
from shardlift.queries.registry import query, table, text
from shardlift.shared import shared_folder, write_shared
from shardlift.sinks.files import write_blobs
from shardlift.sources.catalog import parse_catalog, read_catalog
from shardlift.sources.metadata import (
    index_bodies,
    index_metadata_of,
    parse_shards,
    parse_snapshots,
    shard_manifests_of,
)


def order_catalogs(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """Catalog JSON per order: a snapshot named by status, one named by priority; two indices.

    The customer's index is in both snapshots, the order's own only in the first.
    """
    key, cust = text("o_orderkey"), text("o_custkey")
    first, second = F.concat(F.lit("s1-"), key), F.concat(F.lit("s2-"), key)
    mine, common = F.concat(F.lit("i-"), key), F.concat(F.lit("c-"), cust)
    if version == "6.8":
        value = F.format_string(
            '{"snapshots":[{"name":"%s","uuid":"%s","state":1},{"name":"%s","uuid":"%s","state":1}],'
            '"indices":{"order":{"id":"%s","snapshots":["%s"]},"customer":{"id":"%s","snapshots":["%s","%s"]}}}',
            F.col("o_orderstatus"), first, F.col("o_orderpriority"), second,
            mine, first, common, first, second,
        )
    else:
        value = F.format_string(
            '{"snapshots":[{"name":"%s","uuid":"%s","state":1,"version":"7.10.2",'
            '"index_metadata_lookup":{"%s":"k1","%s":"k2"}},{"name":"%s","uuid":"%s","state":1,"version":"7.10.2",'
            '"index_metadata_lookup":{"%s":"k2"}}],"indices":{"order":{"id":"%s","snapshots":["%s"],'
            '"shard_generations":["g"]},"customer":{"id":"%s","snapshots":["%s","%s"],"shard_generations":["g"]}},'
            '"min_version":"7.9.0","index_metadata_identifiers":{"k2":"f-%s","k1":"f-%s"}}',
            F.col("o_orderstatus"), first, mine, common, F.col("o_orderpriority"), second, common,
            mine, first, common, first, second, common, mine,
        )
    return parse_catalog(table(spark, folder, "orders").select(key.alias("repo_id"), value.alias("value")), version)


def stored_catalogs(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogs of 7.10 that two sides of a lookup read: parsed once, as a migration does."""
    return write_shared(order_catalogs(spark, folder, "7.10").drop("malformed", "unknown"), "catalog")


_HELD = """
    WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS VARCHAR) AS c,
                      o_orderstatus AS st, o_orderpriority AS pr FROM orders)
"""


@query(
    _HELD
    + """
    SELECT k AS repo_id, 's1-' || k AS snapshot_id, 0 AS pos, 'order' AS index_name, 'i-' || k AS index_id,
           's1-' || k AS file_id FROM o WHERE st = 'F'
    UNION ALL SELECT k, 's1-' || k, 1, 'customer', 'c-' || c, 's1-' || k FROM o WHERE st = 'F'
    """
)
def catalog_6_8(spark: SparkSession, folder: str) -> DataFrame:
    """Indices of the snapshot called F; repositories without one give nothing."""
    return indices_in_snapshot(order_catalogs(spark, folder, "6.8"), "F", "6.8")


@query(
    _HELD
    + """
    SELECT k AS repo_id, 'snapshot_missing' AS rule, 'F' AS subject,
           'snapshot not found, nothing is moved' AS detail FROM o WHERE st <> 'F' AND pr <> 'F'
    """
)
def snapshot_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Repositories that have no snapshot called F."""
    catalog = order_catalogs(spark, folder, "6.8")
    return preflight.missing_snapshots(catalog.select("repo_id", snapshot_id("F").alias("snapshot_id")), "F")


@query(
    _HELD
    + """
    SELECT k AS repo_id, 's2-' || k AS snapshot_id, 0 AS pos, 'customer' AS index_name, 'c-' || c AS index_id,
           'f-c-' || c AS file_id FROM o WHERE pr = '1-URGENT'
    """
)
def catalog_7_10(spark: SparkSession, folder: str) -> DataFrame:
    """Indices of the snapshot called 1-URGENT, with the file of their metadata."""
    return indices_in_snapshot(order_catalogs(spark, folder, "7.10"), "1-URGENT", "7.10")


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS repo_id, index_name, o_orderpriority AS snapshot_name,
      CASE index_name WHEN 'order' THEN 'i-' || CAST(o_orderkey AS VARCHAR)
                      WHEN 'customer' THEN 'c-' || CAST(o_custkey AS VARCHAR) END AS index_id,
      CASE index_name WHEN 'customer' THEN 'f-c-' || CAST(o_custkey AS VARCHAR) END AS file_id
    FROM (SELECT *, unnest(['order', 'customer', 'absent']) AS index_name FROM orders)
    """
)
def catalog_lookups(spark: SparkSession, folder: str) -> DataFrame:
    """Index and file ids asked by name; an index outside the snapshot has an id but no file."""
    names = F.array(*[F.lit(n) for n in ("order", "customer", "absent")])
    wanted = table(spark, folder, "orders").select(
        text("o_orderkey").alias("repo_id"),
        F.col("o_orderpriority").alias("snapshot_name"),
        F.explode(names).alias("index_name"),
    )
    return index_file_ids(wanted, stored_catalogs(spark, folder), "7.10").select(
        "repo_id", "index_name", "snapshot_name", "index_id", "file_id"
    )


@query(
    _HELD
    + """
    SELECT k AS repo_id, 0 AS pos, st AS snapshot_name, 's1-' || k AS snapshot_id FROM o
    UNION ALL SELECT k, 1, pr, 's2-' || k FROM o
    """
)
def report_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return list_snapshots(order_catalogs(spark, folder, "6.8"))


_ALL_HELD = (
    _HELD
    + """
    SELECT k AS repo_id, st AS snapshot_name, 's1-' || k AS snapshot_id, 'order' AS index_name,
           'i-' || k AS index_id FROM o
    UNION ALL SELECT k, st, 's1-' || k, 'customer', 'c-' || c FROM o
    UNION ALL SELECT k, pr, 's2-' || k, 'customer', 'c-' || c FROM o
    """
)


@query(_ALL_HELD)
def report_indices_6_8(spark: SparkSession, folder: str) -> DataFrame:
    return report.snapshot_indices(order_catalogs(spark, folder, "6.8"), "6.8")


@query(_ALL_HELD)
def report_indices_7_10(spark: SparkSession, folder: str) -> DataFrame:
    return report.snapshot_indices(order_catalogs(spark, folder, "7.10"), "7.10")


def order_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot records by order: state and version by status and priority, an odd key for large orders."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    value = F.format_string(
        '{"snapshot":{"name":"n%s","uuid":"u","version_id":%s,"indices":["a","b"],"state":"%s","reason":null,'
        '"include_global_state":%s,"start_time":1,"end_time":2,"total_shards":%s,"successful_shards":1,'
        '"failures":[]%s}}',
        text("o_orderkey"),
        F.when(priority == "1-URGENT", "6082499").when(priority == "2-HIGH", "2110099").otherwise("7100299"),
        F.when(status == "F", "SUCCESS").when(status == "O", "PARTIAL").otherwise("FAILED"),
        F.when(priority == "5-LOW", "false").otherwise("true"),
        text("o_custkey"),
        F.when(F.col("o_totalprice") > 400000, ',"odd":1').otherwise(""),
    )
    texts = table(spark, folder, "orders").select(text("o_orderkey").alias("repo_id"), value.alias("value"))
    return parse_snapshots(texts, "7.10")


@query(
    """
    WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS repo_id, 'n' || CAST(o_orderkey AS VARCHAR) AS subject,
                      o_orderstatus AS st, o_orderpriority AS pr, o_totalprice AS price FROM orders)
    SELECT repo_id, 'snapshot_state' AS rule, subject, CASE st WHEN 'O' THEN 'PARTIAL' ELSE 'FAILED' END AS detail
    FROM o WHERE st <> 'F'
    UNION ALL SELECT repo_id, 'snapshot_version', subject, CASE pr WHEN '1-URGENT' THEN '6082499' ELSE '2110099' END
    FROM o WHERE pr IN ('1-URGENT', '2-HIGH')
    UNION ALL SELECT repo_id, 'global_state', subject, 'snapshot has no global state' FROM o WHERE pr = '5-LOW'
    UNION ALL SELECT repo_id, 'unknown_keys', subject, 'odd' FROM o WHERE price > 400000
    """
)
def preflight_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    rules = preflight.snapshot_rules("7.10", "everything")
    return preflight.check(order_snapshots(spark, folder), F.col("name"), rules)


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS repo_id, 'one_snapshot' AS rule, 'catalog' AS subject,
           '2 snapshots' AS detail FROM orders
    """
)
def preflight_catalogs(spark: SparkSession, folder: str) -> DataFrame:
    catalogs = order_catalogs(spark, folder, "7.10")
    return preflight.check(catalogs, F.lit("catalog"), preflight.catalog_rules())


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS repo_id, 'n' || CAST(o_orderkey AS VARCHAR) AS name,
      CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'PARTIAL' ELSE 'FAILED' END AS state,
      CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 6082499 WHEN '2-HIGH' THEN 2110099 ELSE 7100299 END AS INTEGER)
        AS version_id,
      CASE o_orderpriority WHEN '1-URGENT' THEN '6.8' WHEN '2-HIGH' THEN NULL ELSE '7.10' END AS version,
      'a,b' AS indices, CAST(o_custkey AS INTEGER) AS total_shards, CAST(1 AS INTEGER) AS successful_shards
    FROM orders
    """
)
def report_summary(spark: SparkSession, folder: str) -> DataFrame:
    return report.snapshot_summary(order_snapshots(spark, folder)).select(
        "repo_id",
        "name",
        "state",
        "version_id",
        version_of(F.col("version_id")).alias("version"),
        F.array_join("indices", ",").alias("indices"),
        "total_shards",
        "successful_shards",
    )


@query(
    """
    SELECT s_nationkey, s_suppkey, CAST(unnest(range(1 + s_suppkey % 2)) AS INTEGER) AS shard,
           CAST(1 + s_suppkey % 2 AS INTEGER) AS n_shards, CAST(round(s_acctbal * 100) AS BIGINT) AS total_size
    FROM supplier
    """
)
def metadata_read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as indices of their nation's repository: files written, found through the catalogs and read by path."""
    root = f"{shared_folder(spark)}/nations-{uuid.uuid4().hex}"
    suppliers = table(spark, folder, "supplier").select(
        F.concat_ws("/", F.lit(root), text("s_nationkey")).alias("repo"),
        text("s_suppkey").alias("name"),
        (F.col("s_suppkey") % 2 + 1).cast("int").alias("n_shards"),
        F.round(F.col("s_acctbal") * 100).cast("bigint").alias("cents"),
    )
    # A catalog holds all indices of its repository, as in any snapshot.
    member = F.format_string('"%s":{"id":"%s","snapshots":["s"]}', "name", "name")
    catalogs = suppliers.groupBy("repo").agg(F.array_join(F.collect_list(member), ",").alias("members"))
    body = F.concat(
        F.lit('{"snapshots":[{"name":"nightly","uuid":"s","state":1}],"indices":{'), F.col("members"), F.lit("}}")
    )
    write_blobs(
        catalogs.select(F.concat("repo", F.lit("/index-7")).alias("path"), F.encode(body, "UTF-8").alias("content"))
    )
    described = F.format_string(
        '{"%s":{"settings":{"index.number_of_shards":"%s"},"mappings":[],"aliases":{}}}', "name", text("n_shards")
    )
    path = paths.index_metadata_path(F.col("repo"), F.col("name"), F.lit("s"), ".json")
    write_blobs(suppliers.select(path.alias("path"), F.encode(described, "UTF-8").alias("content")))
    shards = shard_rows(suppliers)
    manifest = F.format_string(
        '{"name":"n","index_version":1,"start_time":1,"time":1,"number_of_files":0,"total_size":%s,"files":[]}', text("cents")
    )
    path = paths.shard_path(F.col("repo"), F.lit("s"), F.col("name"), F.col("shard"), ".json")
    write_blobs(shards.select(path.alias("path"), F.encode(manifest, "UTF-8").alias("content")))

    # A row for each nation, of which there is a fixed number.
    roots = [f"{root}/{r[0]}" for r in table(spark, folder, "nation").select("n_nationkey").collect()]
    held = write_shared(indices_in_snapshot(read_catalog(spark, roots, "6.8"), "nightly", "6.8"), "held")
    indices = write_shared(index_summary(index_bodies(index_metadata_of(held))), "indices")
    wanted = shard_rows(indices.select("repo_id", "snapshot_id", "index_id", "n_shards"))
    found = parse_shards(shard_manifests_of(wanted))
    nation = F.regexp_extract("repo_id", "([^/]+)$", 1).cast("int")
    return found.select(
        nation.alias("s_nationkey"),
        F.col("index_id").cast("bigint").alias("s_suppkey"),
        "shard",
        "n_shards",
        "total_size",
    )
