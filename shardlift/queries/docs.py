"""Document queries: ids, live documents, last write, bulk rows, results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.functions.ids import decode_id, source_text
from shardlift.functions.paths import document_path
from shardlift.operators.documents import (
    bulk_rows,
    decoded,
    last_write_wins,
    live,
    route,
    target_name,
)
from shardlift.operators.report import document_fields
from shardlift.queries.registry import encoded_bytes, encoded_number, encoded_text, query, table
from shardlift.shared import shared_folder
from shardlift.sinks.bulk import write_ndjson
from shardlift.sinks.transport import with_outcome
from shardlift.sources.documents import read_documents


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """documents as a document table: index by language, raw id from the text, no source where labels say so."""
    body = F.encode("text", "UTF-8")
    return (
        table(spark, folder, "documents")
        .join(table(spark, folder, "labels"), "doc_id", "left")
        .select(
            F.col("lang").alias("index"),
            (F.col("n_chars") % 5).cast("int").alias("shard"),
            F.col("doc_id").alias("ord"),
            encoded_bytes(F.unhex(F.md5("text"))).alias("_id"),
            F.when(F.col("toxic") == 1, F.lit(None))
            .when(F.col("quality") == 0, F.unhex(F.lit("")))
            .otherwise(body)
            .alias("_source"),
        )
    )


_LABELLED = """
    SELECT d.lang AS index_name, CAST(d.n_chars % 5 AS INTEGER) AS shard, d.doc_id AS ord, d.text,
           rtrim(translate(to_base64(unhex(md5(d.text))), '+/', '-_'), '=') AS id,
           coalesce(l.toxic = 1, false) OR coalesce(l.quality = 0, false) AS gone
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


@query(
    """
    SELECT doc_id, length(id) AS id_length, md5(id) AS id_md5 FROM (
      SELECT doc_id, CASE lang
        WHEN 'en' THEN CAST(doc_id AS VARCHAR)
        WHEN 'fr' THEN source || '/' || CAST(doc_id AS VARCHAR)
        WHEN 'de' THEN rtrim(translate(to_base64(unhex(md5(text))), '+/', '-_'), '=')
        ELSE rtrim(translate(to_base64(encode(text)), '+/', '-_'), '=') END AS id
      FROM documents)
    """
)
def doc_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all three stored forms back to text, whole texts as raw ids among them."""
    lang = F.col("lang")
    stored = (
        F.when(lang == "en", encoded_number(F.col("doc_id")))
        .when(lang == "fr", encoded_text(F.concat_ws("/", "source", F.col("doc_id").cast("string"))))
        .when(lang == "de", encoded_bytes(F.unhex(F.md5("text"))))
        .otherwise(encoded_bytes(F.encode("text", "UTF-8")))
    )
    return (
        table(spark, folder, "documents")
        .select("doc_id", decode_id(stored).alias("id"))
        .select(
            "doc_id", F.length("id").cast("bigint").alias("id_length"), F.md5("id").alias("id_md5")
        )
    )


@query(
    f"""
    SELECT ord AS doc_id, index_name, md5(text) AS source_md5, length(text) AS source_length
    FROM ({_LABELLED}) WHERE NOT gone
    """
)
def doc_live(spark: SparkSession, folder: str) -> DataFrame:
    source = source_text(F.col("_source"))
    return live(labelled_documents(spark, folder)).select(
        F.col("ord").alias("doc_id"),
        F.col("index").alias("index_name"),
        F.md5(source).alias("source_md5"),
        F.length(source).cast("bigint").alias("source_length"),
    )


def event_documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_type").alias("index"),
        (F.col("event_id") % 5).cast("int").alias("shard"),
        F.col("event_id").alias("ord"),
        encoded_number(F.col("user_id")).alias("_id"),
        F.encode("props", "UTF-8").alias("_source"),
    )


@query(
    """
    SELECT event_type || '_reindexed' AS target_index, CAST(user_id AS VARCHAR) AS id,
           CAST(event_id % 5 AS INTEGER) AS shard, event_id AS ord, props AS source
    FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id % 5 DESC, event_id DESC) = 1
    """
)
def doc_upsert(spark: SparkSession, folder: str) -> DataFrame:
    docs = decoded(event_documents(spark, folder)).withColumn("target_index", target_name(F.col("index")))
    last = last_write_wins(docs, shared=True)
    return last.select("target_index", "id", "shard", "ord", "source")


@query(
    f"""
    SELECT index_name || '_reindexed' AS target_index, id, shard, ord,
           '{{"index":{{"_index":"' || index_name || '_reindexed","_id":"' || id || '"}}}}' AS action,
           md5(translate(text, chr(13) || chr(10), '  ')) AS source_md5
    FROM ({_LABELLED}) WHERE NOT gone
    QUALIFY row_number() OVER (PARTITION BY index_name, id ORDER BY shard DESC, ord DESC) = 1
    """
)
def doc_bulk(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that would be written, under which id, in which index."""
    docs = decoded(live(labelled_documents(spark, folder)))
    last = last_write_wins(docs.withColumn("target_index", target_name(F.col("index"))), shared=True)
    return bulk_rows(last).select(
        "target_index", "id", "shard", "ord", "action", F.md5("source").alias("source_md5")
    )


@query(
    f"""
    WITH w AS (
      SELECT index_name, id, translate(text, chr(13) || chr(10), '  ') AS source FROM ({_LABELLED}) WHERE NOT gone
      QUALIFY row_number() OVER (PARTITION BY index_name, id ORDER BY shard DESC, ord DESC) = 1)
    SELECT md5('{{"index":{{"_index":"' || index_name || '_reindexed","_id":"' || id || '"}}}}') AS line_md5 FROM w
    UNION ALL SELECT md5(source) FROM w
    """
)
def bulk_files(spark: SparkSession, folder: str) -> DataFrame:
    """A stored document table read back, its last writes written as bulk files, and the lines of the files."""
    base = f"{shared_folder(spark)}/bulk-{uuid.uuid4().hex}"
    labelled_documents(spark, folder).write.partitionBy("index", "shard").parquet(f"{base}/documents")
    docs = decoded(live(read_documents(spark, f"{base}/documents")))
    last = last_write_wins(docs.withColumn("target_index", target_name(F.col("index"))), shared=True)
    write_ndjson(bulk_rows(last), f"{base}/bulk")
    return spark.read.text(f"{base}/bulk").select(F.md5("value").alias("line_md5"))


@query(
    """
    SELECT e.event_id AS ord, p.p_brand || '_reindexed' AS target_index
    FROM events e JOIN part p ON e.user_id = p.p_partkey
    """
)
def doc_route(spark: SparkSession, folder: str) -> DataFrame:
    """Documents joined to a plan of indices; those of unplanned indices are left out."""
    plan = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("index"), target_name(F.col("p_brand")).alias("target_index")
    )
    docs = table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("index"), F.col("event_id").alias("ord")
    )
    return route(docs, plan, ["index"]).select("ord", "target_index")


@query(
    """
    SELECT o_orderkey, 'orders/_doc/' || CAST(o_orderkey AS VARCHAR) || '%2F'
           || replace(o_orderpriority, ' ', '%20') AS path
    FROM orders
    """
)
def doc_paths(spark: SparkSession, folder: str) -> DataFrame:
    doc_id = F.concat_ws("/", F.col("o_orderkey").cast("string"), "o_orderpriority")
    return table(spark, folder, "orders").select(
        "o_orderkey", document_path(F.lit("orders"), doc_id).alias("path")
    )


@query(
    """
    SELECT event_id, status, CASE WHEN status IN (200, 201) THEN 'ok' ELSE 'error' END AS outcome,
           CASE WHEN status IN (200, 201) THEN 'debug' ELSE 'error' END AS level
    FROM (SELECT event_id, CAST(CASE WHEN value < 20 THEN 201 WHEN value < 60 THEN 200
                                     WHEN value < 90 THEN 404 ELSE 503 END AS INTEGER) AS status FROM events)
    """
)
def results(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    status = F.when(value < 20, 201).when(value < 60, 200).when(value < 90, 404).otherwise(503)
    return with_outcome(table(spark, folder, "events").select("event_id", status.alias("status")))


@query(
    f"""
    WITH d AS ({_LABELLED})
    SELECT index_name, shard, ord, 'deleted' AS field, md5(id) AS value_md5 FROM d WHERE gone
    UNION ALL SELECT index_name, shard, ord, '_id', md5(id) FROM d WHERE NOT gone
    UNION ALL SELECT index_name, shard, ord, '_source', md5(text) FROM d WHERE NOT gone
    UNION ALL SELECT index_name, shard, ord, '_routing', NULL FROM d WHERE NOT gone AND shard > 2
    """
)
def report_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = labelled_documents(spark, folder).withColumn(
        "_routing", F.when(F.col("shard") > 2, F.col("index"))
    )
    return document_fields(docs).select(
        F.col("index").alias("index_name"), "shard", "ord", "field", F.md5("value").alias("value_md5")
    )
