"""File queries: parts, blobs, reassembly, containers, paths, manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.fixed import UNLIMITED_PART_SIZE
from shardlift.functions import paths
from shardlift.functions.paths import generation
from shardlift.operators.files import (
    concat_parts,
    file_parts,
    file_rules,
    inline_chunks,
    join_blobs,
    reconciled,
    shard_rows,
)
from shardlift.operators.preflight import check
from shardlift.operators.report import shard_manifests
from shardlift.queries.registry import query, table, text
from shardlift.shared import shared_folder
from shardlift.sinks.files import shard_file_rows, write_blobs, write_shard_files
from shardlift.sources.blobs import byte_ranges, listed_files, read_ranges, with_blob_paths
from shardlift.sources.catalog import newest
from shardlift.sources.containers import audited, container_problem, listed_containers
from shardlift.sources.metadata import explode_files, parse_shards
from shardlift.sources.roots import repo_name
from shardlift.unnest import unnest


def line_files(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem as file records: cents as length, a part size by return flag."""
    flag = F.col("l_returnflag")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("repo_id"),
        F.col("l_partkey").cast("string").alias("index_id"),
        F.col("l_linenumber").alias("shard"),
        F.concat(F.lit("__"), text("l_suppkey")).alias("name"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("length"),
        F.when(flag == "A", 500000)
        .when(flag == "N", 2000000)
        .otherwise(F.lit(UNLIMITED_PART_SIZE))
        .cast("bigint")
        .alias("part_size"),
    )


@query(
    """
    WITH f AS (
      SELECT CAST(l_orderkey AS VARCHAR) AS repo_id, CAST(l_partkey AS VARCHAR) AS index_id,
             l_linenumber AS shard, '__' || CAST(l_suppkey AS VARCHAR) AS name,
             CAST(round(l_extendedprice * 100) AS BIGINT) AS len,
             CASE l_returnflag WHEN 'A' THEN 500000 WHEN 'N' THEN 2000000 ELSE 9223372036854775807 END AS ps
      FROM lineitem),
    n AS (SELECT *, greatest(1, len // ps + CASE WHEN len % ps > 0 THEN 1 ELSE 0 END) AS n_parts FROM f)
    SELECT repo_id, index_id, shard, name, n_parts, part,
           CASE WHEN n_parts > 1 THEN name || '.part' || CAST(part AS VARCHAR) ELSE name END AS blob_name,
           part * ps AS part_offset, least(ps, len - part * ps) AS part_length
    FROM (SELECT *, unnest(range(n_parts)) AS part FROM n)
    """
)
def parts_plan(spark: SparkSession, folder: str) -> DataFrame:
    return file_parts(line_files(spark, folder)).select(
        "repo_id", "index_id", "shard", "name", "n_parts", "part", "blob_name", "part_offset", "part_length"
    )


@query(
    """
    WITH b AS (SELECT DISTINCT l_orderkey, l_linenumber - 1 AS part FROM lineitem),
    p AS (SELECT o_orderkey, n, unnest(range(n)) AS part
          FROM (SELECT o_orderkey, 1 + CAST(floor(o_totalprice / 100000) AS BIGINT) AS n FROM orders))
    SELECT p.o_orderkey, p.part, p.n AS n_parts, b.l_orderkey IS NOT NULL AS present
    FROM p LEFT JOIN b ON b.l_orderkey = p.o_orderkey AND b.part = p.part
    """
)
def parts_join(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as files cut into parts, order lines as the blobs that exist."""
    unit = 1000
    parts = F.floor(F.col("o_totalprice") / 100000).cast("bigint") + 1
    files = table(spark, folder, "orders").select(
        "o_orderkey",
        F.concat(F.lit("__"), text("o_orderkey")).alias("name"),
        (parts * unit).alias("length"),
        F.lit(unit).cast("bigint").alias("part_size"),
        parts.alias("n"),
    )
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    sizes = files.select(F.col("o_orderkey").alias("l_orderkey"), "n")
    # A file of one part has a blob without a part suffix; lines beyond the file are other files' business.
    name = paths.part_name(F.concat(F.lit("__"), text("l_orderkey")), F.col("n"), F.col("l_linenumber") - 1)
    blobs = (
        lines.join(sizes, "l_orderkey")
        .where(F.col("l_linenumber") <= F.col("n"))
        .select(F.col("l_orderkey").alias("o_orderkey"), name.alias("blob_name"))
    )
    return join_blobs(file_parts(files), blobs, ["o_orderkey"]).select(
        "o_orderkey", "part", "n_parts", "present"
    )


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """documents as files of 1000-byte parts; those of source src0 are kept in the manifest."""
    body = F.encode("text", "UTF-8")
    inline = F.col("source") == "src0"
    return table(spark, folder, "documents").select(
        F.col("doc_id"),
        F.concat(F.when(inline, "v__").otherwise("__"), text("doc_id")).alias("name"),
        text("doc_id").alias("physical_name"),
        F.length(body).cast("bigint").alias("length"),
        F.lit(1000).cast("bigint").alias("part_size"),
        F.when(inline, body).alias("meta_hash"),
    )


def text_blobs(spark: SparkSession, folder: str, size: int) -> DataFrame:
    """documents as the blobs (doc_id, blob_name, content) that their parts are kept in, cut inside each row."""
    body = F.encode("text", "UTF-8")
    rows = table(spark, folder, "documents").select(
        "doc_id", "lang", body.alias("body"), paths.part_count(F.length(body).cast("bigint"), F.lit(size)).alias("n")
    )
    name = F.concat(F.lit("__"), text("doc_id"))

    def blob(i: Column) -> Column:
        return F.struct(
            paths.part_name(name, F.col("n"), i).alias("blob_name"),
            F.substring("body", (i * size + 1).cast("int"), F.lit(size)).alias("content"),
        )

    cut = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), blob)
    return unnest(rows, cut, "i", "b").select("doc_id", "lang", "b.*")


_PART = 16384


@query(
    f"""
    SELECT doc_id, CAST(i * {_PART} AS BIGINT) AS "offset",
           md5(array_slice(body, i * {_PART} + 1, least(len, (i + 1) * {_PART}))) AS content_md5
    FROM (SELECT doc_id, body, len, unnest(range(greatest(1, (len + {_PART} - 1) // {_PART}))) AS i
          FROM (SELECT doc_id, encode(text) AS body, octet_length(encode(text)) AS len FROM documents))
    """
)
def shard_files(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as blobs of a repository that tasks write, with a shard for each language, read back by byte ranges."""
    root = f"{shared_folder(spark)}/repo-{uuid.uuid4().hex}"
    blobs = text_blobs(spark, folder, _PART)
    path = paths.blob_path(F.lit(root), F.lit("idx"), _language_shard(), F.col("blob_name"))
    write_blobs(blobs.select(path.alias("path"), "content"))
    files = _text_records(spark, folder, root)
    rows = shard_file_rows(files)
    return rows.select(
        F.col("physical_name").cast("bigint").alias("doc_id"), "offset", F.md5("content").alias("content_md5")
    )


def _language_shard() -> Column:
    return F.when(F.col("lang") == "en", 0).when(F.col("lang") == "de", 1).otherwise(2)


_CHUNKED = """
    WITH d AS (SELECT doc_id, source, encode(text) AS body, octet_length(encode(text)) AS len FROM documents),
    c AS (SELECT *, unnest(range(greatest(1, (len + 3999) // 4000))) AS chunk FROM d WHERE source <> 'src0')
    SELECT doc_id, chunk, chunk * 4000 AS "offset",
           least(4000, len - chunk * 4000) AS bytes,
           md5(array_slice(body, chunk * 4000 + 1, least(len, chunk * 4000 + 4000))) AS content_md5
    FROM c
    UNION ALL SELECT doc_id, 0, 0, len, md5(body) FROM d WHERE source = 'src0'
"""


@query(_CHUNKED)
def parts_concat(spark: SparkSession, folder: str) -> DataFrame:
    """Texts cut into parts, the parts looked up as blobs and put together in chunks of four."""
    files = text_files(spark, folder)
    blobs = text_blobs(spark, folder, 1000).select("doc_id", "blob_name", "content")
    found = join_blobs(file_parts(files), blobs, ["doc_id"]).where("present")
    chunks = concat_parts(found, ["doc_id"], 4000)
    return chunks.unionByName(inline_chunks(files, ["doc_id"])).select(
        "doc_id",
        "chunk",
        "offset",
        F.length("content").cast("bigint").alias("bytes"),
        F.md5("content").alias("content_md5"),
    )


@query(
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS repo_id, 'part_size' AS rule,
           CAST(l_linenumber AS VARCHAR) AS subject, 'part size 0' AS detail
    FROM lineitem WHERE l_discount < 0.005 AND l_linestatus = 'O'
    UNION ALL
    SELECT CAST(l_orderkey AS VARCHAR), 'inline_bytes', CAST(l_linenumber AS VARCHAR), 'inline file without bytes'
    FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'A'
    """
)
def file_violations(spark: SparkSession, folder: str) -> DataFrame:
    inline = F.col("l_linestatus") == "F"
    files = table(spark, folder, "lineitem").select(
        text("l_orderkey").alias("repo_id"),
        "l_linenumber",
        F.when(inline, "v__x").otherwise("__x").alias("name"),
        F.when(F.col("l_discount") < 0.005, 0).otherwise(10).alias("part_size"),
        F.when(F.col("l_returnflag") != "A", F.encode("l_returnflag", "UTF-8")).alias("meta_hash"),
    )
    return check(files, F.col("l_linenumber"), file_rules())


_PAGE_PROBLEM = """
    CASE WHEN url LIKE 'https://spam%' THEN 'checksum' WHEN url LIKE 'http://%' THEN 'format name'
         WHEN url LIKE '%#top' THEN 'footer magic' WHEN url LIKE '%.html' THEN 'format version'
         WHEN url LIKE '%utm_source%' THEN 'header magic' END
"""


@query(f"SELECT page_id, {_PAGE_PROBLEM} AS problem FROM pages")
def envelope_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Pages wrapped as containers, each kind of damage on a group of urls."""
    problem = container_problem(F.col("content"), F.lit("snapshot"))
    return _page_containers(spark, folder).select("page_id", problem.alias("problem"))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      's3a://r/' || l_orderkey || '/meta-' || l_partkey || '.dat' AS global_path,
      's3a://r/' || l_orderkey || '/snap-' || l_partkey || '.dat' AS snapshot_path,
      's3a://r/' || l_orderkey || '/indices/' || l_suppkey || '/meta-' || l_partkey || '.dat' AS index_path,
      's3a://r/' || l_orderkey || '/indices/' || l_suppkey || '/' || l_linenumber AS shard_dir,
      's3a://r/' || l_orderkey || '/indices/' || l_suppkey || '/' || l_linenumber
        || '/snap-' || l_partkey || '.dat' AS shard_path,
      's3a://r/' || l_orderkey || '/indices/' || l_suppkey || '/' || l_linenumber
        || '/__' || l_partkey AS blob_path
    FROM lineitem
    """
)
def locators(spark: SparkSession, folder: str) -> DataFrame:
    slash = F.when(F.col("l_returnflag") == "A", "/").otherwise("")
    root = F.concat(F.lit("s3a://r/"), text("l_orderkey"), slash)
    part, supp, line = text("l_partkey"), text("l_suppkey"), F.col("l_linenumber")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        paths.global_metadata_path(root, part).alias("global_path"),
        paths.snapshot_path(root, part).alias("snapshot_path"),
        paths.index_metadata_path(root, supp, part).alias("index_path"),
        paths.shard_dir(root, supp, line).alias("shard_dir"),
        paths.shard_path(root, part, supp, line).alias("shard_path"),
        paths.blob_path(root, supp, line, F.concat(F.lit("__"), part)).alias("blob_path"),
    )


@query(
    """
    SELECT repo_id, gen AS generation, 'index-' || CAST(gen AS VARCHAR) AS file_name FROM (
      SELECT CAST(l_orderkey AS VARCHAR) AS repo_id, max(l_partkey) AS gen
      FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey)
    """
)
def newest_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """The highest generation per repository, among names that only look like a catalog's."""
    flag, number = F.col("l_returnflag"), text("l_partkey")
    name = (
        F.when(flag == "A", F.concat(F.lit("index-"), number))
        .when(flag == "N", F.concat(F.lit("index-"), number, F.lit(".tmp")))
        .otherwise("index-latest")
    )
    files = table(spark, folder, "lineitem").select(
        text("l_orderkey").alias("repo_id"), name.alias("file_name"), number.alias("value")
    )
    return newest(files).select("repo_id", "generation", "file_name")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN l_partkey ELSE -1 END AS generation
    FROM lineitem
    """
)
def generations(spark: SparkSession, folder: str) -> DataFrame:
    suffix = F.when(F.col("l_returnflag") == "A", "").otherwise("x")
    name = F.concat(F.lit("index-"), text("l_partkey"), suffix)
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.coalesce(generation(name), F.lit(-1)).alias("generation"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(unnest(range(CAST(l_quantity AS BIGINT) // 10)) AS INTEGER) AS shard
    FROM lineitem
    """
)
def shards(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard of indices with 0 to 5 shards."""
    count = F.floor(F.col("l_quantity") / 10).cast("int")
    return shard_rows(
        table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", count.alias("n_shards"))
    ).drop("n_shards")


def line_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem rows as exported shard manifests with one stored and one inline file."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    common = [F.lit("c").alias("checksum"), F.lit(1000000).alias("part_size"), F.lit("8").alias("written_by")]
    files = F.array(
        F.struct(
            F.concat(F.lit("__"), text("l_suppkey")).alias("name"),
            F.lit("_0.cfs").alias("physical_name"),
            cents.alias("length"),
            *common,
            F.lit(None).cast("string").alias("meta_hash"),
        ),
        F.struct(
            F.concat(F.lit("v__"), text("l_suppkey")).alias("name"),
            F.lit("segments_1").alias("physical_name"),
            F.length("l_returnflag").cast("bigint").alias("length"),
            *common,
            F.base64(F.encode("l_returnflag", "UTF-8")).alias("meta_hash"),
        ),
    )
    record = F.struct(
        text("l_orderkey").alias("name"),
        F.col("l_linenumber").alias("index_version"),
        F.lit(1).alias("start_time"),
        F.lit(2).alias("time"),
        F.lit(2).alias("number_of_files"),
        (cents + 1).alias("total_size"),
        files.alias("files"),
    )
    return table(spark, folder, "lineitem").select(
        text("l_orderkey").alias("repo_id"),
        text("l_partkey").alias("index_id"),
        F.col("l_linenumber").alias("shard"),
        F.to_json(record).alias("value"),
    )


@query(
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS repo_id, CAST(l_partkey AS VARCHAR) AS index_id, l_linenumber AS shard,
           '__' || CAST(l_suppkey AS VARCHAR) AS name, '_0.cfs' AS physical_name,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS length, NULL AS inline_text
    FROM lineitem
    UNION ALL
    SELECT CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), l_linenumber,
           'v__' || CAST(l_suppkey AS VARCHAR), 'segments_1', length(l_returnflag), l_returnflag
    FROM lineitem
    """
)
def manifest_files(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["repo_id", "index_id", "shard"]
    return explode_files(parse_shards(line_manifests(spark, folder)), keys).select(
        *keys, "name", "physical_name", "length", F.col("meta_hash").cast("string").alias("inline_text")
    )


@query(
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS repo_id, CAST(l_partkey AS VARCHAR) AS index_id, l_linenumber AS shard,
           CAST(l_orderkey AS VARCHAR) AS snapshot, CAST(round(l_extendedprice * 100) AS BIGINT) + 1 AS total_size,
           greatest(1, (CAST(round(l_extendedprice * 100) AS BIGINT) + 999999) // 1000000) AS first_parts,
           l_returnflag AS second_bytes
    FROM lineitem
    """
)
def report_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Manifests printed as JSON, read back at a few places."""
    parsed = parse_shards(line_manifests(spark, folder)).withColumn("index_name", F.col("index_id"))
    places = "struct<snapshotName:string,totalSize:bigint,files:array<struct<numberOfParts:bigint,metaHash:string>>>"
    at = F.col("at")
    # One parse for all places; each `get_json_object` would parse the whole manifest again.
    return shard_manifests(parsed).withColumn("at", F.from_json("manifest", places)).select(
        "repo_id",
        F.col("index_name").alias("index_id"),
        "shard",
        at["snapshotName"].alias("snapshot"),
        at["totalSize"].alias("total_size"),
        F.get(at["files"], F.lit(0))["numberOfParts"].alias("first_parts"),
        F.unbase64(F.get(at["files"], F.lit(1))["metaHash"]).cast("string").alias("second_bytes"),
    )


def _page_containers(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as container files (page_id, content), each kind of damage on a group of urls."""
    url = F.col("url")
    spoiled = (
        F.when(url.like("https://spam%"), "checksum")
        .when(url.like("http://%"), "name")
        .when(url.like("%#top"), "footer")
        .when(url.like("%.html"), "version")
        .when(url.like("%utm_source%"), "header")
        .otherwise("none")
    )
    rows = table(spark, folder, "pages").select("page_id", spoiled.alias("spoiled"), F.encode("html", "UTF-8").alias("html"))
    kind = F.col("spoiled")
    body = F.concat(
        F.unhex(F.when(kind == "header", "3FD76C18").otherwise("3FD76C17")),
        F.unhex(F.lit("08")),
        F.encode(F.when(kind == "name", "snapshit").otherwise("snapshot"), "UTF-8"),
        F.unhex(F.when(kind == "version", "00000002").otherwise("00000001")),
        F.col("html"),
        F.unhex(F.concat(F.when(kind == "footer", "C02893E9").otherwise("C02893E8"), F.lit("00000000"))),
    )
    rows = rows.select("page_id", "spoiled", body.alias("body"))
    checksum = F.crc32("body") + F.when(kind == "checksum", 1).otherwise(0)
    return rows.select("page_id", F.concat("body", F.unhex(F.lpad(F.hex(checksum), 16, "0"))).alias("content"))


_RANGE = 4096


@query(f"SELECT page_id, {_PAGE_PROBLEM} AS problem FROM pages")
def envelope_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Container files that tasks write, listed by folder and audited in ranges of 4 KB whose checksums are combined."""
    root = repo_name(F.lit(f"{shared_folder(spark)}/containers-{uuid.uuid4().hex}"))
    pages = _page_containers(spark, folder)
    spot = F.concat_ws("/", root, (F.col("page_id") % 8).cast("string"))
    name = F.concat(F.lit("snap-"), text("page_id"), F.lit(".dat"))
    write_blobs(pages.select(F.concat_ws("/", spot, name).alias("path"), "content"))
    wanted = table(spark, folder, "pages").select(
        spot.alias("folder"), name.alias("name"), F.lit("snapshot").alias("format")
    )
    audit = audited(listed_containers(wanted), _RANGE)
    page = F.regexp_extract("path", r"snap-(-?\d+)\.dat$", 1).cast("bigint")
    return audit.select(page.alias("page_id"), "problem")


@query(
    f"""
    WITH d AS (SELECT doc_id, octet_length(encode(text)) AS len FROM documents),
    p AS (SELECT doc_id, len, greatest(1, (len + {_PART} - 1) // {_PART}) AS n FROM d),
    b AS (SELECT doc_id, n, unnest(range(n)) AS part, len FROM p),
    s AS (SELECT doc_id, CASE WHEN n > 1 THEN '__' || doc_id || '.part' || part ELSE '__' || doc_id END AS name,
                 least({_PART}, len - part * {_PART}) AS part_length,
                 CASE WHEN doc_id % 7 = 1 THEN 'missing' WHEN doc_id % 7 = 2 AND part = 0 THEN 'wrong size'
                      WHEN doc_id % 7 = 3 THEN 'orphan' ELSE 'fits' END AS state
          FROM b)
    SELECT name, CAST(CASE WHEN state <> 'orphan' THEN part_length END AS BIGINT) AS part_length,
           CAST(CASE state WHEN 'missing' THEN NULL WHEN 'wrong size' THEN part_length + 1 ELSE part_length END AS BIGINT)
             AS blob_length,
           state
    FROM s
    """
)
def blob_states(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as blobs of three shards, some left out, some too long, some that no manifest names, against the listing."""
    root = f"{shared_folder(spark)}/repo-{uuid.uuid4().hex}"
    case = F.col("doc_id") % 7
    spoiled = (case == 2) & ~F.col("blob_name").rlike(r"\.part[1-9]")
    blobs = text_blobs(spark, folder, _PART).where(case != 1)
    path = paths.blob_path(F.lit(root), F.lit("idx"), _language_shard(), F.col("blob_name"))
    content = F.when(spoiled, F.concat("content", F.unhex(F.lit("00")))).otherwise(F.col("content"))
    write_blobs(blobs.select(path.alias("path"), content.alias("content")))
    files = _text_records(spark, folder, root).where(F.col("physical_name").cast("bigint") % 7 != 3)
    parts = with_blob_paths(file_parts(files)).select("repo_id", "folder", "blob_name", "part_length")
    shards = spark.range(3).select(repo_name(F.lit(root)).alias("repo_id"), F.lit("idx").alias("index_id"), F.col("id").alias("shard"))
    folders = with_blob_paths(shards.withColumn("blob_name", F.lit(""))).select("repo_id", "folder")
    return reconciled(parts, listed_files(folders)).select("name", "part_length", "blob_length", "state")


@query(
    f"""
    SELECT doc_id, CAST(i * {_PART} AS BIGINT) AS "offset", len AS length,
           md5(array_slice(body, i * {_PART} + 1, least(len, (i + 1) * {_PART}))) AS content_md5
    FROM (SELECT doc_id, body, len, unnest(range((len + {_PART} - 1) // {_PART})) AS i
          FROM (SELECT doc_id, encode(text) AS body, octet_length(encode(text)) AS len FROM documents))
    """
)
def shard_files_committed(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as blobs, put together as one file each, committed, and read back where the manifest says."""
    root = f"{shared_folder(spark)}/repo-{uuid.uuid4().hex}"
    blobs = text_blobs(spark, folder, _PART)
    path = paths.blob_path(F.lit(root), F.lit("idx"), _language_shard(), F.col("blob_name"))
    write_blobs(blobs.select(path.alias("path"), "content"))
    manifest = write_shard_files(
        _text_records(spark, folder, root), f"{root}-files", task_bytes=32 << 20, range_bytes=3000
    )
    rows = manifest.select("physical_name", "path", "length")
    ranges = unnest(rows, byte_ranges(F.lit(0).cast("bigint"), F.col("length"), _PART), "i", "r")
    read = read_ranges(ranges.select("physical_name", "length", "path", "r.at", "r.count", F.col("r.at").alias("offset")))
    return read.select(
        F.col("physical_name").cast("bigint").alias("doc_id"), "offset", "length", F.md5("content").alias("content_md5")
    )


def _text_records(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """documents as file records of one index with a shard for each language."""
    return table(spark, folder, "documents").select(
        repo_name(F.lit(root)).alias("repo_id"),
        F.lit("texts").alias("index_name"),
        F.lit("idx").alias("index_id"),
        _language_shard().alias("shard"),
        F.concat(F.lit("__"), text("doc_id")).alias("name"),
        text("doc_id").alias("physical_name"),
        F.length(F.encode("text", "UTF-8")).cast("bigint").alias("length"),
        F.lit(_PART).cast("bigint").alias("part_size"),
        F.lit(None).cast("binary").alias("meta_hash"),
    )
