"""Integrity of metadata container files: header, footer and checksum, over whole files."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.fixed import (
    CONTAINER_ALGORITHM,
    CONTAINER_FOOTER_MAGIC,
    CONTAINER_HEADER_MAGIC,
    CONTAINER_NAMES,
    CONTAINER_VERSION,
)
from shardlift.functions import paths
from shardlift.functions.checksums import moved_on
from shardlift.operators.packing import packed
from shardlift.sources.blobs import RANGE_BYTES, TASK_BYTES, byte_ranges, listed_files, open_path
from shardlift.unnest import unnest

FOOTER_BYTES = 16
CHECKSUM_BYTES = 8
# Opening a file counts like this many bytes.
OPENING_BYTES = 256 * 1024
# What a task holds of a range at once.
_READ_BYTES = 4 * 1024 * 1024


def _hex(content: Column, start: Column | int, length: int) -> Column:
    at = F.lit(start) if isinstance(start, int) else start
    return F.hex(F.substring(content, at, F.lit(length)))


def container_problem(content: Column, name: Column) -> Column:
    """What is wrong with a container of the given format name, or null.

    Layout: magic (4 bytes), name length (1), name, version (4), body, footer magic (4),
    algorithm (4), CRC-32 of everything before it (8, big-endian).
    """
    size = F.length(content)
    footer = size - FOOTER_BYTES + 1
    name_bytes = F.encode(name, "UTF-8")
    name_size = F.length(name_bytes)
    stored = F.conv(_hex(content, size - 7, 8), 16, 10)
    actual = F.crc32(F.substring(content, F.lit(1), size - 8)).cast("string")
    header = F.concat(
        F.lit(CONTAINER_HEADER_MAGIC), F.lpad(F.hex(name_size), 2, "0"), F.hex(name_bytes)
    )
    return (
        F.when(size < FOOTER_BYTES, F.lit("too short for a footer"))
        .when(_hex(content, footer, 4) != CONTAINER_FOOTER_MAGIC, F.lit("footer magic"))
        .when(_hex(content, footer + 4, 4) != CONTAINER_ALGORITHM, F.lit("checksum algorithm"))
        .when(stored != actual, F.lit("checksum"))
        .when(_hex(content, 1, 4) != CONTAINER_HEADER_MAGIC, F.lit("header magic"))
        .when(F.hex(F.substring(content, F.lit(1), name_size + 5)) != header, F.lit("format name"))
        .when(_hex(content, name_size + 6, 4) != CONTAINER_VERSION, F.lit("format version"))
    )


def read_containers(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of container files."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def container_files(kind: str, rows: DataFrame) -> DataFrame:
    """Where the containers of a kind lie: (repo_id, kind, folder, name, format) from rows with the ids of their paths.

    They lie next to the exported metadata: `snapshot` and `global` need snapshot_id, `index` index_id and file_id,
    `shard` index_id, shard and snapshot_id.
    """
    root = F.col("repo_id")
    path = {
        "snapshot": lambda: paths.snapshot_path(root, F.col("snapshot_id")),
        "global": lambda: paths.global_metadata_path(root, F.col("snapshot_id")),
        "index": lambda: paths.index_metadata_path(root, F.col("index_id"), F.col("file_id")),
        "shard": lambda: paths.shard_path(root, F.col("snapshot_id"), F.col("index_id"), F.col("shard")),
    }[kind]()
    return rows.select(
        "repo_id",
        F.lit(kind).alias("kind"),
        F.regexp_extract(path, "^(.*)/([^/]*)$", 1).alias("folder"),
        F.regexp_extract(path, "^(.*)/([^/]*)$", 2).alias("name"),
        F.lit(CONTAINER_NAMES[kind]).alias("format"),
    )


def listed_containers(files: DataFrame) -> DataFrame:
    """Containers with their `length`, null where there is none; every folder is listed once."""
    found = listed_files(files.select("folder").distinct()).select("folder", "name", "length")
    return files.join(found, ["folder", "name"], "left").withColumn("path", F.concat_ws("/", "folder", "name"))


def _range_checks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shares, heads, feet = [], [], []
        wanted = (batch.column(n).to_pylist() for n in ("path", "at", "count", "length", "head_bytes"))
        for uri, at, count, length, head_bytes in zip(*wanted, strict=True):
            files, path = open_path(uri)
            with files.open_input_file(path) as source:
                source.seek(at)
                crc, left = 0, count
                head = b""
                while left:
                    content = source.read(min(left, _READ_BYTES))
                    if not content:
                        raise OSError(f"{uri} ends before byte {at + count}")
                    if at == 0 and left == count:
                        head = content[:head_bytes]
                    crc = zlib.crc32(content, crc)
                    left -= len(content)
                # The footer lies in the last range, but for a range that ends inside it.
                foot = b""
                if at + count == length - CHECKSUM_BYTES:
                    source.seek(max(0, length - FOOTER_BYTES))
                    foot = source.read(FOOTER_BYTES)
            shares.append(moved_on(crc, length - CHECKSUM_BYTES - at - count))
            heads.append(head if at == 0 else None)
            feet.append(foot or None)
        kept = {name: batch.column(name) for name in ("path", "length", "format")}
        yield pa.RecordBatch.from_pydict(
            kept
            | {
                "share": pa.array(shares, pa.int64()),
                "head": pa.array(heads, pa.binary()),
                "foot": pa.array(feet, pa.binary()),
            }
        )


def audited(files: DataFrame, range_bytes: int = RANGE_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(path, problem) of container files (path, length, format), as `container_problem` finds them.

    A file is read in ranges, each by some task, in pieces of a few megabytes: no value holds a file, and a large one
    is many tasks. Each range gives its share of the checksum; the shares of a file are summed by exclusive-or.
    """
    covered = F.greatest(F.col("length") - CHECKSUM_BYTES, F.lit(0))
    readable = files.where(F.col("length") >= FOOTER_BYTES).withColumn(
        "head_bytes", F.octet_length("format") + 9
    )
    ranges = unnest(readable, byte_ranges(F.lit(0), covered, range_bytes), "i", "r").select(
        "path", "length", "format", "head_bytes", "r.at", "r.count"
    )
    spread = [F.col("path"), F.call_function("div", F.col("at"), F.lit(task_bytes))]
    tasks = packed(ranges, F.col("count") + OPENING_BYTES, ["path", "at"], task_bytes, spread)
    checked = tasks.mapInArrow(
        _range_checks, "path string, length bigint, format string, share bigint, head binary, foot binary"
    )
    whole = checked.groupBy("path", "format").agg(
        F.bit_xor("share").alias("crc"), F.max("head").alias("head"), F.max("foot").alias("foot")
    )
    short = files.where(F.col("length") < FOOTER_BYTES).select(
        "path", F.lit("too short for a footer").alias("problem")
    )
    return whole.select("path", _problem(F.col("head"), F.col("foot"), F.col("crc"), F.col("format")).alias("problem")).unionByName(
        short
    )


def _problem(head: Column, foot: Column, crc: Column, name: Column) -> Column:
    """What is wrong by the first bytes, the footer and the checksum of all before it; the order is that of reading."""
    name_bytes = F.encode(name, "UTF-8")
    size = F.length(name_bytes)
    header = F.concat(F.lit(CONTAINER_HEADER_MAGIC), F.lpad(F.hex(size), 2, "0"), F.hex(name_bytes))
    return (
        F.when(_hex(foot, 1, 4) != CONTAINER_FOOTER_MAGIC, F.lit("footer magic"))
        .when(_hex(foot, 5, 4) != CONTAINER_ALGORITHM, F.lit("checksum algorithm"))
        .when(_hex(foot, 9, 8) != F.lpad(F.hex(crc), 16, "0"), F.lit("checksum"))
        .when(_hex(head, 1, 4) != CONTAINER_HEADER_MAGIC, F.lit("header magic"))
        .when(F.hex(F.substring(head, F.lit(1), size + 5)) != header, F.lit("format name"))
        .when(_hex(head, size + 6, 4) != CONTAINER_VERSION, F.lit("format version"))
    )


def container_problems(files: DataFrame) -> DataFrame:
    """Broken containers (repo_id, kind, path, problem) among `container_files` rows; those that are not there are none."""
    present = listed_containers(files).where(F.col("length").isNotNull())
    found = audited(present.select("path", "length", "format")).where(F.col("problem").isNotNull())
    return present.select("repo_id", "kind", "path").join(found, "path")
