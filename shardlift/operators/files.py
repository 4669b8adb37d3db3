"""Shard files: parts, the blobs that hold them, and the bytes put back together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlift.fixed import BLOB_PREFIX
from shardlift.functions.paths import is_inline, part_count, part_name
from shardlift.unnest import unnest

FILE_KEYS = ("repo_id", "index_id", "shard")
CHUNK_BYTES = 64 * 1024 * 1024


def shard_rows(indices: DataFrame, count: str = "n_shards") -> DataFrame:
    """One row per shard 0..n-1; an index without shards gives none."""
    # sequence(0, -1) would count down, so an empty range is no range at all.
    span = F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1))
    return unnest(indices, span, "at", "shard").drop("at")


def file_parts(files: DataFrame) -> DataFrame:
    """One row per blob of every file kept in blobs. Row-local: nothing is shuffled."""
    length, size, part = F.col("length"), F.col("part_size"), F.col("part")
    stored = files.where(~is_inline(F.col("name")) & (size > 0)).withColumn("n_parts", part_count(length, size))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.col("n_parts") - 1)
    return unnest(stored, numbers, "at", "part").select(
        *files.columns,
        "part",
        "n_parts",
        part_name(F.col("name"), F.col("n_parts"), part).alias("blob_name"),
        (part * size).alias("part_offset"),
        F.least(size, length - part * size).alias("part_length"),
    )


def inline_files(files: DataFrame) -> DataFrame:
    return files.where(is_inline(F.col("name")))


def join_blobs(parts: DataFrame, blobs: DataFrame, keys: Sequence[str] = FILE_KEYS) -> DataFrame:
    """Parts with the matching row of a blob table; `present` is false where there is none.

    Each blob belongs to one part, so the keys do not repeat and a file with very many parts spreads
    over all tasks.
    """
    found = blobs.withColumn("present", F.lit(True))
    return parts.join(found, [*keys, "blob_name"], "left").withColumn(
        "present", F.coalesce("present", F.lit(False))
    )


def concat_parts(
    parts: DataFrame, keys: Sequence[str] = FILE_KEYS, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """File bytes from (keys, physical_name, part, part_size, content), in chunks.

    A chunk is a run of consecutive parts of at most `chunk_bytes` (at least one part), so a file that
    fits one chunk comes back as one value and a larger one as several rows with their `offset`. No
    group is larger than a chunk, whatever share of all bytes one file has. Parts are ordered inside
    the aggregate.
    """
    per_chunk = F.greatest(F.lit(1), F.call_function("div", F.lit(chunk_bytes), F.col("part_size")))
    return (
        parts.withColumn("chunk", F.call_function("div", F.col("part"), per_chunk))
        .groupBy(*keys, "physical_name", "chunk")
        .agg(
            F.expr("listagg(content) within group (order by part)").alias("content"),
            F.min(F.col("part") * F.col("part_size")).alias("offset"),
        )
        .select(*keys, "physical_name", "chunk", "offset", "content")
    )


def inline_chunks(files: DataFrame, keys: Sequence[str] = FILE_KEYS) -> DataFrame:
    """Files whose bytes stand in the manifest, in the shape of `concat_parts`."""
    return inline_files(files).select(
        *keys,
        "physical_name",
        F.lit(0).cast("bigint").alias("chunk"),
        F.lit(0).cast("bigint").alias("offset"),
        F.col("meta_hash").alias("content"),
    )


def file_rules() -> list[tuple[str, Column, Column]]:
    """Problems of single file records, for `preflight.check`."""
    inline = is_inline(F.col("name"))
    return [
        (
            "part_size",
            ~inline & ~F.coalesce(F.col("part_size") > 0, F.lit(False)),
            F.concat(F.lit("part size "), F.coalesce(F.col("part_size").cast("string"), F.lit("missing"))),
        ),
        ("inline_bytes", inline & F.col("meta_hash").isNull(), F.lit("inline file without bytes")),
    ]


def reconciled(parts: DataFrame, found: DataFrame) -> DataFrame:
    """Expected blobs (repo_id, folder, blob_name, part_length) against listed files (repo_id, folder, name, length).

    Rows (repo_id, folder, name, part_length, blob_length, state) with the state `fits`, `missing`, `wrong size` or
    `orphan`: a blob in a shard's folder that no manifest names. Other files of the folder are not looked at. Both
    sides are narrow and sorted by folder and name, then merged. A blob that manifests name twice is a row each time.
    """
    expected = parts.select(
        F.col("repo_id").alias("asked"), "folder", F.col("blob_name").alias("name"), "part_length"
    )
    blobs = found.where(F.startswith("name", F.lit(BLOB_PREFIX))).select(
        F.col("repo_id").alias("has"), "folder", "name", F.col("length").alias("blob_length")
    )
    state = (
        F.when(F.col("part_length").isNull(), "orphan")
        .when(F.col("blob_length").isNull(), "missing")
        .when(F.col("blob_length") != F.col("part_length"), "wrong size")
        .otherwise("fits")
    )
    return expected.join(blobs, ["folder", "name"], "full").select(
        F.coalesce("asked", "has").alias("repo_id"), "folder", "name", "part_length", "blob_length", state.alias("state")
    )
