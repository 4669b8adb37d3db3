"""Snapshot, global, index and shard metadata exported as JSON next to the files they describe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.functions.jsontext import entries, member
from shardlift.functions.paths import index_metadata_path, shard_path
from shardlift.schemas import FILE_INFO_REQUIRED, SHARD, SNAPSHOT
from shardlift.sources.blobs import read_texts
from shardlift.sources.catalog import (
    CORRUPT,
    read_whole_text,
    strict_json,
    unknown_keys,
)
from shardlift.sources.repository import metadata_files
from shardlift.sources.roots import is_pattern, roots_of
from shardlift.unnest import unnest

# Where each kind sits below the repository root, and the ids its path carries.
_LAYOUT = {
    "snapshot": ("snap-*.json", r"^(.*)/snap-([^/]+)\.json$", ["snapshot_id"]),
    "global": ("meta-*.json", r"^(.*)/meta-([^/]+)\.json$", ["snapshot_id"]),
    "index": (
        "indices/*/meta-*.json",
        r"^(.*)/indices/([^/]+)/meta-([^/]+)\.json$",
        ["index_id", "file_id"],
    ),
    "shard": (
        "indices/*/*/snap-*.json",
        r"^(.*)/indices/([^/]+)/([^/]+)/snap-([^/]+)\.json$",
        ["index_id", "shard", "snapshot_id"],
    ),
}


def read_metadata(spark: SparkSession, repos: str | Sequence[str], kind: str) -> DataFrame:
    """(repo_id, ids of the path, value) of all metadata files of a kind.

    Repositories named by their roots are listed in tasks; patterns of roots are matched by Spark's own listing.
    """
    if not any(map(is_pattern, roots_of(repos))):
        return metadata_files(spark, repos, kind)
    pattern, shape, names = _LAYOUT[kind]
    files = read_whole_text(spark, [f"{root}/{pattern}" for root in roots_of(repos)])
    ids = [F.regexp_extract("path", shape, i + 2).alias(n) for i, n in enumerate(names)]
    table = files.select(F.regexp_extract("path", shape, 1).alias("repo_id"), *ids, "value")
    if kind == "shard":
        table = table.withColumn("shard", F.col("shard").try_cast("int"))
    return table


def index_metadata_of(indices: DataFrame) -> DataFrame:
    """Rows (repo_id, index_id, file_id, ...) with `value`, the text of the index's metadata file."""
    path = index_metadata_path(F.col("repo_id"), F.col("index_id"), F.col("file_id"), ".json")
    return read_texts(indices.withColumn("path", path)).drop("path")


def shard_manifests_of(shards: DataFrame) -> DataFrame:
    """Rows (repo_id, index_id, shard, snapshot_id, ...) with `value`, the text of the shard's manifest."""
    path = shard_path(F.col("repo_id"), F.col("snapshot_id"), F.col("index_id"), F.col("shard"), ".json")
    return read_texts(shards.withColumn("path", path)).drop("path")


def parse_snapshots(texts: DataFrame, version: str) -> DataFrame:
    """Snapshot records, found under `snapshot`, with `malformed` and `unknown`."""
    schema = SNAPSHOT[version]
    return (
        texts.withColumn("body", member(entries(F.col("value")), "snapshot"))
        .withColumn("record", strict_json(F.col("body"), schema))
        .withColumn("unknown", unknown_keys(F.col("body"), schema.names))
        .select(
            *[c for c in texts.columns if c != "value"],
            *[F.col(f"record.{name}").alias(name) for name in schema.names],
            (F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull()).alias("malformed"),
            "unknown",
        )
    )


def global_bodies(texts: DataFrame) -> DataFrame:
    """Global metadata, found under `meta-data`, as JSON text in `body`."""
    return texts.withColumn("body", member(entries(F.col("value")), "meta-data")).drop("value")


def index_bodies(texts: DataFrame) -> DataFrame:
    """Index metadata, found under the name of the index, as JSON text in `body`."""
    return texts.withColumn("body", member(entries(F.col("value")), F.col("index_name"))).drop("value")


def parse_shards(texts: DataFrame) -> DataFrame:
    """Shard manifests with their `files` array, `malformed`, `unknown` and `missing` file keys."""
    raw_files = F.from_json("value", "struct<files:array<string>>")["files"]
    required = F.array(*map(F.lit, FILE_INFO_REQUIRED))
    missing = F.array_distinct(
        F.flatten(
            F.transform(
                F.coalesce(raw_files, F.array().cast("array<string>")),
                lambda f: F.array_except(required, F.json_object_keys(f)),
            )
        )
    )
    return (
        texts.withColumn("record", strict_json(F.col("value"), SHARD))
        .withColumn("unknown", unknown_keys(F.col("value"), SHARD.names))
        .withColumn("missing", missing)
        .select(
            *[c for c in texts.columns if c != "value"],
            *[F.col(f"record.{name}").alias(name) for name in SHARD.names],
            (F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull()).alias("malformed"),
            "unknown",
            "missing",
        )
    )


def explode_files(shards: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per file of each manifest; inline bytes come out of base64."""
    return (
        unnest(shards.select(*keys, "files"), "files", "at", "file")
        .select(*keys, "file.*")
        .withColumn("meta_hash", F.unbase64("meta_hash"))
    )
