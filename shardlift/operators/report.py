"""What a repository holds: snapshots, indices, templates, shards and documents as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlift.functions.ids import decode_id, source_text
from shardlift.functions.jsontext import is_array
from shardlift.functions.mappings import unwrap_mappings
from shardlift.functions.paths import part_count
from shardlift.functions.settings import tree_text
from shardlift.operators.catalog import all_snapshot_indices, list_snapshots
from shardlift.operators.transforms import index_parts, shard_count, template_rows
from shardlift.schemas import DOCUMENT
from shardlift.unnest import unnest


def snapshots(catalog: DataFrame) -> DataFrame:
    return list_snapshots(catalog)


def snapshot_indices(catalog: DataFrame, version: str) -> DataFrame:
    return all_snapshot_indices(catalog, version)


def snapshot_summary(snapshots_: DataFrame) -> DataFrame:
    return snapshots_.select(
        "repo_id", "name", "state", "reason", "version_id", "indices", "total_shards", "successful_shards"
    )


def template_names(bodies: DataFrame, version: str) -> DataFrame:
    """Template names per bucket, one row each; which buckets are listed depends on the version."""
    kinds = ("template",) if version == "6.8" else ("index_template", "component_template")
    return template_rows(bodies, kinds).select("repo_id", "kind", "ord", "name")


def index_summary(indices: DataFrame) -> DataFrame:
    """Id, shard count, settings as a tree, unwrapped mappings and aliases of each index.

    Mappings that are not an array have no reading here and give a problem.
    """
    keys = [c for c in indices.columns if c != "body"]
    return (
        index_parts(indices)
        .withColumn(
            "r",
            F.struct(
                shard_count(F.col("tree.leaves")).alias("n_shards"),
                tree_text(F.col("tree.leaves")).alias("settings"),
                unwrap_mappings(F.col("mappings")).alias("unwrapped"),
            ),
        )
        .select(
            *keys,
            "r.n_shards",
            "r.settings",
            F.when(is_array(F.col("mappings")), F.col("r.unwrapped.value")).alias("mappings"),
            "aliases",
            F.coalesce(
                F.col("tree.problem"),
                F.when(~is_array(F.col("mappings")), F.lit("mappings are not an array")),
                F.col("r.unwrapped.problem"),
            ).alias("problem"),
        )
    )


def shard_manifests(shards: DataFrame) -> DataFrame:
    """Manifests of shards as JSON text, with the number of parts of each file."""
    files = F.transform(
        "files",
        lambda f: F.struct(
            f["name"].alias("name"),
            f["physical_name"].alias("physicalName"),
            f["length"].alias("length"),
            f["checksum"].alias("checksum"),
            f["part_size"].alias("partSize"),
            part_count(f["length"], f["part_size"]).alias("numberOfParts"),
            f["written_by"].alias("writtenBy"),
            f["meta_hash"].alias("metaHash"),
        ),
    )
    record = F.struct(
        F.col("name").alias("snapshotName"),
        F.col("index_name").alias("indexName"),
        F.col("index_id").alias("indexId"),
        F.col("shard").alias("shardId"),
        F.col("index_version").alias("indexVersion"),
        F.col("start_time").alias("startTime"),
        "time",
        F.col("number_of_files").alias("numberOfFiles"),
        F.col("total_size").alias("totalSize"),
        files.alias("files"),
    )
    return shards.select("repo_id", "index_name", "shard", F.to_json(record).alias("manifest"))


def document_fields(docs: DataFrame) -> DataFrame:
    """One row per stored field of each document; a document without a source gives its id as deleted.

    Ids and sources come with their value, further columns of the table that are set with their name.
    """
    base = {"repo_id", *DOCUMENT.names}
    others = [c for c in docs.columns if c not in base]
    gone = F.length("_source").isNull() | (F.length("_source") == 0)

    def row(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("field"), value.alias("value"))

    none = F.lit(None).cast("string")
    present = F.filter(
        F.array(
            row("_id", decode_id(F.col("_id"))),
            row("_source", source_text(F.col("_source"))),
            *[F.when(F.col(c).isNotNull(), row(c, none)) for c in others],
        ),
        lambda r: r.isNotNull(),
    )
    rows = F.when(gone, F.array(row("deleted", decode_id(F.col("_id"))))).otherwise(present)
    keys = [c for c in docs.columns if c in base and not c.startswith("_")]
    return unnest(docs, rows, "at", "r").select(*keys, "r.*")
