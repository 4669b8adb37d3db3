"""Reports over repositories, without the guards a migration has."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.functions.versions import parse_source
from shardlift.operators import report
from shardlift.operators.catalog import indices_in_snapshot, snapshot_id
from shardlift.operators.files import shard_rows
from shardlift.shared import write_shared
from shardlift.sources.catalog import read_catalog
from shardlift.sources.containers import container_files, container_problems
from shardlift.sources.documents import read_documents
from shardlift.sources.metadata import (
    global_bodies,
    index_bodies,
    index_metadata_of,
    parse_shards,
    parse_snapshots,
    read_metadata,
    shard_manifests_of,
)


def inspect(
    spark: SparkSession,
    repos: str | Sequence[str],
    snapshot: str,
    source: str,
    documents: str | DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Report tables of the repositories: all snapshots, and the contents of the named one.

    `missing` names the metadata files that should be there and are not, `broken` the containers whose header, footer
    or checksum is wrong.
    """
    source = parse_source(source)
    catalog = write_shared(read_catalog(spark, repos, source), "catalog")
    chosen = catalog.select("repo_id", snapshot_id(snapshot).alias("snapshot_id")).where("snapshot_id is not null")
    on_snapshot = ["repo_id", "snapshot_id"]
    missing = []

    def found(joined: DataFrame, kind: str, subject: str) -> DataFrame:
        """The wanted files that are there; the others go to the table of missing files."""
        gone = joined.where(F.col("value").isNull())
        missing.append(
            gone.select("repo_id", F.lit(kind).alias("kind"), F.col(subject).cast("string").alias("subject"))
        )
        return joined.where(F.col("value").isNotNull())

    def listed(kind: str) -> DataFrame:
        return chosen.join(read_metadata(spark, repos, kind), on_snapshot, "left")

    described = parse_snapshots(found(listed("snapshot"), "snapshot", "snapshot_id"), source)
    globals_ = global_bodies(found(listed("global"), "global", "snapshot_id"))
    held = write_shared(indices_in_snapshot(catalog, snapshot, source), "held")
    bodies = index_bodies(found(write_shared(index_metadata_of(held), "index_texts"), "index", "index_name"))
    indices = write_shared(report.index_summary(bodies), "index_summary")
    shards = shard_rows(indices.select("repo_id", "snapshot_id", "index_name", "index_id", "n_shards"))
    shards = shards.withColumn("at", F.concat_ws("/", "index_name", "shard"))
    texts = write_shared(shard_manifests_of(shards.drop("n_shards")), "manifest_texts")
    manifests = parse_shards(found(texts, "shard", "at").drop("at"))
    containers = [
        container_files("snapshot", chosen),
        container_files("global", chosen),
        container_files("index", held),
        container_files("shard", shards),
    ]
    tables = {
        "snapshots": report.snapshots(catalog),
        "snapshot_indices": report.snapshot_indices(catalog, source),
        "snapshot": report.snapshot_summary(described),
        "templates": report.template_names(globals_, source),
        "indices": indices,
        "shards": report.shard_manifests(manifests),
        "missing": reduce(DataFrame.unionByName, missing),
        "broken": write_shared(container_problems(reduce(DataFrame.unionByName, containers)), "containers"),
    }
    if documents is not None:
        stored = read_documents(spark, documents) if isinstance(documents, str) else documents
        tables["documents"] = report.document_fields(stored)
    return tables
