"""Lookups over the catalog: snapshots, their indices, and where each index keeps its metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlift.functions.inrow import blocks_of, found_in
from shardlift.functions.jsontext import let
from shardlift.unnest import unnest


def list_snapshots(catalog: DataFrame) -> DataFrame:
    return unnest(catalog.select("repo_id", "snapshots"), "snapshots", "pos", "snapshot").select(
        "repo_id",
        "pos",
        F.col("snapshot.name").alias("snapshot_name"),
        F.col("snapshot.uuid").alias("snapshot_id"),
    )


def _first_named(name: Column | str) -> Column:
    wanted = F.lit(name) if isinstance(name, str) else name
    return F.get(F.filter("snapshots", lambda s: s["name"] == wanted), F.lit(0))


def snapshot_id(name: Column | str) -> Column:
    """Id of the first snapshot of that name, null if there is none."""
    return _first_named(name)["uuid"]


def index_entries(catalog: DataFrame) -> DataFrame:
    """One row per index of each repository."""
    return unnest(catalog.select("repo_id", "indices"), "indices", "pos", "index_name", "entry").select(
        "repo_id", "index_name", F.col("entry.id").alias("index_id"), F.col("entry.snapshots").alias("members")
    )


def _named_snapshots(catalog: DataFrame) -> DataFrame:
    """A row per snapshot name with its `snapshot`; a name used twice stands for its first snapshot.

    Found by neighbours in the sorted names of each row; the other columns of the catalog are kept.
    """
    names = F.transform("snapshots", lambda s, i: F.struct(s["name"].alias("name"), i.alias("pos")))

    def firsts(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda e, i: (i == 0) | ~F.get(ordered, i - 1)["name"].eqNullSafe(e["name"]),
        )

    return unnest(catalog, let(F.array_sort(names), firsts), "at", "head").withColumn(
        "snapshot", F.get("snapshots", F.col("head.pos"))
    )


def _listed(snapshot: Column) -> Column:
    """Indices of a 7.10 catalog row that a snapshot lists: struct<pos, index_name, index_id, lookup_key>."""

    def entry(wanted: Column, e: Column) -> Column:
        return let(
            found_in(wanted, e["value"]["id"]),
            lambda at: F.struct(
                at["pos"].alias("pos"),
                e["key"].alias("index_name"),
                e["value"]["id"].alias("index_id"),
                at["value"].alias("lookup_key"),
            ),
        )

    return let(
        blocks_of(snapshot["index_metadata_lookup"]),
        lambda wanted: F.filter(
            F.transform(F.map_entries("indices"), lambda e: entry(wanted, e)), lambda i: i["pos"].isNotNull()
        ),
    )


def indices_in_snapshot(catalog: DataFrame, name: Column | str, version: str) -> DataFrame:
    """(repo_id, snapshot_id, pos, index_name, index_id, file_id) of one named snapshot per repository.

    6.8 lists the snapshots inside each index entry, so the match stays inside the catalog row and the
    metadata file goes by the snapshot id. 7.10 lists index ids inside the snapshot and files by lookup
    keys: three maps of one row, joined there block by block, so nothing is shuffled and nothing is
    exploded but the result.
    """
    if version == "6.8":
        matched = F.filter(
            F.map_entries("indices"), lambda e: F.array_contains(e["value"]["snapshots"], F.col("snapshot_id"))
        )
        named = catalog.withColumn("snapshot_id", snapshot_id(name))
        return unnest(named, matched, "pos", "index").select(
            "repo_id",
            "snapshot_id",
            "pos",
            F.col("index.key").alias("index_name"),
            F.col("index.value.id").alias("index_id"),
            F.col("snapshot_id").alias("file_id"),
        )
    def with_files(listed: Column) -> Column:
        return let(
            blocks_of(F.col("index_metadata_identifiers")),
            lambda files: F.transform(
                listed, lambda i: F.struct(i.alias("index"), found_in(files, i["lookup_key"])["value"].alias("file_id"))
            ),
        )

    chosen = catalog.withColumn("snapshot", _first_named(name))
    return unnest(chosen, with_files(_listed(F.col("snapshot"))), "at", "found").select(
        "repo_id",
        F.col("snapshot.uuid").alias("snapshot_id"),
        "found.index.pos",
        "found.index.index_name",
        "found.index.index_id",
        "found.file_id",
    )


def all_snapshot_indices(catalog: DataFrame, version: str) -> DataFrame:
    """Indices of every snapshot (R2); a name used twice stands for its first snapshot."""
    if version != "6.8":
        return unnest(
            _named_snapshots(catalog), _listed(F.col("snapshot")), "index_at", "index"
        ).select(
            "repo_id",
            F.col("snapshot.name").alias("snapshot_name"),
            F.col("snapshot.uuid").alias("snapshot_id"),
            "index.index_name",
            "index.index_id",
        )
    heads = list_snapshots(catalog).groupBy("repo_id", "snapshot_name").agg(F.min_by("snapshot_id", "pos").alias("snapshot_id"))
    held = unnest(index_entries(catalog), F.array_distinct("members"), "member_pos", "snapshot_id")
    return heads.join(held, ["repo_id", "snapshot_id"]).select(
        "repo_id", "snapshot_name", "snapshot_id", "index_name", "index_id"
    )


def index_ids(wanted: DataFrame, catalog: DataFrame) -> DataFrame:
    """Index id of (repo_id, index_name) rows; null when the repository has no such index."""
    return wanted.join(
        index_entries(catalog).select("repo_id", "index_name", "index_id"),
        ["repo_id", "index_name"],
        "left",
    )


def index_file_ids(wanted: DataFrame, catalog: DataFrame, version: str) -> DataFrame:
    """Metadata file id of (repo_id, snapshot_name, index_name) rows; null where any hop finds nothing."""
    rows = index_ids(wanted, catalog)
    if version == "6.8":
        heads = list_snapshots(catalog).groupBy("repo_id", "snapshot_name").agg(
            F.min_by("snapshot_id", "pos").alias("file_id")
        )
        return rows.join(heads, ["repo_id", "snapshot_name"], "left")
    # A name used twice: the first snapshot of that name answers, even when it lacks the index.
    named = _named_snapshots(catalog.withColumn("files", blocks_of(F.col("index_metadata_identifiers"))))
    lookups = unnest(named, F.col("snapshot.index_metadata_lookup"), "index_at", "index_id", "lookup_key").select(
        "repo_id",
        F.col("snapshot.name").alias("snapshot_name"),
        "index_id",
        found_in(F.col("files"), F.col("lookup_key"))["value"].alias("file_id"),
    )
    return rows.join(lookups, ["repo_id", "snapshot_name", "index_id"], "left")
