"""Metadata files of repositories as a data source: listed and read in tasks, filters pushed to the listing.

`spark.read.format("shardlift_repository").option("repos", json list)` gives a row for each metadata file:
(repo_id, kind, snapshot_id, index_id, file_id, shard, file_name, value), with null for ids that a kind does not have.
Kinds are `catalog`, `snapshot`, `global`, `index` and `shard`. Filters on repo_id, kind, snapshot_id and index_id
(equality and `IN`) decide which folders are listed and which files are opened; nothing is listed on the driver.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from shardlift.sources.blobs import open_path
from shardlift.sources.roots import asked_names

NAME = "shardlift_repository"
KINDS = ("catalog", "snapshot", "global", "index", "shard")
SCHEMA = (
    "repo_id string, kind string, snapshot_id string, index_id string, file_id string, shard int, file_name string,"
    " value string"
)
# Partitions among which the index folders of a repository are dealt, by a hash of their ids.
SPLITS = 16
_PUSHED = ("repo_id", "kind", "snapshot_id", "index_id")
_NAMES = {
    "catalog": re.compile(r"^index-(\d+)$"),
    "snapshot": re.compile(r"^snap-(.+)\.json$"),
    "global": re.compile(r"^meta-(.+)\.json$"),
    "index": re.compile(r"^meta-(.+)\.json$"),
    "shard": re.compile(r"^snap-(.+)\.json$"),
}
_BATCH_BYTES = 8 * 1024 * 1024
_BATCH_ROWS = 256


@dataclass
class RepositoryPart(InputPartition):
    """One repository's files of a kind; of index folders those of one split."""

    repo_id: str
    kind: str
    split: int = 0
    splits: int = 1


class RepositorySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RepositoryReader:
        return RepositoryReader(self.options)


class RepositoryReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.repos: list[str] = json.loads(options["repos"])
        self.splits = int(options.get("splits", SPLITS))
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Takes over equality with constants; everything else stays with Spark."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            if column not in _PUSHED:
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            known = self.wanted.get(column)
            self.wanted[column] = values if known is None else known & values

    def _takes(self, column: str, value: str | None) -> bool:
        return column not in self.wanted or value in self.wanted[column]

    def partitions(self) -> Sequence[InputPartition]:
        parts = []
        for repo in self.repos:
            for kind in KINDS:
                if not (self._takes("repo_id", repo) and self._takes("kind", kind)):
                    continue
                # Kinds without an id have null there, which equals nothing.
                if "index_id" in self.wanted and kind not in ("index", "shard"):
                    continue
                if "snapshot_id" in self.wanted and kind in ("catalog", "index"):
                    continue
                n = self.splits if kind in ("index", "shard") else 1
                parts += [RepositoryPart(repo, kind, k, n) for k in range(n)]
        # Spark wants a partition to read, if only an empty one.
        return parts or [RepositoryPart("", "")]

    def read(self, partition: RepositoryPart) -> Iterator[pa.RecordBatch]:
        if not partition.kind:
            return
        rows: list[dict] = []
        size = 0
        for row in self._files(partition):
            rows.append(row)
            size += len(row["value"])
            if len(rows) >= _BATCH_ROWS or size >= _BATCH_BYTES:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    def _files(self, part: RepositoryPart) -> Iterator[dict]:
        if part.kind == "catalog":
            names = [(int(m[1]), m[0]) for m in map(_NAMES["catalog"].match, _names(part.repo_id)) if m]
            # Older generations are history.
            for _, name in sorted(names)[-1:]:
                yield from self._file(part, part.repo_id, name)
        elif part.kind in ("snapshot", "global"):
            for name, ident in self._matching(part.kind, part.repo_id):
                yield from self._file(part, part.repo_id, name, snapshot_id=ident)
        else:
            for index_id in self._index_ids(part):
                folder = f"{part.repo_id}/indices/{index_id}"
                if part.kind == "index":
                    for name, ident in self._matching("index", folder):
                        yield from self._file(part, folder, name, index_id=index_id, file_id=ident)
                    continue
                for shard in sorted(n for n in _names(folder, folders=True) if n.isdecimal()):
                    inner = f"{folder}/{shard}"
                    for name, ident in self._matching("shard", inner):
                        yield from self._file(part, inner, name, index_id=index_id, shard=int(shard), snapshot_id=ident)

    def _index_ids(self, part: RepositoryPart) -> list[str]:
        asked = self.wanted.get("index_id")
        names = sorted(asked) if asked is not None else _names(f"{part.repo_id}/indices", folders=True)
        return [n for n in names if n and zlib.crc32(n.encode()) % part.splits == part.split]

    def _matching(self, kind: str, folder: str) -> list[tuple[str, str]]:
        """Names and the ids in them. Snapshots that were asked for are named, so their folder is not listed."""
        asked = self.wanted.get("snapshot_id") if kind != "index" else None
        if asked is not None:
            head = "meta" if kind == "global" else "snap"
            return [(f"{head}-{ident}.json", ident) for ident in sorted(i for i in asked if i)]
        return [(m[0], m[1]) for m in map(_NAMES[kind].match, sorted(_names(folder))) if m]

    def _file(self, part: RepositoryPart, folder: str, name: str, **ids) -> Iterator[dict]:
        from pyarrow import fs

        files, path = open_path(f"{folder}/{name}")
        if files.get_file_info(path).type == fs.FileType.File:
            with files.open_input_file(path) as source:
                text = source.read().decode("utf-8", "replace")
            yield {"repo_id": part.repo_id, "kind": part.kind, **ids, "file_name": name, "value": text}


def _names(folder: str, folders: bool = False) -> list[str]:
    from pyarrow import fs

    files, path = open_path(folder)
    wanted = fs.FileType.Directory if folders else fs.FileType.File
    return [f.base_name for f in files.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.type == wanted]


_ARROW = pa.schema(
    [
        ("repo_id", pa.string()),
        ("kind", pa.string()),
        ("snapshot_id", pa.string()),
        ("index_id", pa.string()),
        ("file_id", pa.string()),
        ("shard", pa.int32()),
        ("file_name", pa.string()),
        ("value", pa.string()),
    ]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _ARROW)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, and lets Spark hand filters to sources written in Python."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RepositorySource)


def read_repository(spark: SparkSession, repos: str | Sequence[str], splits: int = SPLITS) -> DataFrame:
    """All metadata files of repositories that are named by their roots; filter it, and only those are looked at."""
    register(spark)
    names = [re.sub(r"(?<=[^/])/+$", "", re.sub(r"^file:/+", "/", n)) for n in asked_names(spark, repos).values()]
    return spark.read.format(NAME).option("repos", json.dumps(names)).option("splits", splits).load()


def metadata_files(spark: SparkSession, repos: str | Sequence[str], kind: str) -> DataFrame:
    """Files of one kind with the ids of their paths, as `read_metadata` and `read_catalog_files` give them."""
    ids = {
        "catalog": ["file_name"],
        "snapshot": ["snapshot_id"],
        "global": ["snapshot_id"],
        "index": ["index_id", "file_id"],
        "shard": ["index_id", "shard", "snapshot_id"],
    }[kind]
    return read_repository(spark, repos).where(F.col("kind") == kind).select("repo_id", *ids, "value")
