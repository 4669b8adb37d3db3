"""File bytes from a repository, read where they lie.

Blob names start with `__`, which Spark's file sources skip as hidden, and blobs can exceed the size
of one value. So the manifest, which names every blob, is turned into byte ranges of bounded size;
the ranges are spread over tasks and each task reads its own. File content is never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlift.functions.paths import blob_path, shard_dir
from shardlift.operators.packing import packed

RANGE_BYTES = 32 * 1024 * 1024
TASK_BYTES = 512 * 1024 * 1024
# Bytes of ranges after which an output batch ends.
BATCH_BYTES = 1024 * 1024
# Folders that one task lists, files that one task reads whole, and files of one batch of a listing.
TASK_FOLDERS = 64
TASK_TEXTS = 64
LISTED_ROWS = 10_000
_WITH_SCHEME = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/]*)(/.*)$")


@lru_cache(maxsize=64)
def _file_system(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def open_path(path: str):
    """File system and path of a file; one client per bucket and process. Paths without a scheme are local."""
    parts = _WITH_SCHEME.match(path)
    if not parts or parts[1] == "file":
        return _file_system("file:///")[0], parts[3] if parts else path.removeprefix("file:")
    scheme = "s3" if parts[1] in ("s3a", "s3n") else parts[1]
    files, base = _file_system(f"{scheme}://{parts[2]}/")
    return files, base.rstrip("/") + parts[3]


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        for row in range(batch.num_rows):
            files, path = open_path(batch.column("folder")[row].as_py())
            found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
            names = [(f.base_name, f.size) for f in found if f.type == fs.FileType.File]
            one = batch.slice(row, 1)
            for start in range(0, len(names), LISTED_ROWS):
                part = names[start : start + LISTED_ROWS]
                kept = one.take(pa.array([0] * len(part), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array([n for n, _ in part]), pa.array([z for _, z in part], pa.int64())],
                    [*batch.schema.names, "name", "length"],
                )


def listed_files(folders: DataFrame) -> DataFrame:
    """Rows with a `folder` to a row for each file right in it, with `name` and `length`; none where it is not there.

    Each row is one listing, done in a task; give every folder once. Nothing is listed on the driver.
    """
    columns = [T.StructField("name", T.StringType()), T.StructField("length", T.LongType())]
    schema = T.StructType([*folders.schema.fields, *columns])
    return packed(folders, F.lit(1), ["folder"], TASK_FOLDERS).mapInArrow(_listed, schema)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        texts = []
        for uri in batch.column("path").to_pylist():
            if uri is None:
                texts.append(None)
                continue
            files, path = open_path(uri)
            if files.get_file_info(path).type != fs.FileType.File:
                texts.append(None)
                continue
            with files.open_input_file(path) as source:
                texts.append(source.read().decode("utf-8", "replace"))
        column = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "value"])


def read_texts(rows: DataFrame) -> DataFrame:
    """Rows with the text of the file at `path` in `value`, null where there is none; nothing is listed."""
    schema = T.StructType([*rows.schema.fields, T.StructField("value", T.StringType())])
    return packed(rows, F.lit(1), ["path"], TASK_TEXTS).mapInArrow(_texts, schema)


def with_blob_paths(parts: DataFrame) -> DataFrame:
    return parts.withColumn(
        "path", blob_path(F.col("repo_id"), F.col("index_id"), F.col("shard"), F.col("blob_name"))
    ).withColumn("folder", shard_dir(F.col("repo_id"), F.col("index_id"), F.col("shard")))


def byte_ranges(start: Column, length: Column, size: int = RANGE_BYTES) -> Column:
    """array<struct<at, count>> covering `length` bytes of a part that begins at `start` of its file."""
    last = F.greatest(F.call_function("div", length - 1, F.lit(size)), F.lit(0))
    return F.when(
        length > 0,
        F.transform(
            F.sequence(F.lit(0).cast("bigint"), last),
            lambda i: F.struct(
                (i * size).alias("at"),
                F.least(F.lit(size).cast("bigint"), length - i * size).alias("count"),
                (start + i * size).alias("offset"),
            ),
        ),
    )


def read_ranges(ranges: DataFrame) -> DataFrame:
    """Rows with (path, at, count) to the same rows with `content`, partition by partition."""
    columns = [f for f in ranges.schema.fields if f.name not in ("path", "at", "count")]
    schema = T.StructType([*columns, T.StructField("content", T.BinaryType())])
    names = [f.name for f in columns]

    def rows(batch: pa.RecordBatch, start: int, contents: list[bytes]) -> pa.RecordBatch:
        kept = [batch.column(n).slice(start, len(contents)) for n in names]
        return pa.RecordBatch.from_arrays([*kept, pa.array(contents, pa.binary())], [*names, "content"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = None
        opened: str | None = None
        try:
            for batch in batches:
                wanted = zip(
                    batch.column("path").to_pylist(),
                    batch.column("at").to_pylist(),
                    batch.column("count").to_pylist(),
                    strict=True,
                )
                # Small ranges share an output batch; memory stays near one range whatever the batch held.
                contents: list[bytes] = []
                start = size = 0
                for row, (uri, at, count) in enumerate(wanted):
                    # Neighbouring ranges mostly lie in one blob, which stays open.
                    if uri != opened:
                        if source is not None:
                            source.close()
                        files, path = open_path(uri)
                        source = files.open_input_file(path)
                        opened = uri
                    source.seek(at)
                    content = source.read(count)
                    if len(content) != count:
                        raise OSError(f"{uri} ends before byte {at + count}")
                    contents.append(content)
                    size += count
                    if size >= BATCH_BYTES:
                        yield rows(batch, start, contents)
                        contents, start, size = [], row + 1, 0
                if contents:
                    yield rows(batch, start, contents)
        finally:
            if source is not None:
                source.close()

    return ranges.mapInArrow(read, schema)
