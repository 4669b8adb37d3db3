"""Shard files as rows of bytes in order, or as files."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlift.operators.files import file_parts, inline_files
from shardlift.operators.packing import packed
from shardlift.shared import delete_folder, shared_name, write_shared
from shardlift.sources.blobs import RANGE_BYTES, TASK_BYTES, byte_ranges, open_path, read_ranges, with_blob_paths
from shardlift.unnest import unnest


KEYS = ("repo_id", "index_name", "shard", "physical_name")
# Opening a blob counts like this many bytes.
OPENING_BYTES = 256 * 1024


def file_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Byte ranges of all files kept in blobs; an empty file has none."""
    parts = with_blob_paths(file_parts(files))
    ranges = byte_ranges(F.col("part_offset"), F.col("part_length"), range_bytes)
    return unnest(parts, ranges, "i", "r").select(*KEYS, "index_id", "path", "r.at", "r.count", "r.offset")


def packed_ranges(files: DataFrame, task_bytes: int = TASK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The ranges in tasks of equal bytes, in the order of the files; a file runs over as many tasks as it needs."""
    spread = [*(F.col(k) for k in KEYS), F.call_function("div", F.col("offset"), F.lit(task_bytes))]
    ranges = file_ranges(files, range_bytes)
    # A blob stays open for its further ranges.
    opening = F.when(F.col("at") == 0, OPENING_BYTES).otherwise(0)
    return packed(ranges, F.col("count") + opening, [*KEYS, "offset"], task_bytes, spread)


def _bare_rows(files: DataFrame) -> DataFrame:
    """Rows (keys, offset, content) of files that need no blob: empty ones and those kept in the manifest."""
    at_start = F.lit(0).cast("bigint").alias("offset")
    stored = file_parts(files).where(F.col("length") == 0)
    empty = stored.select(*KEYS, at_start, F.unhex(F.lit("")).alias("content"))
    return empty.unionByName(inline_files(files).select(*KEYS, at_start, F.col("meta_hash").alias("content")))


def shard_file_rows(files: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(repo_id, index_name, shard, physical_name, offset, content) of all files of all shards.

    An empty file kept in blobs has one row without bytes, like an empty inline file.
    """
    stored = read_ranges(packed_ranges(files, task_bytes)).select(*KEYS, "offset", "content")
    return stored.unionByName(_bare_rows(files))


def write_shard_rows(files: DataFrame, path: str) -> None:
    """All shard files as parquet rows; running it again replaces them."""
    shard_file_rows(files).write.mode("overwrite").parquet(path)


def _pieces(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Copies ranges to files of this attempt: neighbouring ranges of one file go to one piece."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = uuid.uuid4().hex
        row: dict | None = None
        out = source = None
        opened: str | None = None
        done: list[dict] = []
        n = 0
        files, base = open_path(folder)
        try:
            for batch in batches:
                for wanted in batch.select([*KEYS, "path", "at", "count", "offset"]).to_pylist():
                    key = [wanted[k] for k in KEYS]
                    if row is None or [row[k] for k in KEYS] != key or row["offset"] + row["length"] != wanted["offset"]:
                        if row is not None:
                            out.close()
                            done.append(row)
                        if len(done) >= _BATCH_ROWS:
                            yield pa.RecordBatch.from_pylist(done, _PIECES)
                            done = []
                        if n == 0:
                            files.create_dir(base, recursive=True)
                        name = f"{attempt}-{n}"
                        n += 1
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                        row = dict(zip(KEYS, key, strict=True))
                        row |= {"offset": wanted["offset"], "length": 0, "piece": f"{folder}/{name}"}
                    # Neighbouring ranges mostly lie in one blob, which stays open.
                    if wanted["path"] != opened:
                        if source is not None:
                            source.close()
                        source_files, source_path = open_path(wanted["path"])
                        source = source_files.open_input_file(source_path)
                        opened = wanted["path"]
                    source.seek(wanted["at"])
                    _copy(source, out, wanted["count"], wanted["path"])
                    row["length"] += wanted["count"]
            if row is not None:
                out.close()
                done.append(row)
                yield pa.RecordBatch.from_pylist(done, _PIECES)
        finally:
            if source is not None:
                source.close()

    return copy


# Pieces of one batch: a batch for each piece would cost more than the piece.
_BATCH_ROWS = 1000
_PIECES = pa.schema(
    [
        ("repo_id", pa.string()),
        ("index_name", pa.string()),
        ("shard", pa.int32()),
        ("physical_name", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("piece", pa.string()),
    ]
)
_PIECES_DDL = (
    "repo_id string, index_name string, shard int, physical_name string, offset bigint, length bigint, piece string"
)
_COPY_BYTES = 4 * 1024 * 1024


def _copy(source, out, count: int, name: str) -> None:
    while count:
        content = source.read(min(count, _COPY_BYTES))
        if not content:
            raise OSError(f"{name} ends too early")
        out.write(content)
        count -= len(content)


def _commit(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Puts each file's pieces together under a name of this attempt, and renames it to the file's own."""
    from pyarrow import fs

    def there(path: str, length: int) -> bool:
        files, at = open_path(path)
        info = files.get_file_info(at)
        return info.type == fs.FileType.File and info.size == length

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = set()

        def make(files, parent: str) -> None:
            if parent not in made:
                files.create_dir(parent, recursive=True)
                made.add(parent)

        for batch in batches:
            for row in batch.select(["path", "length", "pieces", "content"]).to_pylist():
                # An earlier attempt of this task may have renamed it already.
                if there(row["path"], row["length"]) and not all(
                    there(p["piece"], p["length"]) for p in row["pieces"] or []
                ):
                    continue
                own = row["pieces"][0]["piece"] if len(row["pieces"] or []) == 1 else f"{folder}/{uuid.uuid4().hex}"
                files, at = open_path(own)
                if len(row["pieces"] or []) != 1:
                    make(files, at.rpartition("/")[0])
                    with files.open_output_stream(at, compression=None) as out:
                        out.write(row["content"] or b"")
                        for piece in row["pieces"] or []:
                            piece_files, piece_at = open_path(piece["piece"])
                            with piece_files.open_input_file(piece_at) as source:
                                _copy(source, out, piece["length"], piece["piece"])
                _, final = open_path(row["path"])
                make(files, final.rpartition("/")[0])
                try:
                    files.move(at, final)
                except OSError:
                    # Another attempt of this task was faster.
                    if not there(row["path"], row["length"]):
                        raise
            yield batch.drop_columns(["pieces", "content"])

    return commit


def _safe(name: Column) -> Column:
    """A name as one step of a path."""
    return F.regexp_replace(F.replace(name, F.lit("/"), F.lit("%2F")), r"^\.{1,2}$", "%2E")


def file_manifest(path: str) -> str:
    return f"{path}/_manifest"


def write_shard_files(
    files: DataFrame,
    path: str,
    by_repo: bool = False,
    task_bytes: int = TASK_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Every shard file as a file of its own, `<path>/<index>/<shard>/<physical name>`; gives back the manifest.

    Three steps, each of which may be repeated. Tasks copy byte ranges to pieces under names of their attempt; a table
    of the pieces of finished tasks is written. Tasks rename the pieces, several of one file put together first, to
    the files' own names. The manifest (keys, path, length) is written last: what it does not list does not count,
    and a run that was cut off left files in the folder of attempts only, or files that the next run replaces.

    Pieces are cut for equal work. A file of several pieces is put together by one task, as a stream, since no file
    system in use appends from several writers; everything else of a large file is spread. With `by_repo` the first
    folder is the repository.
    """
    spark = files.sparkSession
    root = shared_name(spark, path)
    attempts = f"{root}/_attempts-{uuid.uuid4().hex}"
    listed = write_shared(files, "files")
    copied = packed_ranges(listed, task_bytes, range_bytes).mapInArrow(_pieces(attempts), _PIECES_DDL)
    pieces = write_shared(copied, "pieces")
    of_file = pieces.groupBy(*KEYS).agg(
        F.sum("length").alias("length"),
        F.array_sort(F.collect_list(F.struct("offset", "length", "piece"))).alias("pieces"),
    )
    none = F.lit(None)
    stored = of_file.withColumn("content", none.cast("binary"))
    bare = _bare_rows(listed).select(
        *KEYS,
        F.length("content").cast("bigint").alias("length"),
        none.cast("array<struct<offset:bigint,length:bigint,piece:string>>").alias("pieces"),
        "content",
    )
    first = [_safe(F.regexp_replace("repo_id", "^/", ""))] if by_repo else []
    steps = [F.lit(root), *first, _safe(F.col("index_name")), F.col("shard").cast("string"), _safe(F.col("physical_name"))]
    whole = write_shared(stored.unionByName(bare).withColumn("path", F.concat_ws("/", *steps)), "whole")
    _stop_at_gaps(whole, listed)
    # A single piece is renamed; only what is put together costs bytes.
    work = F.when(F.size("pieces") > 1, F.col("length")).otherwise(0) + OPENING_BYTES
    ready = packed(whole, work, ["path"], task_bytes)
    done = ready.mapInArrow(_commit(attempts), whole.drop("pieces", "content").schema)
    done.write.mode("overwrite").parquet(file_manifest(path))
    delete_folder(spark, attempts)
    return spark.read.parquet(file_manifest(path))


def _stop_at_gaps(whole: DataFrame, files: DataFrame) -> None:
    """Raises if a file's pieces are not all of it; that would be a fault of a source that changed meanwhile."""
    short = (
        files.groupBy(*KEYS)
        .agg(F.max("length").alias("asked"))
        .join(whole.select(*KEYS, "length"), list(KEYS), "left")
        .where(~F.col("length").eqNullSafe(F.col("asked")))
    )
    found = short.limit(1).collect()
    if found:
        raise OSError(f"file {'/'.join(str(found[0][k]) for k in KEYS)} has {found[0]['length']} bytes")


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = []
        for uri, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            system, path = open_path(uri)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            with system.open_output_stream(path, compression=None) as out:
                out.write(content.as_buffer())
            sizes.append(len(content.as_buffer()))
        yield pa.RecordBatch.from_pydict({"bytes": pa.array(sizes, pa.int64())})


def write_blobs(blobs: DataFrame) -> int:
    """Writes (path, content) rows as files, from the tasks, and returns their bytes. Writing one again replaces it."""
    written = blobs.select("path", "content").mapInArrow(_write, "bytes bigint")
    return written.agg({"bytes": "sum"}).first()[0] or 0
