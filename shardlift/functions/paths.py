"""Names and paths: repository files, blob parts, target requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardlift.fixed import INLINE_FILE_PREFIX, REQUEST_PREFIXES

GENERATION = r"^index-(\d+)$"


def trim_root(uri: Column) -> Column:
    """A repository root without one trailing slash."""
    return F.regexp_replace(uri, "/$", "")


def global_metadata_path(root: Column, snapshot_id: Column, ext: str = ".dat") -> Column:
    return F.concat(trim_root(root), F.lit("/meta-"), snapshot_id, F.lit(ext))


def snapshot_path(root: Column, snapshot_id: Column, ext: str = ".dat") -> Column:
    return F.concat(trim_root(root), F.lit("/snap-"), snapshot_id, F.lit(ext))


def index_metadata_path(root: Column, index_id: Column, file_id: Column, ext: str = ".dat") -> Column:
    return F.concat(trim_root(root), F.lit("/indices/"), index_id, F.lit("/meta-"), file_id, F.lit(ext))


def shard_dir(root: Column, index_id: Column, shard: Column) -> Column:
    return F.concat(trim_root(root), F.lit("/indices/"), index_id, F.lit("/"), shard.cast("string"))


def shard_path(
    root: Column, snapshot_id: Column, index_id: Column, shard: Column, ext: str = ".dat"
) -> Column:
    return F.concat(shard_dir(root, index_id, shard), F.lit("/snap-"), snapshot_id, F.lit(ext))


def blob_path(root: Column, index_id: Column, shard: Column, blob: Column) -> Column:
    return F.concat(shard_dir(root, index_id, shard), F.lit("/"), blob)


def generation(file_name: Column) -> Column:
    """Generation number of a catalog file name; null when the name is not a catalog's."""
    return F.regexp_extract(file_name, GENERATION, 1).try_cast("bigint")


def is_inline(name: Column) -> Column:
    """Files whose bytes are kept in the manifest."""
    return F.startswith(name, F.lit(INLINE_FILE_PREFIX))


def part_count(length: Column, part_size: Column) -> Column:
    """Parts a file is cut into: at least one, null when the part size is not positive."""
    size = F.when(part_size > 0, part_size)
    whole = F.call_function("div", length, size)
    started = (length % size > 0).cast("bigint")
    return F.when(part_size > 0, F.greatest(F.lit(1), whole + started))


def part_name(name: Column, parts: Column, part: Column) -> Column:
    return F.when(parts > 1, F.concat(name, F.lit(".part"), part.cast("string"))).otherwise(name)


def request_path(kind: Column, name: Column) -> Column:
    """Path of a create request for a template or an index."""
    prefix = F.create_map(*[F.lit(x) for pair in REQUEST_PREFIXES.items() for x in pair])
    return F.concat(F.element_at(prefix, kind), name)


def document_path(index: Column, doc_id: Column) -> Column:
    """Path of a document write, with the id escaped."""
    return F.concat(index, F.lit("/_doc/"), F.replace(F.url_encode(doc_id), F.lit("+"), F.lit("%20")))
