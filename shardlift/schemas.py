"""Schemas of the fixed-shape records and of the tables the operators exchange."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _INT, _LONG, _BOOL, _BYTES = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.BooleanType(),
    T.BinaryType(),
)
_TEXTS = T.ArrayType(_TEXT)
_TEXT_MAP = T.MapType(_TEXT, _TEXT)
_ANY, _ANYS = T.VariantType(), T.ArrayType(T.VariantType())


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_SHOT = {"name": _TEXT, "uuid": _TEXT, "state": _INT}
_ENTRY = {"id": _TEXT, "snapshots": _TEXTS}
CATALOG = {
    "6.8": _record(
        snapshots=T.ArrayType(_record(**_SHOT)),
        indices=T.MapType(_TEXT, _record(**_ENTRY)),
    ),
    "7.10": _record(
        snapshots=T.ArrayType(_record(**_SHOT, index_metadata_lookup=_TEXT_MAP, version=_TEXT)),
        indices=T.MapType(_TEXT, _record(**_ENTRY, shard_generations=_TEXTS)),
        min_version=_TEXT,
        index_metadata_identifiers=_TEXT_MAP,
    ),
}

_SNAPSHOT = {
    "name": _TEXT,
    "uuid": _TEXT,
    "version_id": _INT,
    "indices": _TEXTS,
    "state": _TEXT,
    "reason": _TEXT,
    "include_global_state": _BOOL,
    "start_time": _LONG,
    "end_time": _LONG,
    "total_shards": _INT,
    "successful_shards": _INT,
    "failures": _ANYS,
}
SNAPSHOT = {
    "6.8": _record(**_SNAPSHOT),
    "7.10": _record(**_SNAPSHOT, data_streams=_ANYS, metadata=_ANY),
}

FILE_INFO = _record(
    name=_TEXT,
    physical_name=_TEXT,
    length=_LONG,
    checksum=_TEXT,
    part_size=_LONG,
    written_by=_TEXT,
    meta_hash=_TEXT,
)
# Keys a file record must have; others are ignored, `meta_hash` is optional.
FILE_INFO_REQUIRED = ("name", "physical_name", "length", "checksum", "part_size", "written_by")
SHARD = _record(
    name=_TEXT,
    index_version=_INT,
    start_time=_LONG,
    time=_LONG,
    number_of_files=_INT,
    total_size=_LONG,
    files=T.ArrayType(FILE_INFO),
)

DOCUMENT = _record(index=_TEXT, shard=_INT, ord=_LONG, _id=_BYTES, _source=_BYTES)
TARGET_STATE = _record(kind=_TEXT, name=_TEXT, status=_INT)
VIOLATION = _record(repo_id=_TEXT, rule=_TEXT, subject=_TEXT, detail=_TEXT)
