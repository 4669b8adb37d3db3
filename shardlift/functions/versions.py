"""Version and movement names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardlift.fixed import (
    MOVEMENTS,
    SOURCE_VERSIONS,
    TARGET_VERSIONS,
    VERSION_ID_PREFIXES,
    VERSION_NAMES,
)


def version_of(version_id: Column) -> Column:
    """Source version of a numeric version id, null when it is none we know."""
    text = version_id.cast("string")
    result = F.lit(None).cast("string")
    for prefix, version in VERSION_ID_PREFIXES.items():
        result = F.when(F.startswith(text, F.lit(prefix)), F.lit(version)).otherwise(result)
    return result


def parse_source(name: str) -> str:
    version = VERSION_NAMES.get(name)
    if version not in SOURCE_VERSIONS:
        raise ValueError(f"unsupported source version: {name}")
    return version


def parse_target(name: str) -> str:
    version = VERSION_NAMES.get(name)
    if version not in TARGET_VERSIONS:
        raise ValueError(f"unsupported target version: {name}")
    return version


def parse_movement(name: str) -> str:
    if name not in MOVEMENTS:
        raise ValueError(f"unknown movement: {name}")
    return name
