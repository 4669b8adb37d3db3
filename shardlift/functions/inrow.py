"""Look-ups inside a row: maps of one row joined without a shuffle and without a scan for each key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardlift.functions.jsontext import let

# Entries of a block. A look-up compares its key with the first key of every block and all keys of one.
BLOCK = 64


def blocks_of(held: Column) -> Column:
    """The entries of a map as struct<key, pos, value>, sorted by key and cut into blocks for `found_in`.

    `pos` is the place of the entry in the map. A missing or empty map has no blocks.
    """
    placed = F.transform(
        F.map_entries(held),
        lambda e, i: F.struct(e["key"].alias("key"), i.alias("pos"), e["value"].alias("value")),
    )

    def cut(ordered: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(ordered), F.lit(BLOCK))
        return F.when(F.size(ordered) > 0, F.transform(starts, lambda at: F.slice(ordered, at, F.lit(BLOCK))))

    return let(F.array_sort(placed), cut)


def found_in(blocks: Column, key: Column) -> Column:
    """The struct<key, pos, value> of a key, or null. Of a key that JSON repeats, the last value counts."""
    before = F.filter(blocks, lambda block: F.get(block, F.lit(0))["key"] <= key)
    return let(
        F.try_element_at(before, F.lit(-1)),
        lambda block: F.try_element_at(F.filter(block, lambda e: e["key"] == key), F.lit(-1)),
    )
