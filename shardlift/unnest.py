"""Collections to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(rows: DataFrame, collection: Column | str, *names: str) -> DataFrame:
    """One row per element, as (position, element) or (position, key, value) under the given names.

    A plain explode of a computed collection makes the optimizer test its size first, which computes it
    several times per row. The outer form does not; rows of empty collections are dropped afterwards.
    """
    found = F.posexplode_outer(collection).alias(*names)
    return rows.select("*", found).where(F.col(names[0]).isNotNull())
