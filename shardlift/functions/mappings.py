"""Mappings out of their type wrapper."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardlift.fixed import MAPPING_WRAPPERS
from shardlift.functions.jsontext import entries, is_array, is_object, keys_of, let, member


def unwrap_mappings(text: Column, wrappers: Sequence[str] = MAPPING_WRAPPERS) -> Column:
    """struct<value, problem> for mappings like `[{"_doc": {...}}]`.

    Only element 0 of an array is looked at. Anything but an array of objects is left alone, and so
    is a wrapper whose own value is not an object. An empty array and an unknown wrapper are problems.
    """

    def choose(t: Column, holder: Column, names: Column) -> Column:
        inner = reduce(
            lambda chain, name: chain.when(F.array_contains(names, name), member(holder, name)),
            wrappers[1:],
            F.when(F.array_contains(names, wrappers[0]), member(holder, wrappers[0])),
        )
        wrapped = t.rlike(r"^\s*\[\s*\{")
        problem = F.when(t.rlike(r"^\s*\[\s*\]\s*$"), F.lit("mappings array is empty"))
        return let(
            inner,
            lambda found: F.struct(
                F.when(wrapped & is_object(found), found).otherwise(t).alias("value"),
                problem.when(
                    wrapped & found.isNull(), F.lit("mappings have none of the expected wrappers")
                ).alias("problem"),
            ),
        )

    def first_element(t: Column) -> Column:
        return entries(F.get(F.from_json(t, "array<string>"), F.lit(0)))

    return let(
        text,
        lambda t: let(
            F.when(is_array(F.ltrim(t)), first_element(t)),
            lambda holder: let(keys_of(holder), lambda names: choose(t, holder, names)),
        ),
    )
