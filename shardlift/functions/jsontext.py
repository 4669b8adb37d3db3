"""JSON objects as ordered (key, value text) entries.

Config bodies have no schema, so a body is handled as its top-level entries: the value of each
entry is JSON text that keeps its type (`"1"` and `1` differ) and, for objects and arrays, the
order of the input; numbers may be written anew (`1.10` as `1.1`). A change to one member touches that
member only. Of keys that an object repeats, at any depth, the last value counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def quote(text: Column) -> Column:
    """A string as a JSON string literal."""
    return let(
        F.to_json(F.array(text)), lambda wrapped: F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)
    )


def is_object(text: Column) -> Column:
    return F.coalesce(F.startswith(text, F.lit("{")), F.lit(False))


def is_array(text: Column) -> Column:
    return F.coalesce(F.startswith(text, F.lit("[")), F.lit(False))


def _allow_repeated_keys() -> None:
    """Variants are used to tell strings from the rest, and by default refuse objects that repeat a key."""
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.conf.get(_REPEATED_KEYS, "false") != "true":
        spark.conf.set(_REPEATED_KEYS, "true")


def _is_container(text: Column, value: Column) -> Column:
    """Whether a variant of this text is an object or an array; otherwise it is a scalar, strings like `{` too.

    The cast looks at the kind alone. Writing the variant as JSON, or its schema, would go through all it holds.
    """

    def held(kind: str) -> Column:
        return F.try_variant_get(value, "$", kind).isNotNull()

    return F.when(is_object(text), held("struct<>")).when(is_array(text), held("array<struct<>>"))


def entries(text: Column) -> Column:
    """array<struct<key, value>> of a JSON object in document order; null if it is not an object.

    A repeated key stands where it is first, with its last value.
    """
    _allow_repeated_keys()

    def entry(pair: Column, value: Column) -> Column:
        text_ = pair["value"]
        kept = (
            F.when(text_.isNull(), F.lit("null"))
            .when(_is_container(text_, value), text_)
            .when(F.schema_of_variant(value) == "STRING", quote(text_))
            .otherwise(text_)
        )
        return F.struct(pair["key"].alias("key"), kept.alias("value"))

    def last_of(items: Column, key: Column) -> Column:
        return F.element_at(F.filter(items, lambda e: e["key"] == key), -1)

    def single(items: Column) -> Column:
        return let(
            F.array_distinct(keys_of(items)),
            lambda keys: F.when(F.size(keys) == F.size(items), items).otherwise(
                F.transform(keys, lambda k: last_of(items, k))
            ),
        )

    return let(
        let(
            text,
            lambda t: F.zip_with(
                F.map_entries(F.from_json(t, "map<string,string>")),
                F.map_values(F.from_json(t, "map<string,variant>")),
                entry,
            ),
        ),
        single,
    )


def object_text(items: Column) -> Column:
    """Entries back to a JSON object."""
    members = F.transform(items, lambda e: F.concat(quote(e["key"]), F.lit(":"), e["value"]))
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def keys_of(items: Column) -> Column:
    return F.transform(items, lambda e: e["key"])


def member(items: Column, key: str | Column) -> Column:
    """Value text of a key, or null when the key is absent."""
    found = F.filter(items, lambda e: e["key"] == key)
    return F.get(found, F.lit(0))["value"]


def has_member(items: Column, key: str) -> Column:
    return F.coalesce(F.exists(items, lambda e: e["key"] == key), F.lit(False))


def replace_member(items: Column, key: str, value: Column) -> Column:
    """Give an existing key a new value in place; an absent key stays absent."""

    def put(new: Column) -> Column:
        return F.transform(
            items,
            lambda e: F.struct(
                e["key"].alias("key"), F.when(e["key"] == key, new).otherwise(e["value"]).alias("value")
            ),
        )

    return let(value, put)


def as_int(text: Column) -> Column:
    """Integer reading of a JSON value: numeric strings count, anything else is 0."""

    def plain_int(plain: Column) -> Column:
        return let(
            plain.try_cast("double"),
            lambda real: F.when(plain == "true", F.when(text == "true", F.lit(1)).otherwise(F.lit(0)))
            .when(plain.rlike(r"^[+-]?[0-9]+$"), F.coalesce(plain.try_cast("int"), F.lit(0)))
            .when(real.isNull() | F.isnan(real), F.lit(0))
            .otherwise(
                F.least(F.greatest(real, F.lit(-2147483648.0)), F.lit(2147483647.0)).cast("int")
            ),
        )

    is_string = F.startswith(text, F.lit('"'))
    inside = F.substring(text, F.lit(2), F.length(text) - 2)
    return let(F.trim(F.when(is_string, inside).otherwise(text)), plain_int)
