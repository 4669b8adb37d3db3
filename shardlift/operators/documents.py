"""Documents from stored form to the rows the target gets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlift.fixed import TARGET_SUFFIX
from shardlift.functions.ids import decode_id, id_problem, source_text
from shardlift.functions.jsontext import quote
from shardlift.shared import write_shared


def live(docs: DataFrame) -> DataFrame:
    """Documents that have a source. Only the source decides.

    A table with `source_size` says so without its sources: passes that need no source then read none.
    """
    size = F.col("source_size") if "source_size" in docs.columns else F.length("_source")
    return docs.where(size > 0)


def with_id_problem(docs: DataFrame) -> DataFrame:
    return docs.withColumn("problem", id_problem(F.col("_id")))


def decoded(docs: DataFrame) -> DataFrame:
    """Stored id and source as text; the stored columns go."""
    return docs.withColumns({"id": decode_id(F.col("_id")), "source": source_text(F.col("_source"))}).drop(
        "_id", "_source", "source_size"
    )


def target_name(index: Column, suffix: str = TARGET_SUFFIX) -> Column:
    return F.concat(index, F.lit(suffix))


def route(docs: DataFrame, plan: DataFrame, keys: Sequence[str] = ("repo_id", "index")) -> DataFrame:
    """Documents of the planned indices, with their target index.

    The plan has one row per index. Read from a written table its size is known, and Spark broadcasts it
    when it is under the session's threshold; otherwise the join is a shuffle with skew handling.
    """
    return docs.join(plan, list(keys))


def position(shard: Column, ord_: Column, place: Column | None = None) -> Column:
    """Order of writes as one fixed-width number, so that its maximum is a hash aggregate.

    `place` orders the indices that go to one target; a place that is not known comes before all others.
    """
    shard, ord_ = F.coalesce(shard, F.lit(-1)), F.coalesce(ord_, F.lit(-1))
    if place is not None:
        before = F.coalesce(place, F.lit(0)).cast("decimal(8,0)") * F.lit("1" + "0" * 29).cast("decimal(30,0)")
        return (before + position(shard, ord_)).cast("decimal(38,0)")
    return shard.cast("decimal(10,0)") * F.lit("18446744073709551616").cast("decimal(20,0)") + ord_.cast(
        "decimal(20,0)"
    )


def _position_of(docs: DataFrame) -> Column:
    return position(F.col("shard"), F.col("ord"), F.col("place") if "place" in docs.columns else None)


def repeated_keys(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys written more than once, with the position of their last write.

    Touches the key and order columns only. Counts combine map-side, so a key that holds a third of all
    rows sends one row per task.
    """
    return (
        docs.select(*keys, _position_of(docs).alias("pos"))
        .groupBy(*keys)
        .agg(F.max("pos").alias("last"), F.count(F.lit(1)).alias("writes"))
        .where(F.col("writes") > 1)
        .drop("writes")
    )


def last_write_wins(
    docs: DataFrame, keys: Sequence[str] = ("target_index", "id"), shared: bool = False
) -> DataFrame:
    """The last write per key in (shard, ord) order.

    Documents are wide and repeated ids are few, so documents are not grouped. A pass over the narrow
    columns finds the repeated keys; then every document is kept unless its key is repeated and it is
    not the last. With `shared`, the repeated keys are written to the shared folder first: their size is
    then known to Spark, which broadcasts them when they are small, and documents move through without a
    shuffle. When they are large the join shuffles, and splits skewed keys.
    """
    again = repeated_keys(docs, keys)
    if shared:
        again = write_shared(again, "repeated_keys")
    pos = _position_of(docs)
    return (
        docs.join(again, list(keys), "left")
        .where(F.col("last").isNull() | (F.col("last") == pos))
        .drop("last")
    )


def bulk_action(index: Column, doc_id: Column) -> Column:
    return F.concat(F.lit('{"index":{"_index":'), quote(index), F.lit(',"_id":'), quote(doc_id), F.lit("}}"))


def one_line(source: Column) -> Column:
    """A JSON source on one line: raw line breaks in JSON can only be white space between tokens."""
    return F.translate(source, "\r\n", "  ")


def bulk_rows(docs: DataFrame) -> DataFrame:
    """(target_index, id, action, source) lines of a bulk request."""
    return docs.select(
        *[c for c in docs.columns if c != "source"],
        bulk_action(F.col("target_index"), F.col("id")).alias("action"),
        one_line(F.col("source")).alias("source"),
    )
