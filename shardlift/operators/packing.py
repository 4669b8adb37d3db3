"""Rows cut into tasks of equal work, by prefix sums over all of them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Prefix sums are taken in this many buckets, whose totals are all that the driver sees.
BUCKETS = 1024
MOST_TASKS = 20_000


def packed(
    rows: DataFrame,
    work: Column,
    order: Sequence[str],
    task_work: int,
    spread: Sequence[str | Column] | None = None,
    most_tasks: int = MOST_TASKS,
) -> DataFrame:
    """The rows in partitions that hold about `task_work` each, sorted by `order` in each.

    All rows stand in one line, by bucket (a hash of `spread`, else of `order`) and then `order`; the line is cut
    into equal stretches and a row goes where its work begins. So the work of two tasks differs by one row's at most,
    whatever share of it one file or shard has. More than `most_tasks` stretches become longer ones.

    Rows are read twice: give a written table, or one that is cheap and comes out the same again.
    """
    spark = rows.sparkSession
    numbered = rows.withColumn("_work", F.greatest(F.coalesce(work.cast("bigint"), F.lit(0)), F.lit(0))).withColumn(
        "_bucket", F.pmod(F.xxhash64(*(spread or order)), F.lit(BUCKETS))
    )
    held = {r["_bucket"]: r["n"] for r in numbered.groupBy("_bucket").agg(F.sum("_work").alias("n")).collect()}
    total = sum(held.values())
    tasks = min(most_tasks, max(1, -(-total // task_work)))
    buckets = sorted(held)
    starts = accumulate((held[b] for b in buckets[:-1]), initial=0) if buckets else []
    begins = spark.createDataFrame(
        list(zip(buckets, starts, strict=True)), "_bucket bigint, _start bigint"
    )
    # The row itself does not count: a row goes where it begins.
    before = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = numbered.join(begins, "_bucket").withColumn(
        "_begin", F.col("_start") + F.coalesce(F.sum("_work").over(before), F.lit(0))
    )
    # Whole numbers, wide enough for bytes times tasks.
    wide = F.col("_begin").cast("decimal(19,0)") * F.lit(tasks).cast("decimal(7,0)")
    task = F.least(F.call_function("div", wide, F.lit(max(total, 1)).cast("decimal(19,0)")), F.lit(tasks - 1))
    return (
        placed.withColumn("_task", task.cast("int"))
        .repartitionById(tasks, "_task")
        .sortWithinPartitions(*order)
        .select(*rows.columns)
    )
