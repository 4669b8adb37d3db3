"""Rows of few bytes and much work."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Tasks a core: the last ones to end leave other cores idle for a short while only.
TASKS_PER_CORE = 4


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt out evenly over the cores.

    Files are cut into tasks by bytes and row groups, so a table of narrow rows is one or two tasks however long each
    row takes. The rows are shuffled as they are: deal them out before they are made wide. The number is given, so
    that Spark does not put small partitions together again.
    """
    return rows.repartition(TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)
