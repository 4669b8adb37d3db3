"""Bulk document sinks: NDJSON files, and a data source that sends through a transport."""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from shardlift.sinks.transport import BATCH_BYTES, BATCH_ROWS, in_batches


_FILES_PER_INDEX = 32


def write_ndjson(rows: DataFrame, path: str, by_index: bool = False) -> None:
    """(target_index, action, source) as action and source lines.

    The action line names its index, so files may mix indices and are written as the rows lie.
    `by_index` puts every index in a folder of its own, dealt to a few tasks each, so that there is a bounded
    number of files for an index and a large one is no single task. Running it again replaces the files.
    """
    line = F.concat(F.col("action"), F.lit("\n"), F.col("source")).alias("value")
    if by_index:
        salt = F.pmod(F.xxhash64("action"), F.lit(_FILES_PER_INDEX))
        dealt = rows.repartition("target_index", salt)
        dealt.select("target_index", line).write.mode("overwrite").partitionBy("target_index").text(path)
    else:
        rows.select(line).write.mode("overwrite").text(path)


@dataclass
class Sent(WriterCommitMessage):
    ok: int
    failed: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options):
        self.factory = options["transport"]
        self.target = options.get("target", "")
        self.rows = int(options.get("batchrows", BATCH_ROWS))
        self.bytes = int(options.get("batchbytes", BATCH_BYTES))

    def write(self, iterator: Iterator) -> Sent:
        module, _, name = self.factory.partition(":")
        transport = getattr(importlib.import_module(module), name)(self.target)
        ok = failed = 0
        for batch in iterator:
            pairs = zip(batch.column("action").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for group in in_batches(pairs, self.rows, self.bytes):
                good = sum(status in (200, 201) for status in transport.send(group))
                ok += good
                failed += len(group) - good
        return Sent(ok, failed)

    def commit(self, messages) -> None:
        failed = sum(m.failed for m in messages if m is not None)
        if failed:
            raise RuntimeError(f"{failed} documents were refused")


class BulkSource(DataSource):
    """`df.write.format("shardlift_bulk").option("transport", "module:factory").option("target", ...)`.

    The factory is called with `target` inside each task. Use `transport.deliver` for a result per row.
    """

    @classmethod
    def name(cls) -> str:
        return "shardlift_bulk"

    def schema(self) -> str:
        return "action string, source string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BulkSource)
