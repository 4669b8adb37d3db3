"""Delivery of request batches to a target.

A transport takes a batch of requests and answers one status per request. It runs inside tasks and
must be picklable. Writes are by path or id, so sending a batch again after a lost task is harmless.

What a busy target refuses is sent again with growing pauses. A ledger, a folder of small files that tasks add to as
they go, says what was delivered: a run that was cut off goes on from there.
"""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlift.fixed import HTTP_BUSY, HTTP_CREATED, HTTP_NOT_FOUND, HTTP_OK, HTTP_SERVER_ERROR, HTTP_UNAVAILABLE
from shardlift.sources.blobs import open_path

BATCH_ROWS = 1000
BATCH_BYTES = 8 * 1024 * 1024
# Rows after which a task adds to the ledger; at most so many are sent again after a lost task.
LEDGER_ROWS = 50_000


@dataclass(frozen=True)
class Patience:
    """How often a refused request is sent, and the pauses between: doubled each time, shortened by chance."""

    tries: int = 5
    first: float = 0.5
    longest: float = 60.0

    def pause(self, tried: int) -> float:
        return min(self.longest, self.first * 2**tried) * random.uniform(0.5, 1.0)


class Transport(Protocol):
    def send(self, lines: list[tuple[str, str]]) -> list[int]:
        """Deliver (action or path, body) pairs; one status each, in order."""
        ...

    def probe(self, paths: list[str]) -> list[int]:
        """Look for paths at the target; one status each, in order: 200 where something is, 404 where nothing is."""
        ...


@dataclass
class FileTransport:
    """Writes every batch as one NDJSON file, in any file system Arrow knows by URI."""

    folder: str

    def send(self, lines: list[tuple[str, str]]) -> list[int]:
        from pyarrow import fs

        uri = self.folder if "://" in self.folder else f"file://{self.folder}"
        files, path = fs.FileSystem.from_uri(uri)
        files.create_dir(path, recursive=True)
        with files.open_output_stream(f"{path}/{uuid.uuid4().hex}.ndjson") as out:
            for head, body in lines:
                out.write(f"{head}\n{body}\n".encode())
        return [HTTP_CREATED] * len(lines)

    def probe(self, paths: list[str]) -> list[int]:
        """Files take everything, so nothing is there before."""
        return [HTTP_NOT_FOUND] * len(paths)



def in_batches(
    rows: Iterator[tuple[str, str]], max_rows: int, max_bytes: int
) -> Iterator[list[tuple[str, str]]]:
    """Cut rows into batches by count and size; a row above the size goes alone."""
    batch: list[tuple[str, str]] = []
    size = 0
    for head, body in rows:
        extra = len(head.encode()) + len(body.encode())
        if batch and (len(batch) >= max_rows or size + extra > max_bytes):
            yield batch
            batch, size = [], 0
        batch.append((head, body))
        size += extra
    if batch:
        yield batch


def refused(status: int) -> bool:
    """Whether sending again may help."""
    return status == HTTP_BUSY or status >= HTTP_SERVER_ERROR


def send_patiently(transport: Transport, lines: list[tuple[str, str]], patience: Patience) -> list[int]:
    """A status for each request, after sending those again that were refused; a lost connection counts as that."""
    statuses = [HTTP_UNAVAILABLE] * len(lines)
    waiting = list(range(len(lines)))
    for tried in range(patience.tries):
        if tried:
            time.sleep(patience.pause(tried - 1))
        try:
            answer = transport.send([lines[k] for k in waiting])
        except OSError:
            continue
        if len(answer) != len(waiting):
            raise RuntimeError(f"{len(waiting)} requests got {len(answer)} answers")
        for k, status in zip(waiting, answer, strict=True):
            statuses[k] = status
        waiting = [k for k in waiting if refused(statuses[k])]
        if not waiting:
            break
    return statuses


def _add_to_ledger(folder: str, rows: list[pa.RecordBatch]) -> None:
    """A file of its own for these rows; it is seen once it is whole."""
    if not rows:
        return
    files, path = open_path(folder)
    files.create_dir(path, recursive=True)
    name = uuid.uuid4().hex
    with files.open_output_stream(f"{path}/_{name}", compression=None) as out:
        pq.write_table(pa.Table.from_batches(rows), out)
    files.move(f"{path}/_{name}", f"{path}/{name}.parquet")


def deliver(
    rows: DataFrame,
    keys: list[str],
    head: str,
    body: str,
    transport: Transport,
    max_rows: int = BATCH_ROWS,
    max_bytes: int = BATCH_BYTES,
    patience: Patience = Patience(),
    ledger: str | None = None,
) -> DataFrame:
    """`keys` and `status` per row, after sending (head, body) in batches from each task.

    Batches mix target indices, so a large index needs no regrouping. Sending happens when the result is
    computed: write it to a table and read the table, do not compute it twice. With a `ledger` tasks add
    (keys, content, status) to it as they go; see `undelivered`.
    """
    columns = list(dict.fromkeys([*keys, head, body]))
    schema = rows.select(*keys, F.lit(0).alias("status")).schema
    numbered = rows.select(*columns, content_of(head, body).alias(_CONTENT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        noted: list[pa.RecordBatch] = []
        for batch in batches:
            pairs = zip(batch.column(head).to_pylist(), batch.column(body).to_pylist(), strict=True)
            statuses: list[int] = []
            for group in in_batches(pairs, max_rows, max_bytes):
                statuses.extend(send_patiently(transport, group, patience))
            held = [batch.column(k) for k in keys]
            status = pa.array(statuses, pa.int32())
            if ledger is not None:
                names = [*keys, _CONTENT, "status"]
                noted.append(pa.RecordBatch.from_arrays([*held, batch.column(_CONTENT), status], names))
                if sum(b.num_rows for b in noted) >= LEDGER_ROWS:
                    _add_to_ledger(ledger, noted)
                    noted = []
            yield pa.RecordBatch.from_arrays([*held, status], [*keys, "status"])
        if ledger is not None:
            _add_to_ledger(ledger, noted)

    return numbered.mapInArrow(run, schema)


_CONTENT = "_content"


def content_of(head: str, body: str) -> Column:
    """What tells a request from another one under the same keys."""
    return F.xxhash64(head, body)


def delivered(rows: DataFrame, keys: list[str], ledger: str) -> DataFrame:
    """(keys, _content, status) of what the ledger has as done, once each; nothing if there is no ledger."""
    spark = rows.sparkSession
    schema = rows.select(*keys, F.lit(0).cast("bigint").alias(_CONTENT), F.lit(0).alias("status")).schema
    files, path = open_path(ledger)
    files.create_dir(path, recursive=True)
    done = spark.read.schema(schema).parquet(ledger).where(is_done(F.col("status")))
    return done.groupBy(*keys, _CONTENT).agg(F.min("status").alias("status"))


def undelivered(rows: DataFrame, keys: list[str], head: str, body: str, done: DataFrame) -> DataFrame:
    """Rows that are not done, or whose content is another than the one that was delivered."""
    left = rows.withColumn(_CONTENT, content_of(head, body))
    return left.join(done.select(*keys, _CONTENT), [*keys, _CONTENT], "left_anti").select(*rows.columns)


def is_done(status: Column) -> Column:
    return status.isin(HTTP_OK, HTTP_CREATED)


def probed(requests: DataFrame, transport: Transport, max_rows: int = BATCH_ROWS) -> DataFrame:
    """(kind, name, status) of requests (kind, name, path) at the target, looked up from each task."""
    schema = requests.select("kind", "name", F.lit(0).alias("status")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, statuses = batch.column("path").to_pylist(), []
            for at in range(0, len(paths), max_rows):
                asked = paths[at : at + max_rows]
                answer = transport.probe(asked)
                if len(answer) != len(asked):
                    raise RuntimeError(f"{len(asked)} paths got {len(answer)} answers")
                statuses.extend(answer)
            columns = [batch.column("kind"), batch.column("name"), pa.array(statuses, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["kind", "name", "status"])

    return requests.select("kind", "name", "path").distinct().mapInArrow(run, schema)


def classify(status: Column, quiet: bool = False) -> Column:
    """struct<outcome, level> of a response: 200 and 201 are fine, others errors unless kept quiet."""
    fine = is_done(status)
    return F.struct(
        F.when(fine, F.lit("ok")).otherwise(F.lit("error")).alias("outcome"),
        F.when(fine | F.lit(quiet), F.lit("debug")).otherwise(F.lit("error")).alias("level"),
    )


def with_outcome(results: DataFrame, quiet: bool = False) -> DataFrame:
    return results.withColumn("c", classify(F.col("status"), quiet)).select(*results.columns, "c.*")
