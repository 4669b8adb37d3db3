"""Arrow batches as plain byte arrays, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Bytes of text that are worked on at once; a longer text is worked on alone.
PIECE_BYTES = 8 << 20
# Rows in an Arrow batch: texts are up to some hundred kilobytes, so batches stay in the tens of megabytes.
BATCH_ROWS = 1024


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts as one array with 64-bit offsets, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each text begins, with the end of the last."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The rows in slices with at most `PIECE_BYTES` of text each, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + PIECE_BYTES, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def per_text(counted: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the marked bytes lie in each text."""
    total = np.concatenate([[0], np.cumsum(counted, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = {name: batch.column(k) for k, name in enumerate(batch.schema.names) if name not in columns}
    return pa.RecordBatch.from_pydict(kept | columns)


def widened(df: DataFrame, **columns: T.DataType) -> T.StructType:
    """The schema with these columns put last; columns of the same name give way."""
    kept = [field for field in df.schema.fields if field.name not in columns]
    return T.StructType(kept + [T.StructField(name, kind) for name, kind in columns.items()])


def small_batches(df: DataFrame) -> None:
    """Bounds the rows of an Arrow batch for this session, so that long texts fit in memory."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(setting)) > BATCH_ROWS or int(df.sparkSession.conf.get(setting)) <= 0:
        df.sparkSession.conf.set(setting, BATCH_ROWS)
