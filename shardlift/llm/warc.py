"""WARC archives written and read in tasks, payloads as rows of record and chunk number.

A payload travels as chunk rows of bounded size: Python holds one chunk at a time, and its digest is carried from
chunk to chunk. Every record is a gzip member of its own, so archives can be read from any record on.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlift.shared import shared_folder, write_shared

# Bytes of payload in a chunk row.
CHUNK = 64 << 10
# Rows in an Arrow batch: a batch is at most this many chunks.
BATCH_ROWS = 256
# A task begins a new archive beyond this size.
ARCHIVE_BYTES = 128 << 20
# Bytes of an archive that a task reads.
READ_BYTES = 4 << 20
# Payloads shorter than this are never revisits.
LEAST_REVISIT = 100
DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = 31

_INDEX = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("page_id", T.LongType()),
    ]
)
CHUNKS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("chunk", T.IntegerType()),
        T.StructField("data", T.BinaryType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("last", T.BooleanType()),
    ]
)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return fs.LocalFileSystem(), path


def record_id(page_id: int | None, digest: str) -> str:
    name = hashlib.sha256(f"{page_id}:{digest}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name[:16], version=5)}>"


def _field(text: str) -> str:
    """A header value: control characters and blanks as percent codes."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", text)


def _head(row: dict, date: str) -> bytes:
    revisit = row["record_type"] == "revisit"
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += "\r\n" if revisit else f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    length = len(http) + (0 if revisit else row["payload_bytes"])
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", record_id(row["page_id"], row["payload_digest"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if row["url"] is None else _field(row["url"])),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("WARC-Profile", _PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(row["refers_to"], row["payload_digest"]) if revisit else None),
        ("X-Page-Id", row["page_id"]),
        ("X-Refers-To-Page-Id", row["refers_to"] if revisit else None),
        ("X-Payload-Length", row["payload_bytes"]),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", length),
    ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"WARC/1.1\r\n{lines}\r\n{http}".encode()


class _Archive:
    """An open archive; counts what it has written."""

    def __init__(self, folder: str) -> None:
        # A name of its own for every attempt: only files of attempts that were committed are in the index.
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        system, path = file_system(self.path)
        self.stream = system.open_output_stream(path, compression=None)
        self.written = 0

    def write(self, data: bytes) -> None:
        if data:
            self.stream.write(data)
            self.written += len(data)


def _write_batches(folder: str, date: str, level: int, most: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, member, start, digest = None, None, 0, None
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    if row["chunk"] == 0:
                        if archive is None or archive.written > most:
                            if archive is not None:
                                archive.stream.close()
                            archive = _Archive(folder)
                        start, digest = archive.written, hashlib.sha256()
                        member = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
                        archive.write(member.compress(_head(row, date)))
                    if row["data"]:
                        digest.update(row["data"])
                        archive.write(member.compress(row["data"]))
                    if row["last"]:
                        archive.write(member.compress(b"\r\n\r\n") + member.flush())
                        if row["record_type"] == "response" and digest.hexdigest() != row["payload_digest"]:
                            raise ValueError(f"the chunks of page {row['page_id']} do not make up its payload")
                        index.append((archive.path, start, archive.written - start, row["page_id"]))
                columns = zip(*index, strict=True) if index else [[]] * 4
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=_INDEX.names)
        finally:
            if archive is not None:
                archive.stream.close()

    return write


def records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Rows (page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to), one for each page.

    Pages are matched by digest and length; only digests that occur more than once meet the pages again.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
    )
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    repeated = (
        rows.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select("payload_digest", "payload_bytes", "first")
    )
    repeated = write_shared(repeated, "repeated")
    joined = rows.join(repeated, ["payload_digest", "payload_bytes"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def chunk_rows(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """The payloads of responses as rows (..., chunk, data, last) of at most `size` bytes; others have one empty chunk."""
    shown = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0)
    top = F.greatest(F.floor((shown - 1) / size), F.lit(0)).cast("int")
    rows = rows.withColumn("_top", top).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_top"))))
    data = F.when(F.col("record_type") == "response", F.substring("payload", F.col("chunk") * size + 1, F.lit(size)))
    return rows.select(
        *(name for name in rows.columns if name not in ("payload", "_top")),
        data.alias("data"),
        (F.col("chunk") == F.col("_top")).alias("last"),
    )


def _bounded_batches(spark: SparkSession) -> None:
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, BATCH_ROWS)


def write_warc(
    pages: DataFrame,
    folder: str | None = None,
    least: int = LEAST_REVISIT,
    chunk: int = CHUNK,
    date: str = DATE,
    level: int = 1,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes a record for every page and returns the index (archive, offset, length, page_id), already written.

    A null html is the empty payload. Of pages with one payload of `least` bytes or more, those with the smallest
    page_id are responses and all others revisits of it, those without a page_id included; if none has one, all are
    responses. Repeated rows are records each. Null urls leave the field out. An empty table gives no archive.
    Other columns are not looked at. Tasks that are repeated write files of their own, and the index holds those
    of the attempts that were committed.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    _bounded_batches(spark)
    rows = chunk_rows(records(pages, least), chunk)
    return write_shared(rows.mapInArrow(_write_batches(folder, date, level, archive_bytes), _INDEX), "index")


class _Member:
    """Decompressed bytes of one gzip member after another, a block at a time."""

    def __init__(self, stream, end: int) -> None:
        self.stream, self.end, self.rest, self.inflate = stream, end, b"", None
        self.buffer = b""

    def _block(self) -> bytes:
        if self.rest:
            block, self.rest = self.rest, b""
            return block
        return self.stream.read(256 << 10)

    def begin(self) -> bool:
        """The next member, if one begins before the end."""
        if self.stream.tell() - len(self.rest) >= self.end:
            return False
        self.inflate, self.buffer = zlib.decompressobj(_GZIP), b""
        return True

    def more(self) -> bool:
        """Adds some bytes to the buffer."""
        while not self.inflate.eof:
            block = self.inflate.unconsumed_tail or self._block()
            if not block:
                raise EOFError("the archive ends inside a record")
            data = self.inflate.decompress(block, CHUNK)
            if self.inflate.eof:
                self.rest = self.inflate.unused_data + self.rest
            if data:
                self.buffer += data
                return True
        return False

    def line_block(self) -> bytes:
        while (at := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self.more():
                raise EOFError("a record has no end of header")
        block, self.buffer = self.buffer[:at], self.buffer[at + 4 :]
        return block

    def take(self, most: int) -> bytes:
        while len(self.buffer) < most and self.more():
            pass
        data, self.buffer = self.buffer[:most], self.buffer[most:]
        return data

    def finish(self) -> None:
        while self.more():
            self.buffer = b""
        self.buffer = b""


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines)


def _record_chunks(member: _Member, size: int, content: bool) -> Iterator[dict]:
    head = _fields(member.line_block())
    before = int(head["Content-Length"])
    http = member.line_block()
    left = before - len(http) - 4
    number = lambda name: int(head[name]) if name in head else None
    base = {
        "record_id": head["WARC-Record-ID"],
        "page_id": number("X-Page-Id"),
        "url": head.get("WARC-Target-URI"),
        "record_type": head["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-Id"),
    }
    declared = head["WARC-Payload-Digest"].removeprefix("sha256:")
    digest, seen, chunk = hashlib.sha256(), 0, 0
    while True:
        data = member.take(min(size, left - seen))
        if len(data) < min(size, left - seen):
            raise EOFError(f"the payload of {base['record_id']} is cut short")
        digest.update(data)
        seen += len(data)
        last = seen >= left
        so_far = (seen, digest.hexdigest())
        if last and base["record_type"] == "revisit":
            so_far = (int(head["X-Payload-Length"]), declared)
        elif last and so_far[1] != declared:
            raise ValueError(f"the payload of {base['record_id']} does not have its digest")
        if content or last:
            yield base | {
                "chunk": chunk,
                "data": data if content else None,
                "payload_bytes": so_far[0],
                "payload_digest": so_far[1],
                "last": last,
            }
        if last:
            return
        chunk += 1


def _read_batches(size: int, content: bool):
    schema = pa.schema(
        [
            ("record_id", pa.string()),
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("chunk", pa.int32()),
            ("data", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("last", pa.bool_()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                system, path = file_system(part["archive"])
                rows: list[dict] = []
                with system.open_input_file(path) as stream:
                    stream.seek(part["start"])
                    member = _Member(stream, part["end"])
                    while member.begin():
                        for row in _record_chunks(member, size, content):
                            rows.append(row)
                            if len(rows) >= BATCH_ROWS:
                                yield pa.RecordBatch.from_pylist(rows, schema)
                                rows = []
                        member.finish()
                yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def read_warc(index: DataFrame, chunk: int = CHUNK, content: bool = True, read_bytes: int = READ_BYTES) -> DataFrame:
    """The records of indexed archives as chunk rows, with the bytes and the digest up to each chunk.

    The row with `last` has the figures of the whole payload; a revisit has one chunk without data and the figures
    of the payload it stands for. Without `content` only last chunks are returned, and no data. Payloads that are
    cut short or do not have their digest stop the job.
    """
    _bounded_batches(index.sparkSession)
    part = F.floor(F.col("offset") / read_bytes)
    ranges = index.groupBy("archive", part.alias("part")).agg(
        F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("end")
    )
    ranges = write_shared(ranges.select("archive", "start", "end"), "ranges")
    # Few narrow rows that stand for much work each: one for each task.
    spread = ranges.repartition(max(1, ranges.count()))
    return spread.mapInArrow(_read_batches(chunk, content), CHUNKS)
