"""SimHash near-duplicates: fingerprints, exact comparison in tiles, components."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlift.llm.batches import pieces, raw, small_batches, texts_of
from shardlift.llm.components import components
from shardlift.shared import write_shared

SHINGLE = 4
SEED = 42
RADIUS = 4
# Fingerprints within the radius agree in `BLOCKS - RADIUS` of the blocks. More blocks make longer keys, and so
# smaller groups, for more keys per fingerprint: 5 blocks (5 keys of 12 bits) do up to some ten million
# distinct fingerprints, 6 (15 keys of 21 bits) some billions, 8 (70 keys of 32 bits) more. All are exact.
BLOCKS = 5
# Fingerprints in a tile.
TILE = 512
# Hashes whose bits are counted at once.
_HASHES = 1 << 17


def _hashes(text: bytes) -> list[int]:
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return [xxhash.xxh64_intdigest(joined, SEED)] if words else []
    ends = list(itertools.accumulate(len(word) + 1 for word in words))
    digest = xxhash.xxh64_intdigest
    starts = itertools.chain([0], ends)
    return [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :])]  # noqa: B905


def _bit_counts(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each bit is set in each run of hashes; the lowest bit first."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(counts), 64), np.int64)
    some = np.flatnonzero(counts)
    starts = np.concatenate([[0], np.cumsum(counts[some])[:-1]]).astype(np.int64)
    out[some] = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    return out


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """A 64-bit fingerprint for each text: a bit is set if over half of the hashes have it; no words: zero."""
    totals, sizes = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    waiting: list[int] = []
    counts: list[tuple[int, int]] = []

    def flush() -> None:
        if waiting:
            which = np.array([k for k, _ in counts])
            n = np.array([c for _, c in counts])
            np.add.at(totals, which, _bit_counts(np.array(waiting, np.uint64), n))
            waiting.clear()
            counts.clear()

    for k, text in enumerate(texts):
        hashes = _hashes(text)
        sizes[k] = len(hashes)
        for at in range(0, len(hashes), _HASHES):
            part = hashes[at : at + _HASHES]
            waiting.extend(part)
            counts.append((k, len(part)))
            if len(waiting) >= _HASHES:
                flush()
    flush()
    weights = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))
    return ((2 * totals > sizes[:, None]) * weights).sum(axis=1, dtype=np.uint64)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        data, offsets = raw(texts_of(batch.column("text")))
        texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        found = fingerprints(texts).view(np.int64)
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(found)})


def fingerprint_rows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (doc_id, fp) of all documents; fp is the fingerprint as a signed number."""
    small_batches(docs)
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])
    return narrow.mapInArrow(_fingerprint_batches, schema)


def _block_keys(fp: Column, blocks: int, radius: int) -> Column:
    """A key for every way to choose the blocks in which two fingerprints may agree."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]
    keys = []
    for number, chosen in enumerate(itertools.combinations(range(blocks), blocks - radius)):
        mask = sum(masks[k] for k in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(number).alias("number"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def _linked_in_tile(fp: np.ndarray, radius: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within the radius between two runs ordered by bit count; runs of bit counts too far apart are skipped."""
    ones = np.bitwise_count(fp)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    step = 128
    for a in range(0, len(left), step):
        rows = left[a : a + step]
        low, high = int(ones[rows[0]]) - radius, int(ones[rows[-1]]) + radius
        first = np.searchsorted(ones[right], low, "left")
        last = np.searchsorted(ones[right], high, "right")
        columns = right[first:last]
        if len(columns):
            close = np.bitwise_count(fp[rows][:, None] ^ fp[columns][None, :]) <= radius
            i, j = np.nonzero(close)
            found.append((rows[i], columns[j]))
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def least_linked(n: int, i: np.ndarray, j: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each of n members the linked member of the least rank, directly or through others."""
    order = np.argsort(rank, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    label, a, b = np.arange(n), place[i], place[j]
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = np.minimum(label, label[label])
        if np.array_equal(label, before):
            return order[label[place]]


def _links_of_group(fp: np.ndarray, node: np.ndarray, tile: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(np.bitwise_count(fp), kind="stable")
    fp, node, tile = fp[order], node[order], tile[order]
    every = np.arange(len(fp))
    first = every[tile == tile.min()]
    second = every[tile == tile.max()]
    i, j = _linked_in_tile(fp, radius, first, second)
    root = least_linked(len(fp), i, j, node)
    moved = root != every
    return node[moved], node[root[moved]]


def _tile_links(radius: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("number", "bits", "low", "high", "fp", "node", "tile")
        rest = [np.empty(0, np.int64)] * len(names)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                new = [batch.column(name).to_numpy(zero_copy_only=False) for name in names]
                rest = [np.concatenate(x) for x in zip(rest, new, strict=True)]
            if not len(rest[0]):
                continue
            # A group is a key and two tiles; rows of one group stand together.
            other = np.logical_or.reduce([part[1:] != part[:-1] for part in rest[:4]])
            cuts = np.concatenate([[0], np.flatnonzero(other) + 1, [len(rest[0])]])
            done = len(cuts) - 1 if batch is None else len(cuts) - 2  # the last group may go on
            sides = [(np.empty(0, np.int64), np.empty(0, np.int64))]
            fps, nodes, tiles = rest[4].view(np.uint64), rest[5], rest[6]
            sizes = np.diff(cuts[: done + 1])
            pairs = cuts[:-1][:done][sizes == 2]
            close = np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= radius
            if len(pairs):
                sides.append((nodes[pairs[close]], nodes[pairs[close] + 1]))
            for k in np.flatnonzero(sizes > 2):
                a, b = cuts[k], cuts[k + 1]
                sides.append(_links_of_group(fps[a:b], nodes[a:b], tiles[a:b], radius))
            a, b = (np.concatenate(side) for side in zip(*sides, strict=True))
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})
            rest = [x[cuts[done] :] for x in rest]

    return link


def fingerprint_links(classes: DataFrame, blocks: int = BLOCKS, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between nodes of (fp, node) rows, distinct in fp, that join all pairs within the radius.

    Fingerprints that agree in enough blocks meet in one group. A group of more than `tile` fingerprints is cut
    into tiles in order of bit counts, and each pair of tiles whose bit counts are near enough is a group of its
    own. In a group, members that hang together get one link each, to the least of them.
    """
    keyed = classes.select("fp", "node", F.explode(_block_keys(F.col("fp"), blocks, radius)).alias("key"))
    keyed = keyed.withColumn("ones", F.bit_count("fp"))
    # At most 65 bit counts for a key.
    counts = keyed.groupBy("key", "ones").agg(F.count("*").alias("n"))
    large = counts.groupBy("key").agg(
        F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("ones", "n"))).alias("by_ones")
    )
    large = write_shared(large.where(F.col("total") > tile), "large")
    rows = keyed.join(large, "key", "left")
    rows = rows.select("*", F.expr("aggregate(filter(by_ones, x -> x.ones < ones), 0L, (s, x) -> s + x.n)").alias("below"))
    own = F.expr("element_at(filter(by_ones, x -> x.ones = ones), 1).n")
    place = F.col("below") + F.pmod(F.xxhash64("fp"), own)
    rows = rows.withColumn("tile", F.coalesce(F.floor(place / tile), F.lit(0)).cast("long"))
    # The bit counts at the ends of a tile, from the counts below it.
    others = F.expr(
        f"""filter(
              transform(sequence(0L, cast((total - 1) div {tile} as bigint)), t -> struct(
                t as t,
                aggregate(by_ones, struct(0L as n, 0 as least), (s, x) -> struct(
                  s.n + x.n as n, if(s.n <= t * {tile}, x.ones, s.least) as least)).least as least,
                aggregate(by_ones, struct(0L as n, 0 as most), (s, x) -> struct(
                  s.n + x.n as n, if(s.n < (t + 1) * {tile}, x.ones, s.most) as most)).most as most)),
              o -> o.least - ones <= {radius} and ones - o.most <= {radius}).t"""
    )
    rows = rows.withColumn("other", F.explode(F.coalesce(others, F.array(F.lit(0).cast("long")))))
    rows = rows.select(
        F.col("key.number").cast("long").alias("number"),
        F.col("key.bits").alias("bits"),
        F.least("tile", "other").alias("low"),
        F.greatest("tile", "other").alias("high"),
        "fp",
        "node",
        "tile",
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = ["number", "bits", "low", "high"]
    placed = rows.repartition(parts, *group).sortWithinPartitions(*group, "fp", "tile")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    return placed.mapInArrow(_tile_links(radius), schema)


def _classes(prints: DataFrame, most: int) -> DataFrame:
    """Rows (fp, node, doc): each fingerprint, its least doc_id, and a number that is the least doc_id where it has one.

    Fingerprints that only rows without a doc_id have get numbers above `most`, the largest doc_id, so that they are linked like any
    other and never are the least of a component with documents.
    """
    found = prints.groupBy("fp").agg(F.min("doc_id").alias("doc"))
    above = F.lit(most).cast("long") + 1 + F.monotonically_increasing_id()
    return write_shared(found.select("fp", F.coalesce("doc", above).alias("node"), "doc"), "classes")


def fingerprint_components(prints: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Rows (fp, component, component_id) from rows (doc_id, fp): the least doc_id, null where no row has one.

    `component` is a number for every component, the same as component_id where that is not null.
    """
    largest = prints.agg(F.max("doc_id")).first()[0]
    most = -1 if largest is None else largest
    classes = _classes(prints, most)
    links = fingerprint_links(classes.select("fp", "node"), blocks)
    # Different texts under one doc_id hang together as well.
    same_id = prints.join(classes, "fp").where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    shared_ids = prints.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y")
    both = same_id.join(shared_ids.select(F.col("doc_id").alias("a")), "a", "left_semi")
    found = components(links.unionByName(both))
    joined = classes.join(found, classes.node == found.node, "left")
    component = F.coalesce("component", classes.node)
    # Components above all doc_ids have none.
    has_document = (component <= most) if largest is not None else F.lit(False)
    return joined.select("fp", component.alias("component"), F.when(has_document, component).alias("component_id"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", blocks: int = BLOCKS) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one for each row of `docs`.

    Null texts count as empty; texts without words have fingerprint zero and are linked like any other.
    Rows with the same doc_id are one document. Rows without one are linked and link others like any; their
    component_id is null only where nothing in the component has a doc_id. Equal fingerprints are one class before
    anything is compared.
    """
    prints = write_shared(fingerprint_rows(docs, text, key), "prints")
    of_class = fingerprint_components(prints, blocks)
    return prints.join(of_class, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents with one of each component left: the row of the smallest doc_id, and of repeated rows the least.

    Rows without a doc_id stay only where nothing in their component has one: the least row of it.
    """
    prints = write_shared(fingerprint_rows(docs, text, key), "prints")
    of_class = write_shared(fingerprint_components(prints), "components")
    kept = prints.join(of_class, "fp").where("doc_id = component_id").select(F.col("doc_id").alias("kept_id"))
    kept = write_shared(kept.distinct(), "kept")
    rest = [name for name in docs.columns if name != key]
    stay = docs.join(kept, F.col(key).cast("long") == F.col("kept_id"), "left_semi")
    single = stay.groupBy(key).agg(F.min(F.struct(*rest)).alias("row")).select(key, "row.*").select(docs.columns)
    lost = docs.where(F.col(key).isNull())
    alone = of_class.where("component_id is null")
    if not alone.limit(1).count():
        return single
    # The texts of these rows are looked at again, since nothing else tells the rows apart.
    whole = F.struct(*docs.columns).alias("_row")
    marked = _fingerprints_beside(lost.select(F.col(text).alias("text"), whole))
    lone = marked.join(alone.select("fp", "component"), "fp").groupBy("component").agg(F.min("_row").alias("_row"))
    return single.unionByName(lone.select("_row.*"))


def _fingerprints_beside(rows: DataFrame) -> DataFrame:
    """Rows (text, _row) to (_row, fp)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            data, offsets = raw(texts_of(batch.column("text")))
            texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            found = pa.array(fingerprints(texts).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), found], ["_row", "fp"])

    return rows.mapInArrow(add, T.StructType([rows.schema["_row"], T.StructField("fp", T.LongType())]))
