"""Embedding near-duplicates by an inverted multi-index: cells of two codebooks, nearest cells first, exact checks.

Each half of a unit vector has its own codebook; a cell is a pair of codewords. For a cell other than its home, a
vector's distance to the boundary says how far a neighbour there is at least. Cells are visited in the order of
that bound up to a reach, which is set on a sample so that the target share of pairs right at the threshold meets.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlift.llm.batches import small_batches
from shardlift.llm.components import components
from shardlift.llm.simhash import least_linked
from shardlift.shared import write_shared

THRESHOLD = 0.93
# Share of pairs right at the threshold that have to meet; nearer ones meet more surely.
TARGET_RECALL = 0.999
# Bound on the vectors that the codebooks and the reach are fitted on, picked by a hash.
SAMPLE = 8192
# Vectors in a cell on average, which sets the size of the codebooks.
CELL = 64
MOST_CODEWORDS = 512
# Vectors in a tile of a large cell.
TILE = 512


def _codebook(rows: np.ndarray, size: int, random: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Codewords by k-means; words without vectors stay where they are."""
    words = rows[random.choice(len(rows), min(size, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        near = _distances(rows, words).argmin(axis=1)
        sums = np.zeros_like(words)
        np.add.at(sums, near, rows)
        count = np.bincount(near, minlength=len(words))
        words[count > 0] = sums[count > 0] / count[count > 0, None]
    return words


def _distances(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(axis=1)[:, None] - 2 * rows @ words.T + (words * words).sum(axis=1)[None, :]


class Index:
    """Codebooks of both halves for vectors of one length, and the reach of a search."""

    def __init__(self, sample: np.ndarray, words: int, threshold: float, target: float, seed: int = 0) -> None:
        random = np.random.default_rng(seed)
        self.half = sample.shape[1] // 2
        halves = (sample[:, : self.half], sample[:, self.half :])
        self.books = [_codebook(half, words, random) for half in halves]
        self.gaps = [np.sqrt(np.maximum(_distances(book, book), 1e-30)) for book in self.books]
        self.reach = 0.0
        # Pairs right at the threshold, in random directions.
        other = random.standard_normal(sample.shape)
        other -= (other * sample).sum(axis=1)[:, None] * sample
        norms = np.linalg.norm(other, axis=1)
        usable = norms > 1e-12
        if usable.any() and threshold < 1:
            x = sample[usable]
            y = threshold * x + np.sqrt(1 - threshold**2) * other[usable] / norms[usable, None]
            needed = np.minimum(self._bound(x, self.homes(y)), self._bound(y, self.homes(x)))
            self.reach = float(np.quantile(needed, target)) * (1 + 1e-9)

    def _margins(self, rows: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Home codewords, and for every codeword the distance to the boundary between home and it."""
        far = _distances(rows[:, : self.half] if side == 0 else rows[:, self.half :], self.books[side])
        home = far.argmin(axis=1)
        own = far[np.arange(len(rows)), home]
        margin = np.maximum(far - own[:, None], 0) / (2 * self.gaps[side][home])
        margin[np.arange(len(rows)), home] = 0
        return home, margin

    def homes(self, rows: np.ndarray) -> np.ndarray:
        return self._margins(rows, 0)[0] * len(self.books[1]) + self._margins(rows, 1)[0]

    def _bound(self, rows: np.ndarray, cells: np.ndarray) -> np.ndarray:
        first, second = np.divmod(cells, len(self.books[1]))
        at = np.arange(len(rows))
        return np.hypot(self._margins(rows, 0)[1][at, first], self._margins(rows, 1)[1][at, second])

    def cells(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home cell of each vector; and (vector, cell) of all other cells within reach, nearest first.

        The codewords of each half are ordered by margin. For each next word of the first half the words of the
        second are taken while the sum of squares stays within the reach, which is a staircase that shrinks.
        """
        (home_a, margin_a), (home_b, margin_b) = self._margins(rows, 0), self._margins(rows, 1)
        order_a, order_b = margin_a.argsort(axis=1, kind="stable"), margin_b.argsort(axis=1, kind="stable")
        square_a = np.take_along_axis(margin_a, order_a, 1) ** 2
        square_b = np.take_along_axis(margin_b, order_b, 1) ** 2
        limit = self.reach**2
        found = []
        alive = np.arange(len(rows))
        for step in range(square_a.shape[1]):
            alive = alive[square_a[alive, step] <= limit]
            if not len(alive):
                break
            sums = square_a[alive, step][:, None] + square_b[alive]
            i, j = np.nonzero(sums <= limit)
            found.append((alive[i], order_a[alive[i], step] * len(self.books[1]) + order_b[alive[i], j], sums[i, j]))
        home = home_a * len(self.books[1]) + home_b
        which, cell, bound = (np.concatenate(x) for x in zip(*found, strict=True))
        other = cell != home[which]
        which, cell, bound = which[other], cell[other], bound[other]
        order = np.lexsort((bound, which))
        return home, which[order], cell[order]


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1]) if len(ends) else []


def _by_length(vectors: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    lengths = np.array([len(v) for v in vectors])
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        rows = np.stack([vectors[k] for k in at])
        yield length, at, rows / np.linalg.norm(rows, axis=1)[:, None]


def _place_batches(indexes: dict[int, Index]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch.column("vector"))
            home = np.zeros(len(vectors), np.int64)
            lists: list[list[int]] = [[] for _ in vectors]
            for length, at, rows in _by_length(vectors):
                if length in indexes:
                    home[at], which, cell = indexes[length].cells(rows)
                    for k, c in zip(at[which].tolist(), cell.tolist(), strict=True):
                        lists[k].append(c)
            columns = {name: batch.column(name) for name in ("cid", "copies", "label", "vector")}
            yield pa.RecordBatch.from_pydict(
                columns
                | {
                    "size": pa.array([len(v) for v in vectors], pa.int32()),
                    "home": pa.array(home.astype(np.int32)),
                    "others": pa.array(lists, pa.list_(pa.int32())),
                }
            )

    return place


def _fit(classes: DataFrame, threshold: float, target: float) -> dict[int, Index]:
    n = classes.count()
    share = int(1_000_000 * min(1.0, SAMPLE / max(1, n)))
    picked = classes.where(F.pmod(F.xxhash64("cid"), F.lit(1_000_000)) < share).select("vector")
    sample = [np.array(row["vector"], float) for row in picked.toLocalIterator()]
    words = max(2, min(MOST_CODEWORDS, int(np.ceil(np.sqrt(n / CELL)))))
    return {
        length: Index(rows, words, threshold, target)
        for length, _, rows in _by_length(sample)
        if length > 1
    }


def _group_links(columns: dict[str, np.ndarray], vectors: np.ndarray, others: list[np.ndarray], threshold: float):
    """Links of a group: for each class with any, the other vectors it is linked to, and the least class it hangs with."""
    at_home = columns["home"] == columns["cell"]
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    near: list[tuple[np.ndarray, np.ndarray]] = []

    def compare(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        if not len(a) or not len(b):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        linked = (vectors[a] @ vectors[b].T) / np.outer(norms[a], norms[b]) >= threshold
        i, j = np.nonzero(np.triu(linked, 1) if same else linked)
        return a[i], b[j]

    first, second = columns["part"] == columns["i"], columns["part"] == columns["j"]
    if columns["visit"][0]:
        residents, visitors = np.flatnonzero(at_home), np.flatnonzero(~at_home)
        i, j = compare(residents, visitors, False)
        if len(i):
            # The resident visits the visitor's home too: then the smaller cell has the pair.
            cell = int(columns["cell"][0])
            homes = columns["home"][j]
            keep = ~_visits(i, homes, others) | (homes > cell)
            i, j = i[keep], j[keep]
        near.append((i, j))
    elif columns["i"][0] == columns["j"][0]:
        near.append(compare(np.flatnonzero(first), np.flatnonzero(first), True))
    else:
        near.append(compare(np.flatnonzero(first), np.flatnonzero(second), False))
    i, j = (np.concatenate(side) for side in zip(*near, strict=True))
    n = len(norms)
    links = np.bincount(i, columns["copies"][j], n) + np.bincount(j, columns["copies"][i], n)
    root = least_linked(n, i, j, columns["cid"])
    some = np.flatnonzero(links > 0)
    return columns["cid"][some], links[some].astype(np.int64), columns["cid"][root[some]]


def _visits(which: np.ndarray, cells: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Whether each vector visits the cell next to it."""
    sizes = np.array([len(o) for o in others])
    keys = np.repeat(np.arange(len(others)), sizes) << 32 | np.concatenate(others).astype(np.int64)
    return np.isin(which << 32 | cells, keys)


def _link_batches(threshold: float):
    keys = ("label", "size", "cell", "visit", "i", "j")
    numbers = (*keys, "part", "home", "cid", "copies")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                rest = batch if rest is None else pa.concat_batches([rest, batch])
            if rest is None or not rest.num_rows:
                continue
            columns = {name: rest.column(name).to_numpy(zero_copy_only=False) for name in numbers}
            changed = np.zeros(rest.num_rows - 1, bool)
            for name in keys:
                changed |= columns[name][1:] != columns[name][:-1]
            cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), rest.num_rows]
            done = len(cuts) - 1 if batch is None else len(cuts) - 2  # the last group may go on
            out = []
            for a, b in itertools.pairwise(cuts[: done + 1]):
                if b - a > 1:
                    part = rest.slice(a, b - a)
                    vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    others = [np.array(o or [], np.int64) for o in part.column("others").to_pylist()]
                    group = {name: column[a:b] for name, column in columns.items()}
                    out.append(_group_links(group, vectors.reshape(b - a, -1), others, threshold))
            if out:
                cid, links, root = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_pydict({"cid": pa.array(cid), "links": pa.array(links), "root": pa.array(root)})
            rest = rest.slice(cuts[done])

    return link


def _candidates(placed: DataFrame, tile: int) -> DataFrame:
    """Rows of groups: the residents of a cell with each other, and with its visitors, in tiles where it is large."""
    shared = ["cid", "copies", "label", "size", "home", "others", "vector"]
    rows = placed.withColumn("cell", F.explode(F.concat(F.array("home"), "others"))).select(*shared, "cell")
    at_home = F.col("cell") == F.col("home")
    key = ["label", "size", "cell"]
    counts = rows.groupBy(*key).agg(
        F.count(F.when(at_home, True)).alias("residents"), F.count(F.when(~at_home, True)).alias("visitors")
    )
    large = write_shared(counts.where((F.col("residents") > tile) | (F.col("visitors") > tile)), "large")
    rows = rows.join(large, key, "left")
    n_home = F.greatest(F.ceil(F.coalesce("residents", F.lit(0)) / tile), F.lit(1)).cast("int")
    n_away = F.greatest(F.ceil(F.coalesce("visitors", F.lit(0)) / tile), F.lit(1)).cast("int")
    rows = rows.withColumn("n_home", n_home).withColumn("n_away", n_away)
    part = F.pmod(F.xxhash64("cid"), F.when(at_home, F.col("n_home")).otherwise(F.col("n_away"))).cast("int")
    rows = rows.withColumn("part", part)

    def groups(n: str, visit: bool, i, j):
        every = F.sequence(F.lit(0), F.col(n) - 1)
        return F.transform(every, lambda k: F.struct(F.lit(visit).alias("visit"), i(k).alias("i"), j(k).alias("j")))

    own = F.col("part")
    among = groups("n_home", False, lambda k: F.least(own, k), lambda k: F.greatest(own, k))
    with_visitors = groups("n_away", True, lambda k: own, lambda k: k)
    as_visitor = groups("n_home", True, lambda k: k, lambda k: own)
    rows = rows.withColumn("g", F.explode(F.when(at_home, F.concat(among, with_visitors)).otherwise(as_visitor)))
    return rows.select(*shared, "cell", "part", "g.visit", "g.i", "g.j")


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    target: float = TARGET_RECALL,
    tile: int = TILE,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of `vectors`.

    Vectors of one label and one length are linked if their cosine in double precision is at least `threshold`.
    Vectors that are null, empty, zero or hold nulls or numbers that are not finite, and rows without a label or
    an id, are linked with nothing and stay. Equal vectors are one class with its number of copies, so copies are
    never expanded into pairs; repeated rows count as other vectors. An empty table gives no rows.
    """
    small_batches(vectors)
    rows = vectors.select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(label).alias("label"),
        F.col(vector).cast("array<float>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & some
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # Two hashes of 64 bits stand for a class.
    named = rows.withColumn("h1", F.when(F.col("usable"), F.xxhash64("label", "vector")))
    named = named.withColumn("h2", F.when(F.col("usable"), F.xxhash64("vector", "label", F.lit(1))))
    classes = (
        named.where("usable")
        .groupBy("h1", "h2")
        .agg(
            F.min("vec_id").alias("cid"),
            F.count("*").alias("copies"),
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
        )
    )
    # Labels of any kind as numbers.
    classes = write_shared(classes.withColumn("label", F.xxhash64("label")), "classes")
    indexes = _fit(classes, threshold, target)
    schema = T.StructType(
        [
            T.StructField("cid", T.LongType()),
            T.StructField("copies", T.LongType()),
            T.StructField("label", T.LongType()),
            T.StructField("vector", T.ArrayType(T.FloatType())),
            T.StructField("size", T.IntegerType()),
            T.StructField("home", T.IntegerType()),
            T.StructField("others", T.ArrayType(T.IntegerType())),
        ]
    )
    placed = classes.select("cid", "copies", "label", "vector").mapInArrow(_place_batches(indexes), schema)
    candidates = _candidates(write_shared(placed, "placed"), tile)
    keys = ["label", "size", "cell", "visit", "i", "j"]
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_groups = candidates.repartition(parts, *keys).sortWithinPartitions(*keys)
    found_schema = T.StructType([T.StructField(name, T.LongType()) for name in ("cid", "links", "root")])
    found = write_shared(sorted_groups.mapInArrow(_link_batches(threshold), found_schema), "links")
    hanging = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    stats = (
        classes.select("h1", "h2", "cid", "copies")
        .join(links, "cid", "left")
        .join(hanging.withColumnRenamed("node", "cid"), "cid", "left")
        .select("h1", "h2", "cid", "copies", "links", "component")
    )
    joined = named.select("vec_id", "h1", "h2").join(stats, ["h1", "h2"], "left")
    n_links = F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0))
    component = F.coalesce("component", "cid", "vec_id")
    return joined.select(
        "vec_id",
        n_links.cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
