"""Phrase collocation mining: HAT-tries in tasks, sorted runs merged by prefix, scores in whole numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardlift.llm.batches import pieces, small_batches, texts_of
from shardlift.llm.hattrie import BITS, HatTrie
from shardlift.shared import write_shared

MIN_COUNT = 10
LONGEST = 3
TOP = 2000
# A phrase goes when a longer one around it has this per cent of its occurrences.
ABSORBED = 50
SCALE = 1_000_000
# Phrases and words that a task holds before it spills; some 150 bytes each.
HELD = 1_500_000
# A filter has 16 bits for each word or pair it holds, up to this many bits in all (32 MB). Beyond that it lets more
# through; what it lets through is counted exactly, so results do not depend on it.
FILTER_BITS = 1 << 28
# Words by which runs are dealt to partitions: few enough to keep subtrees together, enough to divide a common word.
PREFIX = 2
# Bits of one row of Spark's bitmap aggregate.
_ROW_BITS = 32768
_SALTS = 64

# A-Z to a-z, ends of pieces to line feeds, tabs to spaces; every other byte stays.
_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 9 + b" "
)
_BREAK = np.zeros(256, bool)
_BREAK[[10, 32]] = True


def split_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words of the texts in order, and the number of the piece each lies in; pieces never span texts."""
    buffer = b"\n".join(texts).translate(_FOLD)
    data = np.frombuffer(buffer, np.uint8)
    apart = _BREAK[data]
    begins = ~apart
    begins[1:] &= apart[:-1]
    piece = np.cumsum(data == 10)[begins]
    return buffer.split(), piece


def word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, xxhash.xxh64_intdigest(lang, 42))


def mix(hashes: np.ndarray) -> np.ndarray:
    """One hash for each row of word hashes."""
    mixed = hashes[:, 0].copy()
    for k in range(1, hashes.shape[1]):
        mixed ^= mixed >> np.uint64(29)
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[:, k]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


class Filter:
    """A set of phrases by one bit for each hash: says yes to all members, and to few others."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = mix(hashes) & np.uint64(8 * len(self.bits) - 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


class LangCounter:
    """Counts of the phrases of one length in one language."""

    def __init__(self, lang: bytes, length: int, words: Filter | None, shorter: Filter | None) -> None:
        self.lang, self.length = lang, length
        self.words, self.shorter = words, shorter
        self.trie = HatTrie(length)
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.names: list[bytes] = []
        self.hashes = np.empty(0, np.uint64)
        self.known = np.empty(0, bool)

    @property
    def size(self) -> int:
        return self.trie.size + len(self.names)

    def _numbered(self, words: list[bytes]) -> np.ndarray:
        ids = self.ids
        for word in set(words).difference(ids):
            ids[word] = len(ids)
        if len(ids) > len(self.names):
            new = list(ids)[len(self.names) :]
            self.names += new
            if self.words:
                hashes = np.array([word_hash(self.lang, word) for word in new], np.uint64)
                self.hashes = np.concatenate([self.hashes, hashes])
                self.known = np.concatenate([self.known, self.words(hashes[:, None])])
        return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))

    def add(self, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        words, piece = split_words(texts)
        # Ids of a round have to fit; a text has fewer distinct words than it has bytes.
        step = (1 << BITS) - 1
        start = 0
        while start < len(words):
            stop = min(len(words), start + step - self.length)
            if len(self.names) + stop - start > step:
                yield from self.spill(0)
            # The next part begins with the last words of this one: phrases across the cut begin before it.
            end = stop + self.length - 1
            self._add(words[start:end], piece[start:end], stop - start)
            start = stop

    def _add(self, words: list[bytes], piece: np.ndarray, firsts: int) -> None:
        d = self.length
        ids = self._numbered(words)
        n = min(firsts, len(ids) - d + 1)
        if n <= 0:
            return
        fits = piece[:n] == piece[d - 1 : d - 1 + n]
        if self.words:
            good = self.known[ids]
            for k in range(d):
                fits &= good[k : k + n]
        at = np.flatnonzero(fits)
        key = np.zeros(len(at), np.int64)
        for k in range(d):
            key = key << BITS | ids[at + k]
        keys, counts = np.unique(key, return_counts=True)
        if self.shorter and d > 2 and len(keys):
            hashes = self.hashes[self._columns(keys)]
            held = self.shorter(hashes[:, :-1]) & self.shorter(hashes[:, 1:])
            keys, counts = keys[held], counts[held]
        self.trie.add(keys, counts)

    def _columns(self, keys: np.ndarray) -> np.ndarray:
        shifts = [BITS * (self.length - 1 - k) for k in range(self.length)]
        return np.stack([keys >> s & ((1 << BITS) - 1) for s in shifts], axis=1)

    def spill(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Runs (prefix, rest, n): the first two words and the language in one text, the other words in another."""
        names = pa.array(self.names, pa.binary()).cast(pa.string())
        for keys, counts in self.trie.spill(keep):
            words = [names.take(pa.array(ids)) for ids in self._columns(keys).T]
            lang = pa.scalar(self.lang.decode())
            columns = {"prefix": pc.binary_join_element_wise(*words[:PREFIX], lang, " ")}
            if self.length > PREFIX:
                columns["rest"] = pc.binary_join_element_wise(*words[PREFIX:], " ")
            yield pa.RecordBatch.from_pydict(columns | {"n": pa.array(counts, pa.int64())})
        if not self.trie.size:
            self._forget()


def _counting(
    length: int, words: Broadcast | None, shorter: Broadcast | None, held: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [Filter(np.frombuffer(b.value, np.uint8)) if b else None for b in (words, shorter)]
        counters: dict[str, LangCounter] = {}
        for batch in pieces(batches, "text"):
            texts = texts_of(batch.column("text")).cast(pa.large_binary())
            langs = batch.column("lang")
            for lang in pc.unique(langs).to_pylist():
                if lang not in counters:
                    counters[lang] = LangCounter(lang.encode(), length, *filters)
                yield from counters[lang].add(texts.filter(pc.equal(langs, lang)).to_pylist())
                if sum(c.size for c in counters.values()) > held:
                    # The largest language gives up its largest subtrees; one that holds mostly words, all of them.
                    largest = max(counters.values(), key=lambda c: c.size)
                    yield from largest.spill(largest.trie.size // 2 if largest.trie.size > held // 4 else 0)
                    if sum(c.size for c in counters.values()) > held:
                        for counter in counters.values():
                            yield from counter.spill(0)
                        counters.clear()
        for counter in counters.values():
            yield from counter.spill(0)

    return count


def phrase_counts(
    docs: DataFrame, length: int, words: Broadcast | None = None, shorter: Broadcast | None = None, held: int = HELD
) -> DataFrame:
    """Rows (lang, w1 … w<length>, n) from rows (lang, text): all occurrences of the phrases that pass the filters.

    Tasks give sorted runs of their subtrees; runs of one prefix, the first two words at most, meet in one partition
    and are merged there. A phrase is at most one row in a run, so a frequent one is a row for each run only.
    """
    first, last = min(length, PREFIX), max(0, length - PREFIX)
    keys = ["prefix", "rest"] if last else ["prefix"]
    schema = ", ".join([*(f"{key} string" for key in keys), "n long"])
    runs = docs.mapInArrow(_counting(length, words, shorter, held), schema)
    merged = runs.repartition("prefix").groupBy(*keys).agg(F.sum("n").alias("n"))
    # Words hold no spaces; a language may, and stands last.
    parts = F.split("prefix", " ", first + 1)
    taken = [parts[k].alias(f"w{k + 1}") for k in range(first)]
    if last:
        rest = F.split("rest", " ")
        taken += [rest[k].alias(f"w{first + k + 1}") for k in range(last)]
    return merged.select(parts[first].alias("lang"), *taken, "n")


def _positions(names: list[str], size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = [x.encode() for x in batch.column("lang").to_pylist()]
            columns = [
                [word_hash(lang, word.encode()) for lang, word in zip(langs, batch.column(name).to_pylist(), strict=True)]
                for name in names
            ]
            at = mix(np.array(columns, np.uint64).reshape(len(names), -1).T) & np.uint64(size - 1)
            yield pa.RecordBatch.from_pydict({"at": pa.array(at.astype(np.int64))})

    return positions


def phrase_filter(phrases: DataFrame, length: int, most: int = FILTER_BITS) -> Broadcast:
    """A filter of rows (lang, w1 …), built as bitmap rows in tasks; at most `most` bits reach the driver and tasks."""
    names = [f"w{k + 1}" for k in range(length)]
    size = min(most, 1 << max(15, (16 * phrases.count()).bit_length()))
    at = phrases.select("lang", *names).mapInArrow(_positions(names, size), "at long")
    # Spark's bitmap rows count from one.
    number = F.col("at") + 1
    rows = at.groupBy(F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )
    bits = bytearray(size // 8)
    for row in rows.toLocalIterator():
        start = (row["bucket"] - 1) * (_ROW_BITS // 8)
        bits[start : start + len(row["bits"])] = row["bits"]
    return phrases.sparkSession.sparkContext.broadcast(bytes(bits))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE a² / (left right)) in decimals of 38 digits: exact for counts below 10¹⁵."""
    wide = "decimal(15,0)"
    above = (a.cast(wide) * a.cast(wide)).cast("decimal(30,0)") * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", above, left.cast(wide) * right.cast(wide))


def _cut(table: DataFrame, first: list[str], rest: list[str], counts: dict[int, DataFrame], name: str) -> DataFrame:
    """Adds (l, r, score) of one cut as a struct column."""
    joined = table
    for part, column in ((first, "_l"), (rest, "_r")):
        found = counts[len(part)].select(
            F.col("lang"), *(F.col(f"w{k + 1}").alias(word) for k, word in enumerate(part)), F.col("n").alias(column)
        )
        joined = joined.join(found, ["lang", *part])
    struct = F.struct(
        _score(F.col("n"), F.col("_l"), F.col("_r")).alias("score"),
        F.lit(len(first)).alias("k"),
        F.col("_l").alias("l"),
        F.col("_r").alias("r"),
    )
    return joined.withColumn(name, struct).drop("_l", "_r")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    held: int = HELD,
) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): the best phrases of 2 and 3 words for each language.

    Phrases are counted one length at a time. A frequent phrase has frequent parts only, so a length starts from
    filters of the frequent words and of the frequent phrases one word shorter; all counts are exact.

    Null texts and texts without words give nothing, a null language is `und`, repeated rows count each, an empty
    table gives no rows, and other columns do not matter. Very long texts are worked on in parts of 2 million words;
    very frequent words and phrases are one row for each run of a task. Equal scores are ordered by occurrences, then
    by the bytes of the phrase.
    """
    small_batches(docs)
    narrow = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words = write_shared(phrase_counts(narrow, 1, held=held), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    counts = {1: words.where(F.col("n") >= min_count)}
    known = phrase_filter(counts[1], 1)
    shorter = None
    for length in range(2, LONGEST + 1):
        found = phrase_counts(narrow, length, known, shorter, held)
        counts[length] = write_shared(found.where(F.col("n") >= min_count), "phrases")
        if length < LONGEST:
            shorter = phrase_filter(counts[length], length)
    scored = [_candidates(counts, length, min_count) for length in range(2, LONGEST + 1)]
    kept = scored[0]
    for longer in scored[1:]:
        kept = kept.unionByName(longer)
    return _ranked(kept, write_shared(totals, "totals"), top)


def _candidates(counts: dict[int, DataFrame], length: int, min_count: int) -> DataFrame:
    """Rows (lang, phrase, a, l, r, score) of one length, without those that a longer phrase absorbs."""
    names = [f"w{k + 1}" for k in range(length)]
    table = counts[length]
    for k in range(1, length):
        table = _cut(table, names[:k], names[k:], counts, f"cut{k}")
    # The least score, then the shortest first part: structs compare field by field.
    cuts = [F.col(f"cut{k}") for k in range(1, length)]
    table = table.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0])
    around = None
    for longer in range(length + 1, LONGEST + 1):
        for offset in range(longer - length + 1):
            inner = counts[longer].select(
                "lang", *(F.col(f"w{offset + k + 1}").alias(name) for k, name in enumerate(names)), "n"
            )
            around = inner if around is None else around.unionByName(inner)
    if around is not None:
        most = around.groupBy("lang", *names).agg(F.max("n").alias("_most"))
        table = table.join(most, ["lang", *names], "left").where(
            F.col("_most").isNull() | (100 * F.col("_most") < ABSORBED * F.col("n"))
        )
    return table.select(
        "lang",
        F.concat_ws(" ", *names).alias("phrase"),
        F.col("n").alias("a"),
        F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"),
        F.col("cut.score").alias("score"),
    )


def _ranked(table: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """The first `top` of each language; languages are first cut down in parts, since one may hold most phrases."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = Window.partitionBy("lang", "_part").orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    first = (
        table.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
        .withColumn("_rank", F.row_number().over(parts))
        .where(F.col("_rank") <= top)
    )
    ranked = first.withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
