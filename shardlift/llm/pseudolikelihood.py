"""Masked pseudo-likelihood: a small network predicts each word from the words on both sides.

Words are counted over all documents; the most frequent ones are tokens, the rest fall into buckets by their shape.
The network is trained in tasks, on a window for every word of every document, and the tasks' parameters are
averaged after each round. Texts become token ids once, and rounds and scores read these. A document's score is the sum of the logarithms of its words' probabilities given their neighbours. A
word of a bucket has the bucket's probability times its share of the bucket's words, from the counts of all words.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlift.llm.batches import pieces, raw, small_batches, texts_of, widened, with_columns
from shardlift.shared import write_shared

# Words on each side.
SIDE = 2
# Tokens: classes of equal size, in order of frequency; the last ones are the buckets.
CLASSES, CLASS_SIZE, BUCKETS = 64, 64, 256
EMBEDDING, HIDDEN = 16, 32
ROUNDS = 2
# Windows in a step: few at first, then a share of those seen, up to a bound.
FIRST_BATCH, GROWTH, BATCH = 256, 16, 4096
RATE = 0.1
# Sums of squared gradients begin near nothing, so that rare tokens, whose share of a batch is small, take full steps.
START = 1e-6
# Neighbouring words whose windows are in one step: their sums by token are over the words, not over the windows.
RUN = 32
# Words whose counts go to all tasks; the others' are joined.
KNOWN = 1 << 17
# Distinct words that a task counts before it hands its counts on.
_COUNTED = 300_000
_TOKENS = CLASSES * CLASS_SIZE
_PAD = _TOKENS
_CHUNK = 1 << 13
_BLOCK = 4096
# Parameters that are worked on at once.
_PARAMETERS = 1 << 16
_AROUND = np.array([k for k in range(-SIDE, SIDE + 1) if k])
# Where the components of each token are in an array of all embeddings.
_COMPONENTS = np.arange((_TOKENS + 1) * EMBEDDING).reshape(-1, EMBEDDING)
# Words that a `Vocabulary` remembers the bucket of.
_REMEMBERED = 500_000
_SPACE = bytes([9, 10, 11, 12, 13, 32])
_LOWER = bytes(range(256)).lower()
# Logits below this need no shift before their exponentials are taken.
_SAFE = 60
_ONES = {n: np.ones(n, np.float32) for n in {CLASSES, CLASS_SIZE}}


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def all_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """`words_of` all texts in a row, and how many each text has."""
    data, offsets = raw(texts)
    # Bytes wrap around, so that each range of bytes is one comparison.
    ink = data - np.uint8(9) > 4
    ink &= data != 32
    begins, ends = ink.copy(), ink.copy()
    begins[1:] &= ~ink[:-1]
    ends[:-1] &= ~ink[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner], ends[inner - 1] = ink[inner], ink[inner - 1]
    begins = np.flatnonzero(begins)
    ends = np.cumsum(np.concatenate([[0], np.flatnonzero(ends) + 1 - begins]), dtype=np.int32)
    kept = data.tobytes().translate(_LOWER, _SPACE)
    words = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    return words, np.diff(np.searchsorted(begins, offsets))


@dataclass
class Network:
    embedding: np.ndarray  # tokens and padding
    inner: np.ndarray
    inner_bias: np.ndarray
    classes: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray  # class, word in class
    word_bias: np.ndarray

    @staticmethod
    def new(counts: np.ndarray, seed: int = 0) -> Network:
        """Starts as the frequencies of the tokens."""
        random = np.random.default_rng(seed)
        mass = (counts + 1.0).reshape(CLASSES, CLASS_SIZE)
        return Network(
            (0.1 * random.standard_normal((_TOKENS + 1, EMBEDDING))).astype(np.float32),
            (random.standard_normal((2 * SIDE * EMBEDDING, HIDDEN)) / np.sqrt(2 * SIDE * EMBEDDING)).astype(np.float32),
            np.zeros(HIDDEN, np.float32),
            np.zeros((CLASSES, HIDDEN), np.float32),
            np.log(mass.sum(axis=1) / mass.sum()).astype(np.float32),
            np.zeros((CLASSES, CLASS_SIZE, HIDDEN), np.float32),
            np.log(mass / mass.sum(axis=1, keepdims=True)).astype(np.float32),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, f.name).ravel() for f in fields(self)])

    @staticmethod
    def of_flat(flat: np.ndarray, like: Network) -> Network:
        parts, at = [], 0
        for f in fields(like):
            old = getattr(like, f.name)
            parts.append(flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return Network(*parts)

    def scorer(self) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """Log-probabilities of ascending targets in their contexts; what only the parameters decide is worked out once."""
        inner = self.inner.reshape(2 * SIDE, EMBEDDING, HIDDEN)
        towards = [self.embedding @ inner[k] for k in range(2 * SIDE)]
        classes = np.ascontiguousarray(np.concatenate([self.classes, self.class_bias[:, None]], axis=1).T)
        words = np.concatenate([self.words, self.word_bias[..., None]], axis=2)
        words = np.ascontiguousarray(words.transpose(0, 2, 1))

        def score(context: np.ndarray, target: np.ndarray) -> np.ndarray:
            klass, word = _split(target)
            inner = np.take(towards[0], context[:, 0], axis=0)
            for k in range(1, 2 * SIDE):
                inner += np.take(towards[k], context[:, k], axis=0)
            # The last column is for the biases.
            hidden = np.ones((len(target), HIDDEN + 1), np.float32)
            hidden[:, :-1] = _tanh(inner, self.inner_bias)
            logits = _product(hidden, classes)
            found = _log_softmax_at(logits, klass)
            for c, a, b in _runs(klass):
                np.dot(hidden[a:b], words[c], out=logits[a:b])
            return found + _log_softmax_at(logits, word)

        return score

    def train(self, line: np.ndarray, places: np.ndarray, state: Adagrad) -> None:
        """One step of Adagrad on the windows around these places of a line, which are `SIDE` or more from its ends."""
        n = len(places)
        at = places[_order(line[places])]
        klass, word = _split(line[at])
        runs, rows, share = _runs(klass), np.arange(n), np.float32(1 / n)
        gradient, of_class = state.gradient, state.of_class
        inputs = np.take(self.embedding, line[at[:, None] + _AROUND], axis=0).reshape(n, -1)
        # The last columns are for the biases.
        hidden, inner = np.empty((n, HIDDEN + 1), np.float32), np.empty((n, HIDDEN + 1), np.float32)
        hidden[:, -1] = 1
        out = _tanh(_product(inputs, self.inner), self.inner_bias)
        hidden[:, :-1] = out
        error = _product(hidden, np.ascontiguousarray(state.classes.T))
        _softmax(error, share)
        error.ravel()[rows * CLASSES + klass] -= share
        back = _product(error, self.classes)
        gradient["classes"][:] = _crossed(error, hidden)
        parts = [(of_class[c], hidden[a:b], error[a:b], inner[a:b]) for c, a, b in runs]
        for (words, _, _), given, logits, _ in parts:
            np.dot(given, words, out=logits)
        _softmax(error, share)
        error.ravel()[rows * CLASS_SIZE + word] -= share
        # Classes that are not in the batch have the gradient zero.
        gradient["words"][np.bincount(klass, minlength=CLASSES) == 0] = 0
        last = None
        for (_, words, of_words), given, wrong, more in parts:
            np.dot(wrong, words, out=more)
            if of_words is last:
                of_words += np.dot(wrong.T, given)
            else:
                last = np.dot(wrong.T, given, out=of_words)
        back += inner[:, :-1]
        np.multiply(out, out, out=out)
        back *= np.subtract(1, out, out=out)
        gradient["inner"][:] = _crossed(inputs, back)
        gradient["inner_bias"][:] = np.ones(n, np.float32) @ back
        self._embedding_gradient(line, at, back, gradient["embedding"])
        state.step()

    def _embedding_gradient(self, line: np.ndarray, at: np.ndarray, back: np.ndarray, out: np.ndarray) -> None:
        n, m = len(at), len(line)
        if m >= 2 * n:
            # A row for each neighbour, so that the sums by token run over neighbours.
            sums, line = _product(back, np.ascontiguousarray(self.inner.T)), line[at[:, None] + _AROUND].ravel()
        else:
            # Windows overlap: a row for each place, so that they run once over the line and not for each neighbour.
            placed, sums = np.zeros((m, HIDDEN), np.float32), np.zeros(m * EMBEDDING, np.float32)
            placed[at] = back
            for towards, d in zip(self.inner.reshape(-1, EMBEDDING, HIDDEN), EMBEDDING * _AROUND, strict=True):
                each = np.dot(placed, np.ascontiguousarray(towards.T)).ravel()
                sums[max(d, 0) : len(sums) + min(d, 0)] += each[max(-d, 0) : len(sums) - max(d, 0)]
        out[:] = 0
        np.add.at(out.reshape(-1), np.take(_COMPONENTS, line, axis=0).ravel(), sums.ravel())


# Products of many rows with few columns: in blocks of so many rows they are quicker, as small ones need no packing.
_ROWS = 256


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty((len(a), b.shape[1]), np.float32)
    whole = len(a) // _ROWS * _ROWS
    np.matmul(a[:whole].reshape(-1, _ROWS, a.shape[1]), b, out=out[:whole].reshape(-1, _ROWS, b.shape[1]))
    np.matmul(a[whole:], b, out=out[whole:])
    return out


def _tanh(x: np.ndarray, more: np.ndarray) -> np.ndarray:
    """tanh(x + more) in the place of x; quicker than numpy's, to the last digits."""
    x += more
    x += x
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    np.divide(np.float32(-2), x, out=x)
    x += 1
    return x


def _crossed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b"""
    whole = len(a) // _ROWS * _ROWS
    blocks = a[:whole].reshape(-1, _ROWS, a.shape[1]).transpose(0, 2, 1) @ b[:whole].reshape(-1, _ROWS, b.shape[1])
    return blocks.sum(axis=0) + a[whole:].T @ b[whole:]


class Adagrad:
    """Holds a network's parameters in one array while it is trained, each bias beside its weights."""

    def __init__(self, network: Network) -> None:
        biased = {"classes": "class_bias", "words": "word_bias"}
        held = {name: getattr(network, name) for name in ("embedding", "inner", "inner_bias")}
        for name, bias in biased.items():
            held[name] = np.concatenate([getattr(network, name), getattr(network, bias)[..., None]], axis=-1)
        self.parameters = np.concatenate([part.ravel() for part in held.values()])
        self.squares = np.full_like(self.parameters, START)
        self.gradients, self.scratch = np.zeros_like(self.parameters), np.empty_like(self.parameters)
        ends = np.cumsum([part.size for part in held.values()])[:-1]

        def views(flat: np.ndarray) -> dict[str, np.ndarray]:
            parts = zip(held.items(), np.split(flat, ends), strict=True)
            return {name: part.reshape(like.shape) for (name, like), part in parts}

        self.gradient, own = views(self.gradients), views(self.parameters)
        self.classes = own["classes"]
        # Of each class: parameters by word, by component, gradient.
        self.of_class = [(w.T, w, g) for w, g in zip(own["words"], self.gradient["words"], strict=True)]
        for name, part in own.items():
            if name in biased:
                setattr(network, biased[name], part[..., -1])
                part = part[..., :-1]
            setattr(network, name, part)

    def step(self) -> None:
        for a in range(0, len(self.parameters), _PARAMETERS):
            gradient, squares, scratch = (x[a : a + _PARAMETERS] for x in (self.gradients, self.squares, self.scratch))
            np.multiply(gradient, gradient, out=scratch)
            squares += scratch
            np.sqrt(squares, out=scratch)
            np.divide(gradient, scratch, out=scratch)
            scratch *= np.float32(RATE)
            self.parameters[a : a + _PARAMETERS] -= scratch


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray | float, np.ndarray]:
    """What was taken from each row so that the exponentials, which replace the logits, have sums in range; the sums."""
    ones = _ONES[logits.shape[1]]
    # Rows are rarely near the bounds of 32 bits; the largest logit of each row costs more than the exponentials.
    if logits.max(initial=0) < _SAFE and logits.min(initial=0) > -_SAFE:
        np.exp(logits, out=logits)
        return 0.0, logits @ ones
    most = logits.max(axis=1, keepdims=True)
    logits -= most
    np.exp(logits, out=logits)
    return most[:, 0], logits @ ones


def _softmax(logits: np.ndarray, whole: np.float32) -> None:
    """In place, with this sum."""
    _, sums = _exponentials(logits)
    logits *= np.divide(whole, sums, out=sums)[:, None]


def _log_softmax_at(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The logarithm of the probability at one place of each row; the logits are overwritten."""
    found = logits[np.arange(len(at)), at].astype(float)
    taken, sums = _exponentials(logits)
    return found - taken - np.log(sums)


def _order(tokens: np.ndarray) -> np.ndarray:
    """Stable order of tokens; 16 bits hold them, and numpy sorts these by radix."""
    return np.argsort(tokens.astype(np.int16), kind="stable")


def _split(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and word in class; quicker than numpy's divmod."""
    klass = tokens // CLASS_SIZE
    return klass, tokens - klass * CLASS_SIZE


def _runs(klass: np.ndarray) -> list[tuple[int, int, int]]:
    """(class, begin, end) of the runs of a sorted array, in pieces of `_ROWS` at most."""
    ends = np.searchsorted(klass, np.arange(CLASSES + 1)).tolist()
    spans = enumerate(itertools.pairwise(ends))
    return [(c, k, min(k + _ROWS, b)) for c, (a, b) in spans for k in range(a, b, _ROWS)]


class Vocabulary(dict):
    """Token of a word; words outside get a bucket by their length and last characters, worked out once."""

    def __missing__(self, word: bytes) -> int:
        token = _TOKENS - BUCKETS + zlib.crc32(word[-3:], min(len(word), 20)) % BUCKETS
        if len(self) < _REMEMBERED:
            self[word] = token
        return token


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def buckets_of(words: pa.Array) -> np.ndarray:
    """The tokens that `Vocabulary` gives words outside it."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    if not len(words):
        return np.empty(0, np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    ends, sizes = offsets[1:], np.diff(offsets)
    crc = np.minimum(sizes, 20).astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    for back in (3, 2, 1):
        some = np.flatnonzero(sizes >= back)
        crc[some] = _CRC[(crc[some] ^ data[ends[some] - back]) & 255] ^ (crc[some] >> 8)
    return _TOKENS - BUCKETS + ((crc ^ np.uint32(0xFFFFFFFF)) % BUCKETS).astype(np.int64)


@dataclass(frozen=True)
class Words:
    """The words that tasks know, in order of frequency: the first ones are tokens."""

    known: pa.Array
    n: np.ndarray

    @staticmethod
    def of(vocabulary: dict[bytes, int]) -> Words:
        return Words(pa.array(sorted(vocabulary, key=vocabulary.get), pa.binary()), np.ones(len(vocabulary), np.int64))

    def places(self, words: pa.Array) -> np.ndarray:
        """Places among the known words; -1 for others."""
        return pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy()

    def tokens(self, words: pa.Array, places: np.ndarray) -> np.ndarray:
        return np.where((places >= 0) & (places < _TOKENS - BUCKETS), places, buckets_of(words))

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Words of each text, which of the distinct words all words are; the distinct words, their places and tokens."""
        words, n_words = all_words(texts)
        found = words.dictionary_encode()
        distinct, which = found.dictionary, found.indices.to_numpy()
        places = self.places(distinct)
        return n_words, which, distinct, places, self.tokens(distinct, places).astype(np.int16)


def _counts_of(text: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(held: list[pa.Table]) -> pa.Table:
            sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return sums.rename_columns({"n_sum": "n"}).select(["word", "n"])

        held, n_rows = [], 0
        for batch in pieces(batches, text):
            words, n = all_words(texts_of(batch.column(text)))[0].value_counts().flatten()
            held.append(pa.table({"word": words, "n": n}))
            n_rows += len(words)
            if n_rows > 2 * _COUNTED:
                held = [merged(held)]
                n_rows = held[0].num_rows
                if n_rows > _COUNTED:
                    yield from held[0].to_batches()
                    held, n_rows = [], 0
        if held:
            yield from merged(held).to_batches()

    return count


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (word, n) over all documents; counted inside tasks first."""
    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    return docs.select(text).mapInArrow(_counts_of(text), schema).groupBy("word").agg(F.sum("n").alias("n"))


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros(_TOKENS, np.int64)
    for batch in batches:
        np.add.at(sums, buckets_of(batch.column("word")), batch.column("n").to_numpy())
    buckets = np.flatnonzero(sums[-BUCKETS:])
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(buckets, pa.int32()), "n": sums[-BUCKETS:][buckets]})


def _train_batches(vocabulary: dict[bytes, int], start: Network, seed: int, column: str, most: int | None):
    """The column has texts, or token ids as bytes."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words.of(vocabulary)
        network = Network.of_flat(start.flat().copy(), start)
        state = Adagrad(network)
        random, seen = np.random.default_rng(seed), 0
        for batch in pieces(batches, column):
            held = batch.column(column)
            if pa.types.is_binary(held.type):
                tokens, n_words = _tokens_in(held)
            else:
                n_words, which, *_, token = words.read(texts_of(held))
                tokens = token[which]
            line, target = _line(tokens, n_words)
            if most is not None:
                target = _spread(target, n_words.tolist(), most)
            if not len(target):
                continue
            # Short runs may reach over the end.
            line = np.append(line, np.full(RUN, _PAD, np.int16))
            for begins, sizes, longest in _mixed(target, GROWTH * BATCH - seen, random):
                ends, a, done = np.cumsum(sizes), 0, 0
                while a < len(begins):
                    size = min(BATCH, max(FIRST_BATCH, (seen + done) // GROWTH))
                    b = max(a + 1, int(np.searchsorted(ends, done + size, "right")))
                    network.train(*_cut_out(line, begins[a:b], sizes[a:b], longest), state)
                    a, done = b, int(ends[b - 1])
                seen += done
        if seen:
            flat = network.flat() * np.float32(seen)
            blocks = [flat[a : a + _BLOCK].tobytes() for a in range(0, len(flat), _BLOCK)]
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(range(len(blocks)), pa.int32()),
                    "values": pa.array(blocks, pa.binary()),
                    "seen": pa.array([seen] * len(blocks), pa.int64()),
                }
            )

    return train


def _tokens_in(held: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = raw(pc.fill_null(held.cast(pa.large_binary()), b""))
    return data.view(np.int16), np.diff(offsets) // 2


def _line(tokens: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts in a row, padded before, between and after, and where their words are."""
    before = np.repeat(SIDE * np.arange(1, len(n_words) + 1), n_words)
    target = before + np.arange(len(tokens))
    line = np.full(len(tokens) + SIDE * (len(n_words) + 1), _PAD, np.int16)
    line[target] = tokens
    return line, target


def _mixed(
    target: np.ndarray, alone: int, random: np.random.Generator
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Begins and sizes of runs of places that follow each other, `RUN` at most, in random order, and the longest size.

    The first steps of a task have few windows. So that these are from everywhere, about the first `alone` windows are
    runs of one.
    """
    fresh = np.concatenate([[True], np.diff(target) != 1])
    since = np.arange(len(target))
    since -= np.maximum.accumulate(np.where(fresh, since, 0))
    begins = np.flatnonzero(since % RUN == 0)
    sizes = np.diff(begins, append=len(target))
    order = random.permutation(len(begins))
    begins, sizes = target[begins[order]], sizes[order]
    cut = 0
    if alone > 0:
        cut = int(np.searchsorted(np.cumsum(sizes), alone)) + 1
        n = sizes[:cut]
        singles = np.arange(n.sum()) + np.repeat(begins[:cut] - (np.cumsum(n) - n), n)
        random.shuffle(singles)
        yield singles, np.ones(len(singles), np.int64), 1
    yield begins[cut:], sizes[cut:], RUN


def _cut_out(line: np.ndarray, begins: np.ndarray, sizes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs with `SIDE` neighbours before and after each as a line of their own, and the places of their words."""
    within = np.arange(-SIDE, longest + SIDE)
    inside = (within >= 0) & (within < sizes[:, None])
    return line[begins[:, None] + within].ravel().astype(np.intp), np.flatnonzero(inside)


def _spread(target: np.ndarray, n_words: list[int], most: int) -> np.ndarray:
    """At most so many places of each text, spread over its whole length."""
    ends = np.cumsum([0, *n_words])
    chosen = [
        a + (2 * np.arange(k := min(most, n)) + 1) * n // (2 * k) for a, n in zip(ends[:-1], n_words, strict=True) if n
    ]
    return target[np.concatenate(chosen)] if chosen else target


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, tuple[np.ndarray, int]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            values = np.frombuffer(row["values"], np.float32).astype(np.float64)
            old = sums.get(row["block"], (0.0, 0))
            sums[row["block"]] = (old[0] + values, old[1] + row["seen"])
    yield pa.RecordBatch.from_pydict(
        {
            "block": pa.array(list(sums), pa.int32()),
            "values": pa.array([(v / n).astype(np.float32).tobytes() for v, n in sums.values()], pa.binary()),
            "seen": pa.array([n for _, n in sums.values()], pa.int64()),
        }
    )


_BLOCKS = T.StructType(
    [
        T.StructField("block", T.IntegerType()),
        T.StructField("values", T.BinaryType()),
        T.StructField("seen", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Model:
    vocabulary: dict[bytes, int]
    network: Network
    counts: DataFrame  # (word, n) of all words
    buckets: np.ndarray  # words in each bucket
    words: Words


def _most_frequent(counts: DataFrame) -> tuple[list[bytes], list[int]]:
    """Some of the most frequent words and their counts, enough for the tokens and `KNOWN` at most, in order."""
    step = F.floor(16 * F.log2("n")).cast("int")
    sizes = {row["step"]: row["count"] for row in counts.groupBy(step.alias("step")).count().collect()}
    least, n_words = None, 0
    for k in sorted(sizes, reverse=True):
        if n_words + sizes[k] > KNOWN:
            break
        least, n_words = k, n_words + sizes[k]
    if n_words == sum(sizes.values()) or n_words >= _TOKENS - BUCKETS:
        rows = counts.where(step >= least).collect() if n_words else []
    else:
        # Very many words of nearly one count.
        rows = counts.orderBy(F.desc("n"), "word").limit(_TOKENS - BUCKETS).collect()
    found = sorted((-row["n"], bytes(row["word"])) for row in rows)
    return [word for _, word in found], [-n for n, _ in found]


def _count(docs: DataFrame, text: str) -> tuple[Words, DataFrame, np.ndarray]:
    """The known words, the counts of all words, and the words of each token."""
    counts = write_shared(word_counts(docs, text), "words")
    known, n = _most_frequent(counts)
    words, frequent = Words(pa.array(known, pa.binary()), np.array(n, np.int64)), _TOKENS - BUCKETS
    mass = np.zeros(_TOKENS)
    mass[: len(n[:frequent])] = n[:frequent]
    # All words by their buckets, less those that are tokens.
    np.subtract.at(mass, buckets_of(words.known[:frequent]), n[:frequent])
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])
    summed = counts.mapInArrow(_bucket_counts, schema).groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in summed.collect():
        mass[frequent + row["bucket"]] += row["n"]
    return words, counts, mass


def _train(encoded: DataFrame, mass: np.ndarray, rounds: int, most: int | None) -> Network:
    network = Network.new(mass)
    parts = int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for step in range(rounds):
        trained = encoded.select("__tokens").mapInArrow(_train_batches({}, network, step, "__tokens", most), _BLOCKS)
        summed = trained.repartition(parts, "block").mapInArrow(_sum_blocks, _BLOCKS)
        # A network's worth of rows, however many tasks there were.
        rows = sorted(summed.collect(), key=lambda row: row["block"])
        if not rows:
            break
        network = Network.of_flat(np.concatenate([np.frombuffer(row["values"], np.float32) for row in rows]), network)
    return network


def _learned(
    docs: DataFrame, text: str, rounds: int, per_document: int | None, keep_text: bool
) -> tuple[Model, DataFrame]:
    """The model, and the documents as token ids."""
    small_batches(docs)
    words, counts, mass = _count(docs, text)
    buckets = mass[_TOKENS - BUCKETS :]
    encoded = _encoded(docs, words, buckets, text, keep_text)
    vocabulary = {word: k for k, word in enumerate(words.known[: _TOKENS - BUCKETS].to_pylist())}
    return Model(vocabulary, _train(encoded, mass, rounds, per_document), counts, buckets, words), encoded


def learn(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, per_document: int | None = None) -> Model:
    """Counts all words, keeps the most frequent ones and trains on a window for each word of all documents.

    Token ids are written once and read in each round, and windows are never rows. `per_document` bounds the windows
    that a document gives, spread over its whole length; without it there is no bound.

    The known words and the network have a bounded size, and only they come to the driver. Blocks of parameters are
    summed by a shuffle, not on the driver. Without any words the network gives every token the same probability.
    """
    return _learned(docs.select(text), text, rounds, per_document, False)[0]


def learn_and_score(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, keep_text: bool = True) -> DataFrame:
    """`score` of the documents by the model that `learn` makes of them, with their token ids written once for both."""
    docs = docs.drop("per_word") if text != "per_word" else docs
    model, encoded = _learned(docs, text, rounds, None, keep_text)
    return _scored(encoded, model)


_RARE = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("times", T.LongType())]))
# Logarithms are added as whole numbers, so the order of rows doesn't matter.
_SCALE = 1e9


def _encode_batches(words: Words, buckets: np.ndarray, text: str, keep_text: bool):
    # The share of a word is n / (all + 1), and of words that were not counted 1 / (all + 1) together. Here the divisor
    # is known, and the counts of the known words.
    divisors = np.concatenate([np.zeros(_TOKENS - BUCKETS), np.log(buckets + 1)])
    logs = np.concatenate([np.log(words.n), [0.0]])
    logs[: min(len(words.n), _TOKENS - BUCKETS)] = 0

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            n_words, which, distinct, places, token = words.read(texts_of(batch.column(text)))
            tokens, shares = token[which], logs[places] - divisors[token]
            row = np.repeat(np.arange(len(n_words)), n_words)
            unknown = np.flatnonzero((places < 0)[which])
            keys, times = np.unique(row[unknown] * np.int64(len(distinct) + 1) + which[unknown], return_counts=True)
            rows, word = np.divmod(keys, np.int64(len(distinct) + 1))
            rare = pa.StructArray.from_arrays([distinct.take(pa.array(word)), pa.array(times, pa.int64())], ["word", "times"])
            ends = np.searchsorted(rows, np.arange(len(n_words) + 1)).astype(np.int32)
            at = (2 * np.concatenate([[0], np.cumsum(n_words)])).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), len(n_words), [None, pa.py_buffer(at), pa.py_buffer(tokens)])
            done = with_columns(
                batch,
                {
                    "n_words": pa.array(n_words, pa.int64()),
                    "log_likelihood": pa.array(np.bincount(row, shares[which], len(n_words)), pa.float64()),
                    "__tokens": ids,
                    "__rare": pa.ListArray.from_arrays(pa.array(ends), rare),
                },
            )
            yield done if keep_text else done.drop_columns([text])

    return encode


def _encoded(docs: DataFrame, words: Words, buckets: np.ndarray, text: str, keep_text: bool) -> DataFrame:
    """Writes the rows with a number, their token ids, what the known words' shares add, and the other words."""
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    added = {"n_words": T.LongType(), "log_likelihood": T.DoubleType(), "__tokens": T.BinaryType()}
    schema = widened(numbered, **added, __rare=_RARE)
    if not keep_text:
        schema = T.StructType([field for field in schema.fields if field.name != text])
    return write_shared(numbered.mapInArrow(_encode_batches(words, buckets, text, keep_text), schema), "encoded")


def _score_batches(network: Network):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scored = network.scorer()
        for batch in pieces(batches, "__tokens"):
            tokens, n_words = _tokens_in(batch.column("__tokens"))
            total = batch.column("log_likelihood").to_numpy() + _sums_of(scored, tokens, n_words)
            yield with_columns(batch, {"log_likelihood": pa.array(total)}).drop_columns(["__tokens"])

    return score


def _sums(network: Network, tokens: list[np.ndarray], n_words: np.ndarray) -> np.ndarray:
    """Sums of the words' log-probabilities."""
    return _sums_of(network.scorer(), np.concatenate([np.empty(0, np.int16), *tokens]), n_words)


def _sums_of(scored: Callable[[np.ndarray, np.ndarray], np.ndarray], tokens: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    line, target = _line(tokens, n_words)
    text = np.repeat(np.arange(len(n_words)), n_words)
    sums = np.zeros(len(n_words))
    # In order of the words, so that a chunk has few classes.
    order = _order(tokens)
    for a in range(0, len(order), _CHUNK):
        some = order[a : a + _CHUNK]
        found = scored(line[target[some][:, None] + _AROUND], tokens[some])
        sums += np.bincount(text[some], found, len(n_words))
    return sums


def score(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """All rows of `docs` with `n_words`, `log_likelihood` (their sum) and `per_word` (their mean).

    Null and blank texts have no words, the sum 0 and the mean null. Repeated rows are scored each, an empty table
    gives no rows, and columns of `docs` named like a result give way. Words outside the vocabulary are joined with
    the counts of all words; rows carry their number through that, and the texts are not shuffled for it when
    `keep_text` leaves them out.
    """
    small_batches(docs)
    docs = docs.drop("per_word") if text != "per_word" else docs
    return _scored(_encoded(docs, model.words, model.buckets, text, keep_text), model)


def _scored(encoded: DataFrame, model: Model) -> DataFrame:
    numbered = encoded.drop("__rare")
    schema = T.StructType([field for field in widened(numbered, log_likelihood=T.DoubleType()).fields if field.name != "__tokens"])
    scored = numbered.mapInArrow(_score_batches(model.network), schema)
    rare = encoded.select("__row", F.inline("__rare"))
    # The logarithm of 1 is 0, for words that occur once as for words that were not counted. Each word has one count, so
    # partitions of counts are even, and neither side is sorted.
    counts = model.counts.where("n > 1").select("word", F.round(F.ln("n") * _SCALE).cast("long").alias("__log"))
    shares = rare.join(counts.hint("shuffle_hash"), "word").groupBy("__row").agg(F.sum(F.col("times") * F.col("__log")).alias("__shares"))
    total = F.col("log_likelihood") + F.coalesce(F.col("__shares") / _SCALE, F.lit(0.0))
    kept = [F.col(name) for name in scored.columns if name not in ("__row", "log_likelihood")]
    return scored.join(shares, "__row", "left").select(
        *kept,
        F.round(total, 4).alias("log_likelihood"),
        F.when(F.col("n_words") > 0, F.round(total / F.col("n_words"), 6)).alias("per_word"),
    )
