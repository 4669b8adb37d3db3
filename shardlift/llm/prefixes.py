"""Token counts at every prefix of a text, by dynamic programming over the last token.

The tokens of a prefix of an encoded text up to a token's end are the text's own tokens. So the encoding of every
prefix is that of a shorter one and one more token, and of the tokens that end there exactly one fits: the one
that its forerunner does not merge with. A pair fits if the two tokens, put together and encoded, stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlift.llm import pieces as model
from shardlift.llm.batches import pieces, raw, small_batches, texts_of, widened, with_columns
from shardlift.llm.encoding import REMEMBERED, REMEMBERED_CHARS, gather

# Pairs of tokens that a process remembers.
REMEMBERED_PAIRS = 2_000_000
# Words times length that are worked on at once.
_CELLS = 1 << 20
# Words of more characters are cut in parts where no piece crosses.
_CUT = 48


class PrefixCounter:
    """Counts for words (a space and what follows), remembered; runs of spaces are counted apart."""

    def __init__(self, path: str) -> None:
        self.pieces = model.load(path)
        runs = {k for n, k in self.pieces.run_ids.items() if n > 1}
        self.tokens = {text: k for text, k in self.pieces.ids.items() if k not in runs}
        # Token ids by hash of their characters, each length on its own.
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.codes_of_length: dict[int, np.ndarray] = {}
        lengths: dict[int, list[str]] = {}
        for text in self.tokens:
            lengths.setdefault(len(text), []).append(text)
        for n, texts in lengths.items():
            hashes = np.zeros(len(texts), np.uint64)
            for k in range(n):
                hashes = self._roll(hashes, np.array([ord(text[k]) for text in texts]))
            order = np.argsort(hashes)
            if len(np.unique(hashes)) < len(hashes):
                raise ValueError("two pieces have one hash")
            self.by_length[n] = hashes[order], np.array([self.tokens[text] for text in texts])[order]
            self.codes_of_length[n] = np.array([[ord(c) for c in text] for text in texts], np.int64)[order]
        self.token_codes = [np.array([ord(c) for c in text], np.int64) for text in self.pieces.texts]
        self.token_sizes = np.array([len(x) for x in self.token_codes])
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.flat_codes = np.concatenate(self.token_codes)
        self.lengths = np.array(sorted(self.by_length, reverse=True))
        self.pair_keys, self.pair_fits = np.empty(0, np.int64), np.empty(0, bool)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)
        # For each prefix of each word, from the space alone on: its tokens, and whether the first is a space alone.
        self.store = np.empty(0, np.int32)
        self.bare = np.empty(0, bool)

    @staticmethod
    def _roll(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        mixed = (hashes ^ codes.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return mixed ^ (mixed >> np.uint64(29))

    def fits(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether two tokens stay apart when they are put together; negative tokens never merge."""
        out = (first < 0) | (second < 0)
        ask = np.flatnonzero(~out)
        keys = first[ask] * self.pieces.size + second[ask]
        distinct, back = np.unique(keys, return_inverse=True)
        at = np.minimum(np.searchsorted(self.pair_keys, distinct), max(0, len(self.pair_keys) - 1))
        new = distinct[self.pair_keys[at] != distinct] if len(self.pair_keys) else distinct
        if len(new):
            if len(self.pair_keys) + len(new) > REMEMBERED_PAIRS:
                self.pair_keys, self.pair_fits, new = np.empty(0, np.int64), np.empty(0, bool), distinct
            every = np.concatenate([self.pair_keys, new])
            order = np.argsort(every, kind="stable")
            fit = np.concatenate([self.pair_fits, self._stay(new // self.pieces.size, new % self.pieces.size)])
            self.pair_keys, self.pair_fits = every[order], fit[order]
        out[ask] = self.pair_fits[np.searchsorted(self.pair_keys, distinct)][back]
        return out

    def _stay(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        both = np.stack([first, second], axis=1).ravel()
        sizes = self.token_sizes[both]
        codes = self.flat_codes[gather(self.token_starts[both], sizes)]
        pair = np.repeat(np.arange(len(first)), sizes[::2] + sizes[1::2])
        symbols, owner = self.pieces.merge(self.pieces.symbols(codes), pair)
        begin = np.searchsorted(owner, np.arange(len(first)))
        count = np.bincount(owner, minlength=len(first))
        second_at = np.minimum(begin + 1, len(symbols) - 1)
        return (count == 2) & (symbols[begin] == first) & (symbols[second_at] == second)

    def _table(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each prefix of words given as rows of code points: its tokens, and whether the first is a bare space."""
        n, width = codes.shape
        counts = np.zeros((n, width + 1), np.int32)
        bare = np.zeros((n, width + 1), bool)
        last = np.full((n, width + 1), -1, np.int64)
        longest = int(self.lengths[0])
        hashes = np.zeros((longest, n), np.uint64)  # of the characters since each recent place
        for end in range(1, width + 1):
            code = codes[:, end - 1]
            hashes[(end - 1) % longest] = 0
            for start in range(max(0, end - longest), end):
                hashes[start % longest] = self._roll(hashes[start % longest], code)
            waiting = np.flatnonzero(lengths >= end)
            for size in self.lengths[self.lengths <= end].tolist():
                start = end - size
                known, ids = self.by_length[size]
                hashed = hashes[start % longest][waiting]
                at = np.minimum(np.searchsorted(known, hashed), len(known) - 1)
                hit = np.flatnonzero(known[at] == hashed)
                if len(hit):
                    rows, token = waiting[hit], ids[at[hit]]
                    # A hash is only a hint: the characters decide.
                    fit = (codes[rows, start:end] == self.codes_of_length[size][at[hit]]).all(axis=1)
                    if start:
                        fit[fit] = self.fits(last[rows[fit], start], token[fit])
                    rows, token = rows[fit], token[fit]
                    last[rows, end] = token
                    counts[rows, end] = counts[rows, start] + 1
                    bare[rows, end] = bare[rows, start] if start else token == self.pieces.space
                    left = np.ones(len(waiting), bool)
                    left[hit[fit]] = False
                    waiting = waiting[left]
                if not len(waiting):
                    break
            if len(waiting):
                # Characters that are no piece are a token for each byte, and merge with nothing.
                code = codes[waiting, end - 1]
                size = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
                counts[waiting, end] = counts[waiting, end - 1] + size
                bare[waiting, end] = bare[waiting, end - 1]
                last[waiting, end] = -2
        return counts[:, 1:], bare[:, 1:]

    def _learn(self, words: list[str]) -> None:
        words_lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        flat = np.frombuffer((model.SPACE + model.SPACE.join(words)).encode("utf-32-le"), np.uint32).astype(np.int64)
        # Characters that never stand together in a piece cut a long word in parts, which run side by side.
        word = np.repeat(np.arange(len(words)), words_lengths)
        cut = word[1:] != word[:-1]
        inside = np.flatnonzero(words_lengths[word[1:]] > _CUT)
        pairs = flat[inside] << 21 | flat[inside + 1]
        known = self.pieces.pair_codes
        cut[inside] |= known[np.minimum(np.searchsorted(known, pairs), len(known) - 1)] != pairs
        begin = np.concatenate([[0], np.flatnonzero(cut) + 1])
        lengths = np.diff(np.append(begin, len(flat)))
        store, bare = np.zeros(len(flat), np.int32), np.zeros(len(flat), bool)
        order = np.argsort(lengths, kind="stable")
        start = 0
        while start < len(order):
            # Words of nearly one length at a time.
            least = int(lengths[order[start]])
            stop = int(np.searchsorted(lengths[order], least + least // 8, "right"))
            chosen = order[start : max(start + 1, min(stop, start + max(1, _CELLS // least)))]
            start += len(chosen)
            sizes, width = lengths[chosen], int(lengths[chosen].max())
            source = gather(begin[chosen], sizes)
            place = gather(np.arange(len(chosen)) * width, sizes)
            codes = np.zeros(len(chosen) * width, np.int64)
            codes[place] = flat[source]
            counts, firsts = self._table(codes.reshape(len(chosen), width), sizes)
            store[source], bare[source] = counts.ravel()[place], firsts.ravel()[place]
        words_begin = np.cumsum(words_lengths) - words_lengths
        if len(lengths) > len(words):
            # Parts go on counting where the part before ends, and the first part has the word's first token.
            full = np.cumsum(store[begin + lengths - 1]) - store[begin + lengths - 1]
            head = np.searchsorted(begin, words_begin)
            owner = word[begin]
            store += np.repeat(full - full[head][owner], lengths).astype(np.int32)
            later = np.repeat(np.arange(len(begin)) != head[owner], lengths)
            first_bare = bare[begin[head] + lengths[head] - 1]
            bare = np.where(later, first_bare[word], bare)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.store) + words_begin])
        self.sizes = np.concatenate([self.sizes, words_lengths])
        self.store = np.concatenate([self.store, store])
        self.bare = np.concatenate([self.bare, bare])
        self.chars += len(flat)

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [text.replace(model.SPACE, " ").split(" ") if text else [] for text in texts]
        every = [word for words in split for word in words]
        if len(self.known) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self._forget()
        new = list(dict.fromkeys(word for word in every if word not in self.known))
        if new:
            self._learn(new)
        known = self.known
        numbers = np.fromiter((known[word] for word in every), np.int64, len(every))
        return numbers, np.fromiter(map(len, split), np.int64, len(split))

    def texts(self, texts: list[str]) -> TextCounts:
        word, n_words = self.words(texts)
        text = np.repeat(np.arange(len(texts)), n_words)
        full = self.starts[word] + self.sizes[word] - 1
        alone = self.sizes[word] == 1
        # How many spaces without a word stand right before each word of a text.
        places = np.arange(len(word))
        stops = ~alone | np.concatenate([[True], text[1:] != text[:-1]])[: len(word)]
        since = np.maximum.accumulate(np.where(stops, places, 0)) if len(word) else places
        # A stop that is itself a space alone begins a run.
        run = places - since + (alone[since] if len(word) else 0)
        before = np.where(alone, run - 1, 0)
        first = np.concatenate([[True], text[1:] != text[:-1]])[: len(word)]
        follows = np.concatenate([[0], run[:-1] * alone[:-1]])[: len(word)]
        before = np.where(~alone & ~first, follows, before)
        tokens_of_run = self._run_tokens(int(before.max(initial=0)) + 1)
        joined = tokens_of_run[before + 1] - tokens_of_run[before] - 1
        added = self.store[full] + np.where(self.bare[full], joined, 0)
        return TextCounts(self, word, n_words, joined, added)

    def _run_tokens(self, most: int) -> np.ndarray:
        whole, rest = np.divmod(np.arange(most + 1), self.pieces.longest_run)
        return whole + np.array([len(self.pieces.run(n)) for n in range(self.pieces.longest_run)])[rest]


class TextCounts:
    """Token counts of a list of texts, and at each of their prefixes."""

    def __init__(self, counter: PrefixCounter, word, n_words, joined, added) -> None:
        self.counter, self.word, self.joined, self.added = counter, word, joined, added
        self.ends = np.cumsum(n_words)
        self.begins = self.ends - n_words
        total = np.concatenate([[0], np.cumsum(added)]).astype(np.int64)
        self.totals = total[self.ends] - total[self.begins]

    def prefixes(self, k: int) -> np.ndarray:
        """Tokens of the first 0, 1, 2, ... code points of text k."""
        a, b = self.begins[k], self.ends[k]
        if a == b:
            return np.zeros(1, np.int64)
        c, word = self.counter, self.word[a:b]
        sizes = c.sizes[word]
        places = gather(c.starts[word], sizes)
        base = np.cumsum(self.added[a:b]) - self.added[a:b]
        counts = c.store[places] + np.where(c.bare[places], np.repeat(self.joined[a:b], sizes), 0) + np.repeat(base, sizes)
        counts[0] = 0  # the space put in front counts with the first character only
        return counts

    def longest(self, k: int, budget: int) -> int:
        """Code points of the longest prefix of text k with at most so many tokens."""
        if self.totals[k] <= budget:
            return max(0, int(self.counter.sizes[self.word[self.begins[k] : self.ends[k]]].sum()) - 1)
        return int(np.flatnonzero(self.prefixes(k) <= budget)[-1])


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter in each Python process for each model."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def _count_batches(path: str, text: str, budget: int, steps: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(path)
        for batch in pieces(batches, text):
            texts = texts_of(batch.column(text))
            found = counts.texts(texts.to_pylist())
            columns = {
                "n_bytes": pa.array(np.diff(raw(texts)[1])),
                "n_tokens": pa.array(found.totals),
            }
            if steps:
                fits, stored = [], []
                for k in range(len(texts)):
                    tokens = found.prefixes(k)
                    fits.append(int(np.flatnonzero(tokens <= budget)[-1]))
                    steps_of = np.diff(tokens)
                    # One character adds or merges no more tokens than the longest piece has bytes.
                    assert len(steps_of) == 0 or np.abs(steps_of).max() < 128, "a step does not fit its byte"
                    stored.append(steps_of.astype(np.int8).tobytes())
                columns |= {"fits_chars": pa.array(fits, pa.int64()), "steps": pa.array(stored, pa.binary())}
            else:
                columns["fits_chars"] = pa.array([found.longest(k, budget) for k in range(len(texts))], pa.int64())
            yield with_columns(batch, columns)

    return count


def prefix_counts(docs: DataFrame, path: str, text: str = "text", budget: int = 4096, steps: bool = True) -> DataFrame:
    """All rows of `docs` with `n_bytes`, `n_tokens`, `fits_chars` and, if wanted, `steps`.

    `fits_chars` is the length in code points of the longest prefix with at most `budget` tokens. `steps` has a
    signed byte for each code point: by how much the token count of the prefix up to there differs from the one
    before; a count can fall. Null texts count as empty: all zero. Repeated rows are counted each, an empty
    table gives no rows, and columns of `docs` named like a result give way.
    """
    small_batches(docs)
    added = {"n_bytes": T.LongType(), "n_tokens": T.LongType(), "fits_chars": T.LongType()}
    if steps:
        added["steps"] = T.BinaryType()
    return docs.mapInArrow(_count_batches(path, text, budget, steps), widened(docs, **added))


def _answer_batches(budget: int, name: str, total: str | None):
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, totals = [], []
            for steps in batch.column("steps"):
                counts = np.cumsum(np.frombuffer(steps.as_py() or b"", np.int8), dtype=np.int64)
                within = np.flatnonzero(counts <= budget)
                fits.append(int(within[-1]) + 1 if len(within) else 0)
                totals.append(int(counts[-1]) if len(counts) else 0)
            answers = {name: pa.array(fits, pa.int64())}
            yield with_columns(batch, answers | ({total: pa.array(totals, pa.int64())} if total else {}))

    return answer


def longest_prefix(counted: DataFrame, budget: int, name: str = "fits_chars", total: str | None = None) -> DataFrame:
    """From stored `steps`: the length of the longest prefix within a budget, without encoding again.

    The tokens of the whole text are added as the column `total`, if it is named.
    """
    added = {name: T.LongType()} | ({total: T.LongType()} if total else {})
    return counted.mapInArrow(_answer_batches(budget, name, total), widened(counted, **added))


def tokens_at(length: Column) -> Column:
    """From stored `steps`: the tokens of the prefix of so many code points."""
    digits = F.hex(F.substring("steps", F.lit(1), F.least(F.greatest(length, F.lit(0)), F.length("steps"))))
    pairs = F.filter(F.split(F.regexp_replace(digits, "(..)", "$1 "), " "), lambda x: x != "")
    byte = F.transform(pairs, lambda x: F.conv(x, 16, 10).cast("int"))
    return F.aggregate(byte, F.lit(0), lambda total, x: total + F.when(x > 127, x - 256).otherwise(x))
