"""SentencePiece encoding and decoding in Arrow batches: merge rounds over distinct words, gathered per document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlift.llm import pieces as model
from shardlift.llm.batches import pieces, small_batches, texts_of, widened, with_columns

# Distinct words that a process remembers, and their characters; beyond either it starts afresh.
REMEMBERED = 400_000
REMEMBERED_CHARS = 16 << 20


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of all elements of runs that begin at `starts`."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Encoder:
    """Token ids of texts. A word is a space and what follows up to the next; words never share a token, but
    for runs of spaces, which are filled with the longest runs from the left once the words are merged."""

    def __init__(self, path: str) -> None:
        self.pieces = model.load(path)
        self._forget()
        table = [text.replace(model.SPACE, " ").encode() for text in self.pieces.texts]
        for byte, k in enumerate(self.pieces.byte_ids.tolist()):
            table[k] = bytes([byte])
        for k in np.flatnonzero(self.pieces.kinds == 3).tolist():
            table[k] = b""
        for k in np.flatnonzero(self.pieces.kinds == 2).tolist():
            table[k] = " ⁇ ".encode()
        self.sizes = np.array([len(x) for x in table], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.bytes = np.frombuffer(b"".join(table), np.uint8)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)
        self.tokens = np.empty(0, np.int32)

    def _learn(self, words: list[str]) -> None:
        """Merges words and stores their tokens."""
        joined = model.SPACE + model.SPACE.join(words)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        word = np.repeat(np.arange(len(words)), lengths)
        symbols = self.pieces.symbols(codes)
        # Characters that never stand together in a piece cut a word in parts, which keeps rounds few.
        pairs = codes[:-1] << 21 | codes[1:]
        at = np.minimum(np.searchsorted(self.pieces.pair_codes, pairs), len(self.pieces.pair_codes) - 1)
        cut = (self.pieces.pair_codes[at] != pairs) | (word[1:] != word[:-1])
        part = np.concatenate([[0], np.cumsum(cut)])
        word_of_part = word[np.concatenate([[True], cut])]
        merged, part = self.pieces.merge(symbols, part)
        word = word_of_part[part]
        tokens, owner = self._bytes(merged, word)
        counts = np.bincount(owner, minlength=len(words))
        starts = len(self.tokens) + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        self.starts = np.concatenate([self.starts, starts])
        self.counts = np.concatenate([self.counts, counts])
        self.tokens = np.concatenate([self.tokens, tokens.astype(np.int32)])
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.chars += len(joined)

    def _bytes(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become one token for each byte."""
        other = np.flatnonzero((symbols < 0) | (symbols >= self.pieces.size))
        if not len(other):
            return symbols, word
        codes = self._codes(symbols[other])
        encoded = [chr(code).encode() for code in codes.tolist()]
        sizes = np.ones(len(symbols), np.int64)
        sizes[other] = [len(x) for x in encoded]
        out = np.repeat(symbols, sizes)
        begin = np.cumsum(sizes) - sizes
        out[gather(begin[other], sizes[other])] = self.pieces.byte_ids[np.frombuffer(b"".join(encoded), np.uint8)]
        return out, np.repeat(word, sizes)

    def _codes(self, symbols: np.ndarray) -> np.ndarray:
        codes = -1 - symbols
        for k in np.flatnonzero(symbols >= 0):
            codes[k] = self.pieces.char_codes[np.flatnonzero(self.pieces.char_symbols == symbols[k])[0]]
        return codes

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word of the texts in the store, and how many words each text has."""
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

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens in a row, and the number of tokens of each text."""
        word, n_words = self.words(texts)
        counts = self.counts[word]
        tokens = self.tokens[gather(self.starts[word], counts)]
        text = np.repeat(np.repeat(np.arange(len(texts)), n_words), counts)
        tokens, text = self._runs(tokens, text)
        return tokens, np.bincount(text, minlength=len(texts))

    def _runs(self, tokens: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Neighbouring bare spaces become the longest runs there are, from the left."""
        bare = tokens == self.pieces.space
        double = bare[1:] & bare[:-1] & (text[1:] == text[:-1])
        if not double.any():
            return tokens, text
        follows = np.concatenate([[False], double])
        begin = np.flatnonzero(bare & ~follows)
        # Every run has one beginning, so the spaces from one beginning to the next are a run.
        inside = np.add.reduceat(bare, begin)
        out, keep = tokens.copy(), np.ones(len(tokens), bool)
        for a, n in zip(begin[inside > 1].tolist(), inside[inside > 1].tolist(), strict=True):
            run = self.pieces.run(n)
            out[a : a + len(run)] = run
            keep[a + len(run) : a + n] = False
        return out[keep], text[keep]

    def decode(self, tokens: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of runs of token ids: pieces put together, bytes that are no UTF-8 replaced one by one,
        one leading space dropped."""
        sizes = self.sizes[tokens]
        data = self.bytes[gather(self.ends[tokens] - sizes, sizes)]
        text = np.repeat(np.arange(len(counts)), counts)
        ends = np.cumsum(np.bincount(text, sizes, len(counts)).astype(np.int64)) if len(counts) else np.empty(0, np.int64)
        # The space that was put in front goes, where the first piece that is shown begins with it.
        shown = np.flatnonzero(sizes)
        first = np.searchsorted(shown, np.cumsum(counts) - counts)
        first = tokens[shown[np.minimum(first, len(shown) - 1)]] if len(shown) else np.zeros(len(counts), np.int64)
        drop = (self.pieces.kinds[first] == 1) & bool(self.pieces.prefix)
        out, start = [], 0
        for end, dropped in zip(ends.tolist(), drop.tolist(), strict=True):
            part = data[start:end].tobytes()
            start = end
            try:
                decoded = part.decode()
            except UnicodeDecodeError:
                decoded = _lenient(part)
            out.append(decoded.removeprefix(" ") if dropped else decoded)
        return out


def _lenient(data: bytes) -> str:
    """Every byte that begins no whole character becomes U+FFFD."""
    out = []
    while data:
        try:
            out.append(data.decode())
            break
        except UnicodeDecodeError as error:
            out.append(data[: error.start].decode() + "�")
            data = data[error.start + 1 :]
    return "".join(out)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder in each Python process for each model."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _encode_batches(path: str, text: str, end: bool, decoded: str | None):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in pieces(batches, text):
            tokens, counts = coder.encode(texts_of(batch.column(text)).to_pylist())
            if end:
                tokens = np.insert(tokens, np.cumsum(counts), coder.pieces.end)
                counts = counts + 1
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            columns = {"ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens.astype(np.int32)))}
            if decoded:
                columns[decoded] = pa.array(coder.decode(tokens, counts), pa.string())
            yield with_columns(batch, columns)

    return encode


def encode(docs: DataFrame, path: str, text: str = "text", end: bool = True, decoded: str | None = None) -> DataFrame:
    """All rows of `docs` with `ids`, the token ids of the text, and with `decoded` as a column of that name.

    Null texts count as empty: no ids but the end id. Repeated rows are encoded each, an empty table gives no
    rows, and columns of `docs` named like a result give way. Very long words are cut where no piece can cross.
    """
    small_batches(docs)
    added = {"ids": T.ArrayType(T.IntegerType())} | ({decoded: T.StringType()} if decoded else {})
    return docs.mapInArrow(_encode_batches(path, text, end, decoded), widened(docs, **added))


def _decode_batches(path: str, ids: str, text: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            lists = batch.column(ids)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            tokens = lists.flatten().fill_null(0).to_numpy(zero_copy_only=False)
            yield with_columns(batch, {text: pa.array(coder.decode(tokens, counts), pa.string())})

    return decode


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All rows with the text of their token ids; null ids give the empty text, a null id the unknown mark."""
    small_batches(rows)
    return rows.mapInArrow(_decode_batches(path, ids, text), widened(rows, **{text: T.StringType()}))


def ids_digest(ids: str = "ids"):
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256)
