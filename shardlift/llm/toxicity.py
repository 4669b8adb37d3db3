"""Toxicity: a weighted lexicon, learned from labelled documents, matched by Aho-Corasick over folded text.

Folding lowers case, maps letters of other scripts that look like Latin ones, and reads digits and signs inside
words as letters. A hit counts where a word begins (and ends, for whole words), unless an exception phrase covers
it. The sum of the hits' weights and their density over the words give the score.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlift.llm.batches import pieces, small_batches, texts_of, widened, with_columns
from shardlift.shared import write_shared

# Bound on the labelled documents that the lexicon and the weights are learned from, picked by a hash of the id.
TRAIN_DOCS = 12_000
# Terms are words and beginnings of words of these lengths.
STEMS = (4, 5, 6, 7, 8)
# A term is in the lexicon if this share of the documents with it is toxic, in this many toxic ones at least.
PURITY = 0.8
MIN_TOXIC = 5
FOLDS = 5

# Letters that look like Latin ones, by the letter they look like.
_LOOKALIKES = {
    "a": "аαɑạ",
    "b": "ьβƅ",
    "c": "сϲς",
    "d": "ԁɗ",
    "e": "еεёҽє",
    "g": "ɡց",
    "h": "һհ",
    "i": "іιıїɪ",
    "j": "јϳ",
    "k": "кκ",
    "l": "ӏɩⅼ",
    "m": "мⅿ",
    "n": "пηո",
    "o": "оοσօ",
    "p": "рρ",
    "q": "ԛգ",
    "r": "гɾ",
    "s": "ѕʂ",
    "t": "тτ",
    "u": "υսʋ",
    "v": "ѵν",
    "w": "ԝωшա",
    "x": "хχ",
    "y": "уүγ",
    "z": "ᴢʐ",
}
_FOLD = {ord(other): letter for letter, others in _LOOKALIKES.items() for other in others}
_FOLD |= {0xFF41 + k: chr(97 + k) for k in range(26)} | {0xFF10 + k: chr(48 + k) for k in range(10)}
# Invisible characters go.
_FOLD |= dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF], None)
_TO_FOLD = re.compile("[" + "".join(map(chr, _FOLD)) + "]")
# Digits and signs read as letters.
_SIGNS = str.maketrans("0134578@$!|", "oieastbasil")
_SIGNED = re.compile(r"[^\W\d_][\w@$!|]*[0-9@$!|]+[^\W\d_]|[0-9@$!|]+[^\W\d_]|[^\W\d_][0-9]+\b")
_SIGNED_WORD = re.compile(r"[\w@$!|]*[0-9@$!|][\w@$!|]*")
_WORD = re.compile(r"[^\W\d_]+")


def _unsigned(match: re.Match) -> str:
    word = match.group()
    inner = word.strip("!|$@") if not word[:1].isalpha() and not word[:1].isdigit() else word.rstrip("!|$@")
    inner = inner or word
    if not any(c.isalpha() for c in inner):
        return word
    start = word.find(inner)
    return word[:start] + inner.translate(_SIGNS) + word[start + len(inner) :]


def fold(text: str) -> str:
    text = text.lower()
    if _TO_FOLD.search(text):
        text = text.translate(_FOLD)
    if _SIGNED.search(text):
        text = _SIGNED_WORD.sub(_unsigned, text)
    return text


def terms_of(text: str) -> set[str]:
    """Words of a folded text, and beginnings of words, marked with a star."""
    words = set(_WORD.findall(text))
    return words | {word[:n] + "*" for word in words for n in STEMS if len(word) > n}


@dataclass(frozen=True)
class Lexicon:
    """Weights by term; exception phrases; the two factors and the constant of the score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    factors: tuple[float, float, float] = (1.0, 1.0, -1.0)


class Matcher:
    """Weighted hits of a lexicon in folded texts."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.automaton = ahocorasick.Automaton()
        found: dict[str, list] = {}
        for term, weight in lexicon.weights.items():
            found.setdefault(term.rstrip("*"), []).append((weight, not term.endswith("*")))
        for phrase in lexicon.exceptions:
            found.setdefault(phrase, []).append((None, True))
        for text, kinds in found.items():
            self.automaton.add_word(text, (len(text), kinds))
        self.empty = not found
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, float]]:
        """Begin, end and weight; one hit for each word at most, the heaviest, and none inside an exception."""
        if self.empty:
            return []
        best: dict[int, tuple[int, float]] = {}
        spared: list[tuple[int, int]] = []
        for last, (size, kinds) in self.automaton.iter(text):
            begin, end = last - size + 1, last + 1
            if begin and text[begin - 1].isalpha():
                continue
            closed = end == len(text) or not text[end].isalpha()
            for weight, whole in kinds:
                if whole and not closed:
                    continue
                if weight is None:
                    spared.append((begin, end))
                elif begin not in best or weight > best[begin][1]:
                    best[begin] = end, weight
        out = [(begin, end, weight) for begin, (end, weight) in sorted(best.items())]
        if spared:
            # The end that is furthest among the exceptions that begin at a place or before it.
            spared.sort()
            begins = [a for a, _ in spared]
            reach = list(accumulate((b for _, b in spared), max))

            def covered(begin: int, end: int) -> bool:
                k = bisect_right(begins, begin)
                return k > 0 and reach[k - 1] >= end

            out = [hit for hit in out if not covered(hit[0], hit[1])]
        return out


def _features(matcher: Matcher, text: str) -> tuple[float, int, int]:
    folded = fold(text)
    hits = matcher.hits(folded)
    return sum(weight for _, _, weight in hits), len(hits), len(folded.split())


def _inputs(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The sum of weights, dampened, and its density in a hundred words; short texts count as fifty words."""
    return np.stack([np.log1p(weight), np.log1p(100 * weight / np.maximum(words, 50)), np.ones(len(weight))], axis=1)


def _fit(inputs: np.ndarray, label: np.ndarray, ridge: float = 1.0) -> tuple[float, float, float]:
    """Logistic regression by Newton's method."""
    factors = np.zeros(inputs.shape[1])
    penalty = np.diag([ridge] * (inputs.shape[1] - 1) + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(inputs @ factors, -30, 30)))
        gradient = inputs.T @ (label - p) - penalty @ factors
        step = np.linalg.solve((inputs * (p * (1 - p))[:, None]).T @ inputs + penalty, gradient)
        factors += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(x) for x in factors)


def held_out(key: str = "doc_id", folds: int = FOLDS) -> Column:
    """Rows of the fold that nothing is learned from; a missing id is held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_DOCS) -> DataFrame:
    """Rows (text, toxic) of at most about `bound` labelled documents outside the held-out fold."""
    usable = labels.where(~held_out()).where("toxic is not null").select("doc_id", "toxic")
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = usable.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, bound / max(1, n))))
    picked = usable.where(share).select(F.col("doc_id").alias("_id"), "toxic")
    # At most about `bound` rows of two numbers.
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    return write_shared(chosen.select("text", "toxic"), "training")


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[tuple[str, int]] = Counter()
    for batch in batches:
        labels = batch.column("toxic").to_pylist()
        for text, label in zip(texts_of(batch.column("text")).to_pylist(), labels, strict=True):
            counts.update((term, label) for term in terms_of(fold(text)))
    terms, labels = zip(*counts, strict=True) if counts else ((), ())
    yield pa.RecordBatch.from_pydict(
        {
            "term": pa.array(terms, pa.string()),
            "toxic": pa.array(labels, pa.int32()),
            "n": pa.array(list(counts.values()), pa.int64()),
        }
    )


def pure_terms(rows: DataFrame) -> DataFrame:
    """Rows (term, toxic, clean): in how many documents of each kind, for terms that are toxic in nearly all of theirs."""
    counts = rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        _count_terms, "term string, toxic int, n long"
    )
    in_class = {name: F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)) for name, k in (("t", 1), ("c", 0))}
    both = counts.groupBy("term").agg(in_class["t"].alias("n_toxic"), in_class["c"].alias("n_clean"))
    pure = (F.col("n_toxic") >= MIN_TOXIC) & (F.col("n_toxic") >= PURITY * (F.col("n_toxic") + F.col("n_clean")))
    return both.where(pure)


def _choose(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    pure = toxic
    # A beginning gives way to a longer one, or a word, that stands for nearly all of its documents.
    chosen = dict(pure)
    for term, n in pure.items():
        stem = term.rstrip("*")
        for cut in range(min(STEMS), len(stem) + (not term.endswith("*"))):
            shorter = stem[:cut] + "*"
            if shorter != term and shorter in chosen and n >= 0.95 * pure[shorter]:
                del chosen[shorter]
    # What a chosen beginning covers adds nothing.
    kept = {}
    for term in sorted(chosen, key=lambda t: (len(t.rstrip("*")), not t.endswith("*"))):
        stem = term.rstrip("*")
        if not any(stem[:n] + "*" in kept for n in STEMS if n < len(stem) or (n == len(stem) and not term.endswith("*"))):
            kept[term] = chosen[term]
    return {
        term: float(np.log((n + 0.5) / (n_toxic + 1)) - np.log((clean.get(term, 0) + 0.5) / (n_clean + 1)))
        for term, n in kept.items()
    }


def _is_letter(character: str) -> bool:
    """As in `_WORD`."""
    return character.isalnum() and not character.isdecimal()


def contexts(text: str, hits: list[tuple[int, int, float]]) -> set[str]:
    """The hit words of a folded text, each with the whole word before it, and with the whole word after it."""
    phrases = set()
    for begin, _, _ in hits:
        word = _WORD.match(text, begin)
        word = word.group() if word else ""
        phrases.add(word)
        if begin > 1 and text[begin - 1] == " ":
            start = begin - 1
            while start and _is_letter(text[start - 1]):
                start -= 1
            if start < begin - 1:
                phrases.add(text[start:begin] + word)
        after = _NEXT.match(text, begin + len(word))
        if after:
            phrases.add(word + after.group())
    return phrases


_NEXT = re.compile(r" [^\W\d_]+")


def _phrases(lexicon: Lexicon):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        counts: Counter[tuple[str, int]] = Counter()
        for batch in batches:
            labels = batch.column("toxic").to_pylist()
            for text, label in zip(texts_of(batch.column("text")).to_pylist(), labels, strict=True):
                folded = fold(text)
                counts.update((phrase, label) for phrase in contexts(folded, matcher.hits(folded)))
        phrases, labels = zip(*counts, strict=True) if counts else ((), ())
        yield pa.RecordBatch.from_pydict(
            {
                "phrase": pa.array(phrases, pa.string()),
                "toxic": pa.array(labels, pa.int32()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )

    return find


def exception_phrases(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Phrases around hits that `MIN_TOXIC` clean documents have, and at most a ninth as many toxic ones."""
    counts = rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        _phrases(lexicon), "phrase string, toxic int, n long"
    )
    in_class = {name: F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)) for name, k in (("t", 1), ("c", 0))}
    both = counts.groupBy("phrase").agg(in_class["t"].alias("n_toxic"), in_class["c"].alias("n_clean"))
    return both.where((F.col("n_clean") >= MIN_TOXIC) & (F.col("n_toxic") * 9 <= F.col("n_clean"))).select("phrase")


def _weights_of_rows(lexicon: Lexicon):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            found = [_features(matcher, text) for text in texts_of(batch.column("text")).to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "toxic": batch.column("toxic").cast(pa.int32()),
                    "weight": pa.array([weight for weight, _, _ in found], pa.float64()),
                    "n_words": pa.array([words for _, _, words in found], pa.int64()),
                }
            )

    return find


def _on(rows: DataFrame, lexicon: Lexicon) -> pd.DataFrame:
    """Three numbers for each training row, of which there is a bounded number."""
    return rows.mapInArrow(_weights_of_rows(lexicon), "toxic int, weight double, n_words long").toPandas()


def learn(rows: DataFrame, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from training rows (text, toxic), whose number is bounded.

    Terms that are frequent in toxic documents and rare in clean ones get the logarithm of their odds as weight.
    Phrases around hits that clean documents have and toxic ones hardly ever become exceptions, next to those
    given. The factors of the score are fitted to the same rows. Without labelled documents of both kinds the
    lexicon is empty and every score is 0.5 or below.
    """
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, exceptions)
    # Only what enters the lexicon, or nearly does, comes to the driver.
    counted = pure_terms(rows).collect()
    toxic = {r["term"]: r["n_toxic"] for r in counted}
    clean = {r["term"]: r["n_clean"] for r in counted}
    weights = _choose(toxic, clean, n_toxic, n_clean)
    lexicon = Lexicon(weights, tuple(sorted(exceptions)))
    learned = {r["phrase"] for r in exception_phrases(rows, lexicon).collect()}
    lexicon = Lexicon(weights, tuple(sorted(learned | set(exceptions))))
    found = _on(rows, lexicon)
    inputs = _inputs(found.weight.to_numpy(), found.n_words.to_numpy())
    return Lexicon(weights, lexicon.exceptions, _fit(inputs, found.toxic.to_numpy(float)))


def _score_batches(lexicon: Lexicon, text: str):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        factors = np.array(lexicon.factors)
        for batch in pieces(batches, text):
            found = [_features(matcher, t) for t in texts_of(batch.column(text)).to_pylist()]
            weight, hits, words = (np.array(x, float) for x in zip(*found, strict=True))
            scores = 1 / (1 + np.exp(-np.clip(_inputs(weight, words) @ factors, -30, 30)))
            yield with_columns(batch, {"score": pa.array(scores), "n_hits": pa.array(hits.astype(np.int64))})

    return score


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """All rows of `docs` with `score` (0 to 1) and `n_hits`.

    Null and empty texts have no hits and get the score of a text without any. Repeated rows are scored each, an
    empty table gives no rows, columns of `docs` named like a result give way.
    """
    small_batches(docs)
    return docs.mapInArrow(
        _score_batches(lexicon, text), widened(docs, score=T.DoubleType(), n_hits=T.LongType())
    )
