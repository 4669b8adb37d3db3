"""Quality rules: counts per document, failure rates per host with a beta prior, verdicts joined back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlift.llm.batches import per_text, pieces, raw, small_batches, texts_of, widened, with_columns
from shardlift.shared import write_shared

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS = 50
# Per cent of the words that may lie in repeated windows.
MAX_REPEATED = 50
# A host goes when its shrunken failure rate is above this.
MAX_HOST_RATE = 0.5
WINDOW = 3

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _repeated_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def _repeated_words(texts: list[bytes], n_words: np.ndarray) -> np.ndarray:
    """Words of each text that lie in windows found twice or more in that text."""
    words = [word for text in texts for word in text.split()]
    n = len(words)
    if n < WINDOW:
        return np.zeros(len(texts), np.int64)
    ids, distinct = pd.factorize(np.array(words, dtype=object))
    owner = np.repeat(np.arange(len(texts)), n_words)
    starts = np.flatnonzero(owner[: n - WINDOW + 1] == owner[WINDOW - 1 :])
    # Windows are numbered one word at a time, by exact pairs of numbers, and last by text.
    window = ids[starts]
    for step in range(1, WINDOW):
        window = pd.factorize(window * len(distinct) + ids[starts + step])[0]
    window = pd.factorize(window * len(texts) + owner[starts])[0]
    again = starts[np.bincount(window)[window] > 1]
    covered = np.zeros(n, bool)
    for step in range(WINDOW):
        covered[again + step] = True
    return np.bincount(owner[covered], minlength=len(texts))


def count_rules(texts: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = raw(texts)
    space = _SPACE[data]
    begins = ~space
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins[1:] &= space[:-1] | first[1:-1]
    n_words = per_text(begins, offsets)
    encoded = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    return {
        "n_words": n_words,
        "word_chars": per_text(~space & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_text(_SYMBOL[data], offsets),
        "n_dup_lines": np.array([_repeated_lines(text) for text in texts.to_pylist()], np.int64),
        "n_repeat_words": _repeated_words(encoded, n_words),
    }


def _counter(text: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            counts = count_rules(texts_of(batch.column(text)))
            yield with_columns(batch, {name: pa.array(counts[name], pa.int64()) for name in COUNTS})

    return count


def rule_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the five counts and `base_failed` to every row. A null text counts as empty and fails."""
    small_batches(docs)
    counted = docs.mapInArrow(_counter(text), widened(docs, **dict.fromkeys(COUNTS, T.LongType())))
    return counted.withColumn("base_failed", base_failed())


def base_failed() -> Column:
    too_short = F.col("n_words") < MIN_WORDS
    return too_short | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def host_verdicts(failures: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Rows (host, host_docs, host_failed, host_rate, host_rejected) from rows (host, base_failed).

    The prior is a beta distribution fitted by moments to the hosts' own rates, each weighted by its
    documents: its mean is the overall rate m, its weight k = m(1-m)/v - 1 for the variance v of the rates.
    A host's rate is (failed + m k) / (documents + k). With no variance between hosts every host gets m,
    with the greatest variance every host keeps its own rate. Documents without a host share the host null.
    """
    hosts = write_shared(
        failures.groupBy(host).agg(
            F.count("*").alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("host_failed")
        ),
        "hosts",
    )
    n, failed = F.col("host_docs").cast("double"), F.col("host_failed").cast("double")
    # One row of four sums, however many hosts there are.
    sums = hosts.agg(F.sum(n), F.sum(failed), F.sum(failed * failed / n)).first()
    docs, failures_all, squares = (float(x or 0) for x in sums)
    mean = failures_all / docs if docs else 0.0
    variance = max(0.0, squares / docs - mean * mean) if docs else 0.0
    spread = mean * (1 - mean)
    if variance <= 1e-12:
        rate = F.lit(mean)
    else:
        weight = max(0.0, spread / variance - 1)
        rate = (failed + mean * weight) / (n + weight)
    hosts = hosts.withColumn("host_rate", rate)
    return hosts.withColumn("host_rejected", F.col("host_rate") > max_rate)


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """All rows of `docs` with the counts, `base_failed`, the host's figures and `kept`.

    Null texts count as empty, empty and short texts fail, repeated rows are judged and counted each, null
    hosts are one host, an empty table gives no rows, and columns of `docs` named like a result give way.
    Hosts are summed on the map side, so a host with most of the rows is one row per task.
    """
    counted = rule_counts(docs, text)
    narrow = rule_counts(docs.select(F.col(host).alias("host"), F.col(text).alias("text")))
    verdicts = host_verdicts(narrow.select("host", "base_failed"), "host")
    return _judged(counted, verdicts, host)


def _judged(counted: DataFrame, verdicts: DataFrame, host: str) -> DataFrame:
    results = ["host_docs", "host_failed", "host_rate", "host_rejected"]
    left = counted.drop(*results, "kept").alias("d")
    joined = left.join(verdicts.alias("v"), F.col(f"d.{host}").eqNullSafe(F.col("v.host")), "left")
    return joined.select("d.*", *(f"v.{name}" for name in results)).withColumn(
        "kept", ~F.col("base_failed") & ~F.col("host_rejected")
    )


def judge_ids(docs: DataFrame, text: str = "text", host: str = "source", key: str = "doc_id") -> DataFrame:
    """As `quality_rules`, for the key and the host alone: the texts are counted once and not carried."""
    narrow = docs.select(F.col(key).alias(key), F.col(host).alias("host"), F.col(text).alias("text"))
    counted = write_shared(rule_counts(narrow).drop("text"), "rules")
    return _judged(counted, host_verdicts(counted, "host"), "host")
