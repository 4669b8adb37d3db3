"""Rules, encoding, token counts, toxicity and language-model scores against plain Python."""

import glob
import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from shardlift.llm import encoding, prefixes, pseudolikelihood, rules, toxicity
from shardlift.llm.registry import QUERIES
from shardlift.shared import shared_folder

PATH = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = [
    None,
    "",
    "   \t\n",
    "a",
    "one two one two one two " * 20,
    "x y z\nx y z\n\n \nx y z\nq",
    "word " * 60,
    " ".join(f"w{k}" for k in range(80)) + " # $ %% <b>",
    "é ñ 中文字符 😀  　 \x1f nbsp here ▁▁ <s> </s> <0x41>",
    "a" * 300,
    " " * 50 + "x",
    "\x00 null",
    "Ends with spaces    ",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, text, "en", f"s{k % 3}" if k % 4 else None, 0) for k, text in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, "no id " * 3, None, "s1", None)]
    # Names of results as columns of the table.
    return spark.createDataFrame(rows, DOCS).withColumn("n_words", F.lit("old")).withColumn("ids", F.lit(1))


def plain_rules(text):
    text = text or ""
    for c in "\t\x0b\x0c\r":
        text_words = text.replace(c, " ") if c == "\t" else text_words.replace(c, " ")
    words = [w for w in text_words.replace("\n", " ").split(" ") if w]
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + s for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for s in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if any(c not in " \t\n\x0b\x0c\r" for c in line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered), failed


def test_rules(docs):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = rules.quality_rules(docs).collect()
    assert len(got) == len(TEXTS) + 3
    for row in got:
        assert tuple(row[name] for name in names) == plain_rules(row["text"])
    failed, n = Counter(), Counter()
    for row in got:
        n[row["source"]] += 1
        failed[row["source"]] += row["base_failed"]
    mean = sum(failed.values()) / sum(n.values())
    variance = sum(failed[h] ** 2 / n[h] for h in n) / sum(n.values()) - mean**2
    weight = max(0, mean * (1 - mean) / variance - 1)
    for row in got:
        rate = (failed[row["source"]] + mean * weight) / (n[row["source"]] + weight)
        assert math.isclose(row["host_rate"], rate)
        assert row["kept"] == (not row["base_failed"] and not rate > 0.5)


def test_a_bad_host_takes_its_documents_along(spark):
    good, bad = " ".join(f"w{k}" for k in range(60)), "short"
    rows = [(k, good if k % 10 else bad, "good") for k in range(100)]
    rows += [(100 + k, good if k % 10 == 0 else bad, "bad") for k in range(100)]
    rows += [(300, good, "tiny")]
    got = rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    kept = {row["source"]: row["kept"] for row in got if row["text"] == good}
    assert kept == {"good": True, "bad": False, "tiny": True}


def test_encoding(docs, library):
    got = encoding.encode(docs, PATH, decoded="decoded").withColumn("digest", encoding.ids_digest()).collect()
    assert len(got) == len(TEXTS) + 3
    for row in got:
        ids = [*library.encode(row["text"] or ""), library.eos_id()]
        assert row["ids"] == ids
        assert row["decoded"] == library.decode(ids)
        assert row["digest"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_merges_of_random_texts(library):
    coder, draw = encoding.Encoder(PATH), random.Random(3)
    some = [" ", "  ", "a", "b", "th", "ing", "=", "0", "é", "中", "国", "\n", "▁", "😀", "aa", "ll", "oo", "0000"]
    texts = ["".join(draw.choice(some) for _ in range(draw.randrange(60))) for _ in range(2000)]
    whole = [p for p in coder.pieces.texts if not p.startswith("<")]
    texts += ["".join(draw.choice(whole) for _ in range(draw.randrange(12))) for _ in range(2000)]
    tokens, counts = coder.encode(texts)
    assert [part.tolist() for part in np.split(tokens, np.cumsum(counts)[:-1])] == library.encode(texts)
    ids = [[draw.choice([draw.randrange(32000), draw.randrange(259)]) for _ in range(draw.randrange(8))] for _ in range(2000)]
    flat = np.array([k for row in ids for k in row])
    assert coder.decode(flat, np.array([len(row) for row in ids])) == [library.decode(row) for row in ids]


def test_decoding_a_table(spark, library):
    rows = [(1, [35, 105]), (2, []), (3, None), (4, library.encode("a  b") + [2])]
    got = encoding.decode(spark.createDataFrame(rows, "k int, ids array<int>"), PATH).collect()
    assert {r["k"]: r["decoded"] for r in got} == {k: library.decode(ids or []) for k, ids in rows}


def test_prefix_counts(docs, library):
    counted = prefixes.prefix_counts(docs, PATH, budget=5)
    for row in counted.collect():
        text = row["text"] or ""
        every = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        assert np.cumsum(np.frombuffer(row["steps"], np.int8)).tolist() == every[1:]
        assert row["n_tokens"] == every[-1] and row["n_bytes"] == len(text.encode())
        assert row["fits_chars"] == max(k for k, n in enumerate(every) if n <= 5)
    again = prefixes.longest_prefix(counted.drop("fits_chars"), 5).select("text", "fits_chars")
    assert sorted(map(repr, again.collect())) == sorted(map(repr, counted.select("text", "fits_chars").collect()))
    at = counted.where("doc_id = 7").select(prefixes.tokens_at(F.lit(20)).alias("n")).first()
    assert at["n"] == len(library.encode(TEXTS[7][:20]))


def test_query_stores_the_count_at_every_prefix(spark, library, tmp_path):
    long = "some words of one text, " * 1200
    texts = [None, "", "one two  three", "é中😀 x", long]
    spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    shared = shared_folder(spark).removeprefix("file://")
    before = set(glob.glob(f"{shared}/**/prefixes-*", recursive=True))
    got = {row["doc_id"]: row for row in QUERIES["op2_token_counts"](spark, str(tmp_path)).collect()}
    (store,) = set(glob.glob(f"{shared}/**/prefixes-*", recursive=True)) - before
    stored = {row["doc_id"]: row["steps"] for row in spark.read.parquet(store).collect()}
    assert set(got) == set(stored) == set(range(len(texts)))
    for k, text in enumerate(texts):
        counts = [0, *np.cumsum(np.frombuffer(stored[k], np.int8), dtype=int).tolist()]
        assert len(counts) == len(text or "") + 1
        for n in range(0, len(counts), 1 if len(counts) < 100 else 997):
            assert counts[n] == len(library.encode((text or "")[:n]))
        assert got[k]["n_tokens"] == counts[-1] == len(library.encode(text or ""))
        assert got[k]["fits_chars"] == max(n for n, c in enumerate(counts) if c <= 4096)
        assert got[k]["over_limit"] == (counts[-1] > 4096)
    assert got[4]["over_limit"] and got[4]["n_bytes"] == len(long)


def test_prefixes_of_random_texts(library):
    counter, draw = prefixes.PrefixCounter(PATH), random.Random(4)
    some = [" ", "  ", "a", "b", "th", "ing", "=", "0", "é", "中", "\n", "▁", "😀", "aa", "ll", "0000"]
    texts = ["".join(draw.choice(some) for _ in range(draw.randrange(40))) for _ in range(500)]
    found = counter.texts(texts)
    for k, text in enumerate(texts):
        assert found.prefixes(k).tolist() == [len(library.encode(text[:n])) for n in range(len(text) + 1)]


def test_folding():
    assert toxicity.fold("1d10t Idi0t! іdiоt ｓcum sc​um") == "idiot idiot! idiot scum scum"
    assert toxicity.fold("In 2015, 42") == "in 2015, 42"


def test_matching():
    lexicon = toxicity.Lexicon({"scum": 2.0, "lowei*": 1.0}, exceptions=("pond scum",))
    matcher = toxicity.Matcher(lexicon)
    assert matcher.hits("scum scumm xscum loweiabc pond scum.") == [(0, 4, 2.0), (17, 22, 1.0)]
    assert toxicity.Matcher(toxicity.Lexicon({})).hits("scum") == []


def test_matching_against_brute_force():
    draw = random.Random(5)
    words = ["aa", "ab", "aab", "ba", "b", "abab"]
    for _ in range(200):
        weights = {draw.choice(words) + draw.choice(["", "*"]): draw.random() for _ in range(3)}
        phrases = tuple({" ".join(draw.choice(words) for _ in range(draw.randrange(1, 4))) for _ in range(2)} - set(weights))
        text = " ".join(draw.choice(words) for _ in range(12))

        def places(term, whole, text=text):
            for m in re.finditer(f"(?={re.escape(term)})", text):
                a, b = m.start(), m.start() + len(term)
                if (a == 0 or text[a - 1] == " ") and (not whole or b == len(text) or text[b] == " "):
                    yield a, b

        best = {}
        for term, weight in weights.items():
            for a, b in places(term.rstrip("*"), not term.endswith("*")):
                if a not in best or weight > best[a][1]:
                    best[a] = b, weight
        spared = [x for phrase in phrases for x in places(phrase, True)]
        want = [(a, b, w) for a, (b, w) in sorted(best.items()) if not any(c <= a and b <= d for c, d in spared)]
        assert toxicity.Matcher(toxicity.Lexicon(weights, phrases)).hits(text) == want


def test_many_exceptions_in_one_text():
    matcher = toxicity.Matcher(toxicity.Lexicon({"scum": 1.0}, ("pond scum",)))
    begin = time.monotonic()
    assert len(matcher.hits("pond scum scum " * 8000)) == 8000
    assert time.monotonic() - begin < 1


def test_contexts_are_whole_words():
    long = "abcde" * 12
    text = f"{long} scum {long}"
    hits = toxicity.Matcher(toxicity.Lexicon({"scum": 1.0})).hits(text)
    assert toxicity.contexts(text, hits) == {"scum", f"{long} scum", f"scum {long}"}
    assert toxicity.contexts("scum", [(0, 4, 1.0)]) == {"scum"}


def test_no_term_is_left_out(spark):
    """More terms than the former bound, the rare ones last: all that are toxic in nearly all of their documents."""
    words = ["".join(chr(97 + k // 26**n % 26) for n in range(4)) for k in range(60_000)]
    rows = [(" ".join(words), 1)] * 5 + [(" ".join(words[:30_000]), 1)] * 2 + [(" ".join(words[:50]), 0)] * 9
    found = toxicity.pure_terms(spark.createDataFrame(rows, "text string, toxic int"))
    assert {r["term"] for r in found.collect()} == set(words[50:])
    assert toxicity.learn(spark.createDataFrame([], "text string, toxic int")) == toxicity.Lexicon({})


def test_toxicity_learns_words_and_exceptions(spark):
    draw = random.Random(1)
    words = [f"w{chr(97 + a)}{chr(97 + b)}" for a in range(20) for b in range(20)]
    docs, labels = [], []
    for k in range(800):
        text = [draw.choice(words) for _ in range(40)]
        toxic = k % 4 == 0
        if toxic:
            text[draw.randrange(40)] = draw.choice(["nasty", "Vile", "n4sty"])
        elif k % 40 == 1:
            text[5:7] = ["nasty", "weather"]
        docs.append((k, " ".join(text)))
        labels.append((k, 1, int(toxic)))
    docs += [(5000, None), (5001, ""), (None, "nasty")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("old"))
    lexicon = toxicity.learn(toxicity.training_rows(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert {"nasty", "vile"} <= set(lexicon.weights) and "nasty weather" in lexicon.exceptions
    got = {row["doc_id"]: row["score"] for row in toxicity.score(frame, lexicon).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == len(docs)
    held = [k for k in range(800) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all((got[k] >= 0.5) == (k % 4 == 0) for k in held)
    assert got[5000] == got[5001] < 0.5


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "scum")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(toxicity.training_rows(docs, labels))
    assert toxicity.score(docs, lexicon).first()["score"] <= 0.5


def test_language_model(spark):
    draw = random.Random(2)
    chain = {w: [f"t{(k * 7 + s) % 50}" for s in (1, 2)] for k, w in enumerate(f"t{k}" for k in range(50))}
    texts = []
    for _ in range(300):
        words = [f"t{draw.randrange(50)}"]
        while len(words) < 60:
            words.append(draw.choice(chain[words[-1]]))
        texts.append(" ".join(words))
    rows = [*enumerate(texts), (900, None), (901, " \n"), (902, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("per_word", F.lit(1))
    model = pseudolikelihood.learn(docs, rounds=8, per_document=60)
    got = {row["doc_id"]: row for row in pseudolikelihood.score(docs, model).collect()}
    assert got[900]["n_words"] == 0 and got[900]["log_likelihood"] == 0 and got[901]["per_word"] is None
    assert got[902]["log_likelihood"] == got[0]["log_likelihood"]
    mean = sum(got[k]["log_likelihood"] for k in range(300)) / sum(got[k]["n_words"] for k in range(300))
    assert -math.log(50) + 0.3 < mean < 0
    # One document by hand: every word given two on each side.
    known = pseudolikelihood.Vocabulary(model.vocabulary)
    ids = [known[w] for w in texts[0].encode().split()]
    padded = [4096, 4096, *ids, 4096, 4096]
    net, total = model.network, 0.0
    for k, token in enumerate(ids):
        context = [padded[k], padded[k + 1], padded[k + 3], padded[k + 4]]
        hidden = np.tanh(np.concatenate([net.embedding[c] for c in context]) @ net.inner + net.inner_bias)
        a, b = net.classes @ hidden + net.class_bias, net.words[token // 64] @ hidden + net.word_bias[token // 64]
        total += a[token // 64] - np.logaddexp.reduce(a) + b[token % 64] - np.logaddexp.reduce(b)
    assert abs(total - got[0]["log_likelihood"]) < 1e-2


def test_language_model_learns_from_every_word(spark):
    draw, texts = random.Random(5), []
    for _ in range(24):
        words = [0]
        while len(words) < 6000:
            words.append((words[-1] * 7 + draw.choice((1, 2))) % 50)
        texts.append(" ".join(f"t{w}" for w in words))
    docs = spark.createDataFrame([*enumerate(texts), (90, "t1 t2"), (91, None)], "doc_id long, text string")
    model = pseudolikelihood.learn(docs)
    train = pseudolikelihood._train_batches(model.vocabulary, model.network, 0, "text", None)
    trained = docs.select("text").mapInArrow(train, pseudolikelihood._BLOCKS)
    assert trained.where("block = 0").agg(F.sum("seen")).first()[0] == 24 * 6000 + 2
    long = pseudolikelihood.score(docs, model).where("doc_id < 24").agg(F.avg("per_word")).first()[0]
    assert long > -math.log(50) + 0.5


def test_language_model_takes_larger_steps_over_every_word(monkeypatch):
    steps = []
    monkeypatch.setattr(pseudolikelihood.Network, "train", lambda self, context, target, state: steps.append(len(target)))
    texts = pa.array([" ".join(f"t{k % 50}" for k in range(100_000))] * 3)
    start = pseudolikelihood.Network.new(np.zeros(4096))
    train = pseudolikelihood._train_batches({}, start, 0, "text", None)
    (found,) = train(iter([pa.RecordBatch.from_pydict({"text": texts})]))
    # Every window once, in few steps: before, each step had 256.
    assert sum(steps) == found.column("seen")[0].as_py() == 300_000
    assert steps[0] == 256 and max(steps) == 4096 and len(steps) < 300_000 / 256 / 4


def test_language_model_learns_rare_words():
    """Two rounds in one task: rare words follow each other as surely as frequent ones."""
    draw = random.Random(3)
    words = []
    for _ in range(60_000):
        k = draw.randrange(300)
        words += [f"r{k}", f"s{k}"] if draw.random() < 0.1 else ["a"]
    vocabulary = {w.encode(): k for k, (w, _) in enumerate(Counter(words).most_common())}
    mass = np.zeros(4096)
    mass[: len(vocabulary)] = [n for _, n in Counter(words).most_common()]
    net = pseudolikelihood.Network.new(mass)
    texts = pa.RecordBatch.from_pydict({"text": pa.array([" ".join(words)])})
    for k in range(2):
        (found,) = pseudolikelihood._train_batches(vocabulary, net, k, "text", None)(iter([texts]))
        flat = np.concatenate([np.frombuffer(v, np.float32) for v in found.column("values").to_pylist()])
        net = pseudolikelihood.Network.of_flat(flat / len(words), net)
    tokens = np.array([vocabulary[w.encode()] for w in words], np.int32)
    mean = pseudolikelihood._sums(net, [tokens], np.array([len(words)]))[0] / len(words)
    # Before, the mean was -1.15.
    assert mean > -0.8


def test_language_model_scores_in_order_of_words(monkeypatch):
    """Products over the words of a class have many rows; before, each chunk of a text had all classes."""
    draw = np.random.default_rng(4)
    net, texts = pseudolikelihood.Network.new(np.ones(4096)), [draw.integers(0, 4096, n) for n in (60_000, 0, 40_000, 1)]
    net.words = draw.normal(size=net.words.shape).astype(np.float32)
    n_words, pieces, runs = np.array([len(t) for t in texts]), [], pseudolikelihood._runs
    monkeypatch.setattr(pseudolikelihood, "_runs", lambda klass: pieces.extend(found := runs(klass)) or found)
    sums = pseudolikelihood._sums(net, texts, n_words)
    assert sum(b - a for _, a, b in pieces) == 100_001 and len(pieces) < 600
    for k, text in enumerate(texts):
        (alone,) = pseudolikelihood._sums(net, [text], n_words[k : k + 1])
        assert abs(alone - sums[k]) < 1e-5 * (1 + abs(alone))


def test_language_model_splits_words():
    draw = random.Random(6)
    characters = [chr(k) for k in range(140)] + ["\u00a0", "\u2028", "\U0001f600"] + [*" \t\n"] * 20
    for _ in range(200):
        texts = ["".join(draw.choices(characters, k=draw.choice((0, 1, 2, 40)))) for _ in range(draw.randrange(6))]
        words, n_words = pseudolikelihood.all_words(pa.array(texts, pa.large_string()))
        want = [pseudolikelihood.words_of(text.encode()) for text in texts]
        assert words.to_pylist() == [word for found in want for word in found]
        assert n_words.tolist() == [len(found) for found in want]


def test_language_model_gives_words_of_a_bucket_their_shares(spark):
    # The frequent words fill the vocabulary; x00q and the others have one length and ending, so they share a bucket.
    common = " ".join(f"c{k}" for k in range(3840))
    rare = ["x00qqq"] * 3 + ["x01qqq"] * 2 + ["x02qqq"]
    rows = [(k, common) for k in range(4)] + [(10 + k, f"c1 {word} c2") for k, word in enumerate(rare)]
    rows += [(20, "c1 x99qqq c2"), (21, "x00qqq x00qqq x02qqq"), (22, None)]
    docs = spark.createDataFrame(rows[:-3], "doc_id long, text string")
    model = pseudolikelihood.learn(docs)
    assert not {b"x00qqq", b"x99qqq"} & set(model.vocabulary)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {row["doc_id"]: row for row in pseudolikelihood.score(frame, model).collect()}
    assert len(got) == len(rows) and all(got[k]["text"] == text for k, text in rows)
    bucket = pseudolikelihood.Vocabulary(model.vocabulary)[b"x00qqq"]
    ids = [model.vocabulary[b"c1"], bucket, model.vocabulary[b"c2"]]
    whole = pseudolikelihood._sums(model.network, [np.array(ids, np.int32)], np.array([3]))[0]
    for k, n in ((10, 3), (13, 2), (15, 1), (20, 1)):  # a word that was not counted has the place of one more
        assert abs(got[k]["log_likelihood"] - whole - math.log(n / (6 + 1))) < 1e-3
    alone = pseudolikelihood._sums(model.network, [np.array([bucket] * 3, np.int32)], np.array([3]))[0]
    assert abs(got[21]["log_likelihood"] - alone - math.log(3 * 3 * 1 / 7**3)) < 1e-3
    assert abs(got[21]["per_word"] - got[21]["log_likelihood"] / 3) < 1e-4 and got[22]["log_likelihood"] == 0
    columns = pseudolikelihood.score(frame, model, keep_text=False).columns
    assert columns == ["doc_id", "n_words", "log_likelihood", "per_word"]


def test_language_model_splits_texts_once(spark, monkeypatch):
    """Counting and the token ids read the texts; training and scores read the ids."""
    made = []
    plain = pseudolikelihood.write_shared

    def kept(df, name):
        made.append((name, plain(df, name)))
        return made[-1][1]

    monkeypatch.setattr(pseudolikelihood, "write_shared", kept)
    texts = ["A b\tc\x0b\x0cd  ", None, " \n", "\u00e0\u00a0b \u0085 X\u00c4", "a" * 30 + " b", "b b a xyz", "\x1cq r"] * 3
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = {row["doc_id"]: row for row in pseudolikelihood.learn_and_score(docs, keep_text=False).collect()}
    words = {k: pseudolikelihood.words_of((text or "").encode()) for k, text in enumerate(texts)}
    assert {k: row["n_words"] for k, row in got.items()} == {k: len(w) for k, w in words.items()}
    # Before, no ids were kept, and each round and the scores split the texts anew.
    (encoded,) = [df for name, df in made if name == "encoded"]
    counted = Counter(itertools.chain.from_iterable(words.values()))
    order = sorted(counted, key=lambda w: (-counted[w], w))
    for row in encoded.collect():
        assert np.frombuffer(row["__tokens"], np.int16).tolist() == [order.index(w) for w in words[row["doc_id"]]]
    strange = pa.array([b"", b"a", b"ab", b"abc", b"x" * 50, "\u00e4\u00df\u20ac".encode()], pa.binary())
    known = pseudolikelihood.Vocabulary({})
    for some in (strange, strange.slice(2)):
        assert pseudolikelihood.buckets_of(some).tolist() == [known[w] for w in some.to_pylist()]


def test_language_model_steps_on_runs_as_on_single_windows():
    """The gradient of the embedding by place of the line is that by neighbour."""
    random = np.random.default_rng(1)
    tokens = random.integers(0, 4096, 300).astype(np.int16)
    line, target = pseudolikelihood._line(tokens, np.array([100, 0, 200]))
    single = np.concatenate([line[p - 2 : p + 3] for p in target]).astype(np.intp)
    found = []
    for cut, places in ((line.astype(np.intp), target), (single, np.arange(300) * 5 + 2)):
        net = pseudolikelihood.Network.new(np.bincount(tokens, minlength=4096).astype(float))
        net.words[:] = net.words + 0.1
        state = pseudolikelihood.Adagrad(net)
        for _ in range(3):
            net.train(cut, places, state)
        found.append(net.flat())
    assert np.abs(found[0] - found[1]).max() < 1e-4
    # All windows once, whether alone or in runs.
    parts = list(pseudolikelihood._mixed(target, 90, random))
    places = [a + k for begins, sizes, _ in parts for a, n in zip(begins.tolist(), sizes.tolist()) for k in range(n)]
    assert sorted(places) == target.tolist() and [longest for *_, longest in parts] == [1, pseudolikelihood.RUN]


@pytest.mark.parametrize("kind", ["rules", "encoding", "prefixes", "toxicity", "lm"])
def test_empty_tables(spark, kind):
    docs = spark.createDataFrame([], DOCS)
    got = {
        "rules": lambda: rules.quality_rules(docs),
        "encoding": lambda: encoding.encode(docs, PATH),
        "prefixes": lambda: prefixes.prefix_counts(docs, PATH),
        "toxicity": lambda: toxicity.score(docs, toxicity.Lexicon({})),
        "lm": lambda: pseudolikelihood.score(docs, pseudolikelihood.learn(docs)),
    }[kind]()
    assert got.collect() == []


def test_prefixes_of_texts_without_spaces(library):
    """Long words are cut where no piece crosses: counts and all prefixes as without the cut, in little time."""
    rng = random.Random(5)
    base64 = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=80_000))
    chinese = "".join(chr(rng.randrange(0x4E00, 0x4E00 + 3000)) for _ in range(2_000))
    texts = [base64, chinese, "x " + base64[:500] + " y", "é" * 200 + base64[:300], base64[:49], base64[:50]]
    counter = prefixes.PrefixCounter(PATH)
    start = time.perf_counter()
    counted = counter.texts(texts)
    taken = time.perf_counter() - start
    assert counted.totals.tolist() == [len(library.encode(t)) for t in texts]
    for k in (2, 3, 4, 5):
        got = counted.prefixes(k).tolist()
        assert got == [len(library.encode(texts[k][:n])) if n else 0 for n in range(len(texts[k]) + 1)]
    ends = [1, 47, 48, 49, 1_000, 40_001]
    assert counted.prefixes(0)[ends].tolist() == [len(library.encode(base64[:n])) for n in ends]
    assert taken < 5
