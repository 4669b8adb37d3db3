"""Mixing, chats, near-duplicates, archives and the pipeline against brute force."""

import hashlib
import json
import os
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from shardlift.llm import ORACLES, QUERIES, chat, components, mixing, multiindex, simhash, warc

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(1)
    links = [(k, k + 1) for k in range(1000, 1060)] + [(7, k) for k in range(200, 400)]
    links += [(draw.randrange(100), draw.randrange(100)) for _ in range(60)]
    nodes = {n for link in links if link[0] != link[1] for n in link}
    table = spark.createDataFrame([*links, (None, 3), (5, None), (9, 9)], "a long, b long")
    got = components.components(table).collect()
    assert {r["node"]: r["component"] for r in got} == least_reachable(nodes, [x for x in links if x[0] != x[1]])
    assert len(got) == len(nodes)
    assert components.components(table.limit(0)).collect() == []


# Mixing


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, held = 1.5 * sum(sizes.values()), set()
    while True:
        open_sources = [s for s in names if s not in held]
        rest = total - sum(2 * sizes[s] for s in held)
        level = rest / sum(weight[s] for s in open_sources) if open_sources else 0
        over = {s for s in open_sources if level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in held else level * weight[s] for s in names}
        held |= over


def test_mixing(spark):
    draw = random.Random(3)
    rows = [
        (k, "w " * draw.randrange(1, 60), "en", draw.choice(["a"] * 6 + ["b", "B", "é", None]), 1) for k in range(600)
    ]
    rows += [(5000 + k, text, "en", "a", 1) for k, text in enumerate([None, "", " \n", "w " * 500])]
    rows += [rows[0]] * 5 + [(None, "w w w", "en", "b", 1), (None, "w w w", "en", "b", 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("target", F.lit("old"))
    got = mixing.mix(docs, fan_in=8).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for row in got:
        assert row["size"] == len((row["text"] or "").split())
        sizes[row["source"]] += row["size"]
        taken[row["source"]] += row["size"] * row["copies"]
        largest[row["source"]] = max(largest[row["source"]], row["size"])
        assert 0 <= row["copies"] <= 2
    for row in got:
        assert row["source_size"] == sizes[row["source"]]
        assert abs(row["target"] - plain_targets(sizes)[row["source"]]) < 1e-6
    # Repeated rows share one decision: five copies of the first document move together.
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 6 * largest[source]
    again = mixing.mix(docs, fan_in=8).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_pivotal_rounding_keeps_expectations(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 5 as int))").alias("text"), F.lit("s").alias("source")
    )
    ups = Counter()
    for seed in range(4):
        sizes = mixing.mix(docs, share=0.5, seed=seed, fan_in=16).where("copies > 0").groupBy("size").count().collect()
        total = sum(r["size"] * r["count"] for r in sizes)
        assert abs(total - 600) <= 5
        ups.update({r["size"]: r["count"] for r in sizes})
    assert all(abs(ups[size] - 160) < 60 for size in range(1, 6))


def test_mixing_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mix(empty).collect() == []
    blank = spark.createDataFrame([(1, None, "en", None, 1), (2, "", "en", "a", 1)], DOCS)
    assert {(r["size"], r["copies"], r["target"]) for r in mixing.mix(blank).collect()} == {(0, 0, 0.0)}


# Chats


def call(i, name, arguments):
    return f"{chat.OPEN}{json.dumps({'id': i, 'name': name, 'arguments': arguments})}{chat.CLOSE}"


SCHEMAS = {
    "add": {
        "properties": {"x": {"type": "number", "minimum": 0}, "y": {"type": "integer"}, "mode": {"type": "string", "enum": ["up", "down"]}},
        "required": ["x"],
        "additionalProperties": False,
    },
    "any": {"properties": {}},
}


def test_chats(spark):
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "so " + call("c", "any", {"of": "$call:b"}) + call("b", "any", {"of": "$call:a", "and": "$call:a"}) + call("a", "add", {"y": 2, "x": 1.5})),
        (1, 2, "tool", '{"call_id": "a", "content": "3.5"}'),
        (1, 2, "tool", '{"call_id": "a", "content": "9"}'),
        (1, 3, "tool", '{"call_id": "b", "content": "é\\n"}'),
        (1, 4, "tool", '{"call_id": "zz", "content": "lost"}'),
        (1, 4, "tool", "not json"),
        (1, 5, "assistant", call("d", "add", {"x": -1, "y": 1.5, "mode": "left", "q": 0}) + call("e", "none", {}) + call("f", "any", {"of": "$call:f"})),
        (1, 6, "assistant", chat.OPEN + "{broken" + chat.CLOSE + call("g", "any", {"of": "$call:h", "to": "$call:nope"}) + call("a", "any", {})),
        (1, 7, "assistant", call("h", "add", {})),
        (None, 1, "assistant", call("n", "any", {})),
        (None, 2, "tool", '{"call_id": "n", "content": "x"}'),
        (2, 0, None, None),
        (2, 0, "user", "twice"),
        (2, 0, "user", "twice"),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("step", F.lit(1))
    got = chat.format_chats(messages, chat.schema_table(spark, SCHEMAS)).collect()
    lines = {(r["turn"], r["call_id"]): r for r in got if r["conv_id"] == 1 and r["kind"] == "call"}
    assert lines[1, "a"]["json"] == '{"arguments":{"x":1.5,"y":2},"call_id":"a","kind":"call","name":"add","result":"3.5"}'
    assert [lines[1, i]["step"] for i in "abc"] == [1, 2, 3]
    assert lines[1, "a"]["problems"] == "repeated call; repeated result"
    assert lines[1, "b"]["problems"] == "" and json.loads(lines[1, "b"]["json"])["result"] == "é\n"
    assert lines[1, "c"]["problems"] == "no result"
    assert lines[5, "d"]["problems"] == "no result; not a choice: mode; out of range: x; unknown argument: q; wrong type: y"
    assert lines[5, "e"]["problems"] == "no result; unknown tool"
    assert lines[5, "f"]["problems"] == "no result; waits for itself"
    assert lines[6, "g"]["problems"] == "needs a later call; needs an unknown call; no result"
    assert lines[7, "h"]["problems"] == "missing argument: x; no result"
    broken = [r for (turn, i), r in lines.items() if i.startswith("?")]
    assert len(broken) == 1 and broken[0]["problems"] == "no call; no result"
    assert lines[6, "a"]["problems"] == "repeated call; repeated result; result before call"
    orphans = {(r["turn"], r["call_id"]) for r in got if r["kind"] == "orphan" and r["conv_id"] == 1}
    assert orphans == {(4, "zz"), (4, None)}
    said = [r["json"] for r in got if r["kind"] == "message" and r["conv_id"] == 2]
    assert sorted(said) == ['{"content":"","kind":"message"}'] + ['{"content":"twice","kind":"message","role":"user"}'] * 2
    assert [r["problems"] for r in got if r["conv_id"] is None and r["kind"] == "call"] == ["no result"]
    assert chat.format_chats(messages.limit(0), chat.schema_table(spark, SCHEMAS)).collect() == []


# SimHash


def plain_print(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies():
    draw = random.Random(5)
    words = [f"w{k}" for k in range(500)]
    base = [draw.choice(words) for _ in range(300)]
    rows = []
    for k in range(250):
        text = list(base)
        for _ in range(draw.randrange(4)):
            text[draw.randrange(300)] = draw.choice(words)
        rows.append((1000 - k, " ".join(text)))
    rows += [(2000 + k, " ".join(draw.choice(words) for _ in range(40))) for k in range(60)]
    rows += [(3000 + k, t) for k, t in enumerate([None, "", " \n\t", "A b", "a  B", "a b c d", "x"])]
    return rows + [(3003, "A b"), (4000, base[0]), (4001, "long " * 50000)]


def test_simhash(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(0))
    prints = {(i, t): plain_print(t) for i, t in rows}
    every = list(prints.items())
    links = [
        (a[0], b[0]) for k, (a, p) in enumerate(every) for b, q in every[k + 1 :] if (p ^ q).bit_count() <= 4
    ]
    want = least_reachable({i for i, _ in rows}, links)
    assert Counter(want.values()).most_common(1)[0][1] > 100
    for tile in (16, 512):
        classes = spark.createDataFrame(
            [(p - (1 << 64) if p >> 63 else p, i) for p, i in {p: i for (i, _), p in every}.items()], "fp long, node long"
        )
        found = components.components(simhash.fingerprint_links(classes, tile=tile))
        by_node = {r["node"]: r["component"] for r in found.collect()}
        nodes = {p: i for (i, _), p in every}
        pairs = [(nodes[p], nodes[q]) for k, p in enumerate(nodes) for q in list(nodes)[k + 1 :] if (p ^ q).bit_count() <= 4]
        plain = least_reachable({n for pair in pairs for n in pair}, pairs)
        assert by_node == plain
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for row in got:
        assert row["component_id"] == want[row["doc_id"]]
        assert int(row["fingerprint"], 16) in {p for (i, _), p in prints.items() if i == row["doc_id"]}
    kept = simhash.one_of_each(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(want.values()))
    assert kept[0].asDict().keys() == {"doc_id", "text", "fp"}


def test_simhash_ids(spark):
    one, other = "a b c d e f g", "p q r s t u v"
    rows = [(None, one), (5, one), (5, other), (6, other), (None, "alone here"), (5, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(docs)
    assert Counter((r["doc_id"], r["component_id"]) for r in got.collect()) == {(None, 5): 1, (5, 5): 3, (6, 5): 1, (None, None): 1}
    assert Counter(r["doc_id"] for r in simhash.one_of_each(docs).collect()) == {None: 1, 5: 1}
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    assert simhash.one_of_each(docs.limit(0)).collect() == []


def test_simhash_links_over_rows_without_ids(spark):
    """Brute force with a third of the ids missing: such rows bridge documents, and one row of their own stays."""
    draw = random.Random(8)
    rows = [(None if draw.random() < 0.4 else i, t) for i, t in near_copies() if len(t or "") < 10_000][:200]
    rows += [(None, "far away alone one two"), (None, "far away alone one two"), (None, "p q r s t u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1))
    prints = [plain_print(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    first = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            links.append((k, first.setdefault(i, k)))
    root = least_reachable(range(len(rows)), [x for x in links if x[0] != x[1]])
    least = defaultdict(lambda: None)
    for k, (i, _) in enumerate(rows):
        if i is not None and (least[root[k]] is None or i < least[root[k]]):
            least[root[k]] = i
    want = Counter((i, f"{prints[k]:016x}", least[root[k]]) for k, (i, _) in enumerate(rows))
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    kept = Counter(r["doc_id"] for r in simhash.one_of_each(docs).collect())
    assert kept == Counter(least[r] for r in set(root.values()))
    nobody = spark.createDataFrame([(None, "x y"), (None, "x y"), (None, None)], "doc_id long, text string")
    assert [r["component_id"] for r in simhash.near_duplicates(nobody).collect()] == [None] * 3
    assert simhash.one_of_each(nobody).count() == 2


# Embeddings


def test_embeddings(spark):
    random_ = np.random.default_rng(7)
    unit = lambda x: x / np.linalg.norm(x)
    rows, centres = [], [unit(random_.standard_normal(16)) for _ in range(40)]
    for k in range(600):
        noise = unit(random_.standard_normal(16)) * random_.uniform(0, 0.35)
        rows.append((k, (3 * (centres[k % 40 if k % 3 else 0] + noise)).astype(np.float32).tolist(), k % 2))
    rows += [(1000 + k, rows[3][1], rows[3][2]) for k in range(30)]  # copies
    rows += [(2000 + k, random_.standard_normal(16).astype(np.float32).tolist(), 0) for k in range(100)]
    rows += [(2500 + k, [1.0, float(k)], 1) for k in range(5)]  # another length
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [None] + [1.0] * 15]
    rows += [(3000 + k, v, 0) for k, v in enumerate(odd)] + [(3100, rows[0][1], None), (None, rows[0][1], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n_links", F.lit(1))
    usable = [r for r in rows if r[0] is not None and r[2] is not None and (r[0] < 3000)]
    links = []
    for k, (i, v, label) in enumerate(usable):
        x = np.array(v, float)
        for j, w, other in usable[k + 1 :]:
            if other == label and len(w) == len(v):
                y = np.array(w, float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                    links.append((i, j))
    n = Counter(x for link in links for x in link)
    want = least_reachable({r[0] for r in rows if r[0] is not None}, links)
    for tile in (16, 512):
        got = multiindex.near_vectors(table, tile=tile).collect()
        assert len(got) == len(rows)
        assert sum(r["n_links"] for r in got) >= 0.999 * 2 * len(links)
        for row in got:
            if row["vec_id"] is None:
                assert (row["n_links"], row["component_id"], row["kept"]) == (0, None, True)
            else:
                assert row["n_links"] <= n[row["vec_id"]]
                assert row["component_id"] == want[row["vec_id"]]
                assert row["kept"] == (row["vec_id"] == row["component_id"])
    assert multiindex.near_vectors(table.limit(0)).collect() == []


# WARC


def test_warc(spark, tmp_path):
    long = "".join(random.Random(1).choice("abcé \n") for _ in range(300_000))
    pages = [
        (9, "http://x/ a\r\nb", "<p>" * 50),
        (4, "http://y", "<p>" * 50),
        (4, "http://y", "<p>" * 50),
        (None, None, "<p>" * 50),
        (5, "http://z", None),
        (6, "http://z", ""),
        (7, None, "x" * 99),
        (8, None, "x" * 99),
        (10, "u", long),
        (11, "u", long),
        (12, "u", "é" * 50),
        (13, "u", "\r\n\r\n" * 100),
        (None, "u", "n" * 200),
        (None, "u", "n" * 200),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("chunk", F.lit("old"))
    index = warc.write_warc(table, str(tmp_path / "w"), chunk=1000, archive_bytes=2000)
    assert index.count() == len(pages)
    rows = warc.read_warc(index, chunk=700, read_bytes=1000).collect()
    assert max(len(r["data"] or b"") for r in rows) <= 700
    by_page = defaultdict(list)
    for row in rows:
        by_page[row["page_id"]].append(row)
    assert b"".join(r["data"] for r in sorted(by_page[10], key=lambda r: r["chunk"])) == long.encode()
    seen = 0
    for row in sorted(by_page[10], key=lambda r: r["chunk"]):
        seen += len(row["data"])
        assert row["payload_bytes"] == seen
        assert row["payload_digest"] == hashlib.sha256(long.encode()[:seen]).hexdigest()
    last = sorted((r for r in rows if r["last"]), key=repr)
    assert len(last) == len(pages)
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in last)
    response = {4: 2, 5: 1, 6: 1, 7: 1, 8: 1, 10: 1, 12: 1, 13: 1, None: 2}
    want = {(i, "response", None): n for i, n in response.items()}
    want |= {(9, "revisit", 4): 1, (None, "revisit", 4): 1, (11, "revisit", 10): 1}
    assert kinds == want
    html = {i: (h or "").encode() for i, _, h in pages if i is not None}
    for row in last:
        if row["page_id"] is not None:
            assert row["payload_bytes"] == len(html[row["page_id"]])
            assert row["payload_digest"] == hashlib.sha256(html[row["page_id"]]).hexdigest()
    # The files are plain gzip members of plain records.
    import gzip

    text = b"".join(gzip.open(tmp_path / "w" / f).read() for f in sorted(os.listdir(tmp_path / "w")))
    assert text.count(b"WARC/1.1\r\n") == len(pages) and b"WARC-Target-URI: http://x/%20a%0D%0Ab\r\n" in text
    empty = warc.write_warc(table.limit(0), str(tmp_path / "e"))
    assert warc.read_warc(empty).collect() == []


# Queries and pipeline


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "labels", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([row[k] for k in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_with_sql(spark, duck, name):
    got, want = QUERIES[name](spark, FOLDER), duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert plain(map(tuple, got.collect()), got.columns) == plain(want.fetchall(), columns)


def test_queries_of_all_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_query_2_and_3(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    counts = {r["doc_id"]: r for r in QUERIES["op2_token_counts"](spark, FOLDER).collect()}
    coded = {r["doc_id"]: r for r in QUERIES["op3_encoding"](spark, FOLDER).collect()}
    assert counts.keys() == coded.keys() == documents.keys()
    for doc_id, text in documents.items():
        ids = library.encode(text or "")
        assert counts[doc_id]["n_tokens"] == len(ids) and counts[doc_id]["over_limit"] == (len(ids) > 4096)
        assert counts[doc_id]["n_bytes"] == len((text or "").encode())
        ids.append(2)
        assert coded[doc_id]["n_tokens"] == len(ids)
        assert coded[doc_id]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert coded[doc_id]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_query_7(spark, documents):
    prints = {i: plain_print(t) for i, t in documents.items()}
    every = list(prints.items())
    links = [(a, b) for k, (a, p) in enumerate(every) for b, q in every[k + 1 :] if (p ^ q).bit_count() <= 4]
    want = least_reachable(documents, links)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op7_simhash"](spark, FOLDER).collect()}
    assert got == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}


def test_query_8(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").toPandas()
    vectors = np.stack(rows.embedding).astype(float)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    linked = (vectors @ vectors.T >= 0.93) & (rows.label.to_numpy()[:, None] == rows.label.to_numpy()[None, :])
    np.fill_diagonal(linked, False)
    got = {r["vec_id"]: r["n_links"] for r in QUERIES["op8_embeddings"](spark, FOLDER).collect()}
    assert got == dict(zip(rows.vec_id.tolist(), linked.sum(axis=1).tolist(), strict=True))


def test_query_4_6_and_9(spark, documents):
    mixed = QUERIES["op4_mixing"](spark, FOLDER).toPandas()
    assert set(mixed.doc_id) == set(documents) and (mixed.taken <= 2 * mixed["size"]).all()
    toxic = QUERIES["op6_toxicity"](spark, FOLDER).toPandas()
    assert set(toxic.doc_id) == set(documents) and toxic.score.between(0, 1).all()
    scored = QUERIES["op9_lm_scores"](spark, FOLDER).toPandas()
    assert set(scored.doc_id) == set(documents) and (scored.log_likelihood <= 0).all()


def test_pipeline(spark, documents):
    docs, tables = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.write_shared(stage(spark, docs, FOLDER), name)
        tables.append(docs.toPandas())
    rules, toxicity, dedup, mixed, encoded = tables
    assert all(list(t.columns) == columns for t in tables[:-1])
    judged = {r["doc_id"] for r in QUERIES["op1_quality_rules"](spark, FOLDER).where("kept").collect()}
    assert set(rules.doc_id) == judged and set(toxicity.doc_id) <= judged
    prints = {i: plain_print(documents[i]) for i in toxicity.doc_id}
    every = list(prints.items())
    links = [(a, b) for k, (a, p) in enumerate(every) for b, q in every[k + 1 :] if (p ^ q).bit_count() <= 4]
    assert sorted(dedup.doc_id) == sorted(set(least_reachable(prints, links).values()))
    assert set(mixed.doc_id) <= set(dedup.doc_id) and mixed.doc_id.value_counts().max() <= 2
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted(encoded.doc_id) == sorted(mixed.doc_id)
    for text, ids in zip(encoded.text, encoded.ids, strict=True):
        assert list(ids) == [*library.encode(text or ""), 2]
    final = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert sorted(final.doc_id) == sorted(encoded.doc_id)


REPEATED = [
    ('{"b":1,"a":1.10,"a":2}', None),
    ('{"b":{"x":1,"x":1}}', None),
    ('{"b":[{"x":1},{"x":1}],"a":"k:\\":v"}', '{"a":"k:\\":v","b":[{"x":1},{"x":1}]}'),
    ("{", None),
    (None, None),
]


@pytest.mark.parametrize("allowed", ["true", "false"])
def test_canonical_json_is_the_same_in_every_session(spark, allowed):
    other = spark.newSession()
    other.conf.set("spark.sql.variant.allowDuplicateKeys", allowed)
    rows = other.createDataFrame(REPEATED, "text string, want string").select("want", chat.canonical(F.col("text")).alias("got"))
    assert [r for r in rows.collect() if r["want"] != r["got"]] == []


def test_schemas_of_calls(spark):
    """Enums by value and type, patterns and lengths against plain Python; unknown keywords are refused."""
    fields = {
        "flag": {"enum": [True, "1"]},
        "n": {"enum": [1.0, 2]},
        "code": {"type": "string", "pattern": "^[a-z]+$", "minLength": 2, "maxLength": 3},
    }
    values = {"flag": [True, "true", "1", 1, False], "n": [1, 1.0, 2, "2", 3], "code": ["ab", "abc", "a", "abcd", "A1"]}
    wrong = {
        "flag": lambda v: ["not a choice"] if not (v is True or v == "1" and isinstance(v, str)) else [],
        "n": lambda v: ["not a choice"] if isinstance(v, str) or v not in (1, 2) else [],
        "code": lambda v: ["no match"] * (not re.search("^[a-z]+$", v)) + ["wrong length"] * (not 2 <= len(v) <= 3),
    }
    rows = [(f"{k}{i}", "t", json.dumps({k: v}), False, ", ".join(wrong[k](v))) for k in values for i, v in enumerate(values[k])]
    calls = spark.createDataFrame(rows, "call_id string, name string, arguments string, broken boolean, want string")
    got = chat.validated(calls, chat.schema_table(spark, {"t": {"properties": fields}})).collect()
    assert len(got) == len(rows)
    for row in got:
        assert ", ".join(p.split(":")[0] for p in row["problems"]) == row["want"], row
    for bad in ({"items": {}}, {"type": ["string", "null"]}, {"properties": {}}):
        with pytest.raises(ValueError, match="not supported"):
            chat.schema_table(spark, {"t": {"properties": {"x": bad}}})
