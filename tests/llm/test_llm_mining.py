"""Phrases, main texts and the filter audit against brute force."""

import html as markup
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest

from shardlift.llm import ORACLES, QUERIES, audit, collocations, hattrie, styletree
from shardlift.llm.markup import parse

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n string"


def same_as_sql(got, sql, **tables):
    con = duckdb.connect()
    for name, file in tables.items():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(columns).collect()))) == sorted(map(repr, result.fetchall()))


# Phrases


def test_trie_counts_and_runs():
    draw = random.Random(1)
    trie = hattrie.HatTrie(3, burst=40)
    want, got = Counter(), Counter()
    for turn in range(60):
        words = [[draw.choice([7, 7, 7, draw.randrange(50), draw.randrange(1 << 21)]) for _ in range(3)] for _ in range(100)]
        keys = [(a << 42) | (b << 21) | c for a, b, c in words]
        want.update(keys)
        trie.add(*np.unique(np.array(keys, np.int64), return_counts=True))
        assert all(len(c) <= 40 for c in trie.containers) and trie.starts == sorted(set(trie.starts))
        assert trie.size == sum(map(len, trie.containers))
        if turn % 20 == 19:
            for run, counts in trie.spill(trie.size // 2 if turn < 59 else 0):
                assert (np.diff(run) > 0).all()
                for key, n in zip(run.tolist(), counts.tolist(), strict=True):
                    got[key] += n
    assert got == want and trie.size == 0


def plain_collocations(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for d in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i : i + d]) for i in range(len(words) - d + 1))
    found = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in frequent.items():
            if any(len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in frequent.items()):
                continue
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            rows_.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


def phrase_rows(n):
    draw = random.Random(2)
    words = ["a", "B", "é", "ß", "x y", "New", "york", "CITY", "ÄB", "q" * 300]
    rows = []
    for k in range(n):
        text = "".join(draw.choice(words) + draw.choice([" "] * 8 + ["\t ", ". ", "\n", "!", "  "]) for _ in range(draw.randrange(60)))
        rows.append((k, text + "new york city, New York", draw.choice(["en", "en", "de", None]), "s", "x"))
    return rows + [(None, None, "en", None, None), (1, "", "en", None, None), (2, " \t.\n", "fr", None, None), rows[0]]


@pytest.mark.parametrize("held", [collocations.HELD, 60])
def test_collocations(spark, held):
    rows = phrase_rows(250)
    docs = spark.createDataFrame(rows, DOCS)
    got = collocations.collocations(docs, min_count=5, top=40, held=held).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, 5, 40)
    assert collocations.collocations(docs.limit(0)).collect() == []


def test_long_text_is_cut_without_loss(monkeypatch):
    monkeypatch.setattr(collocations, "BITS", 5)
    monkeypatch.setattr(hattrie, "BITS", 5)
    draw = random.Random(4)
    words = [b"w%d" % draw.randrange(20) for _ in range(500)]
    counter = collocations.LangCounter(b"en", 3, None, None)
    batches = [*counter.add([b" ".join(words)]), *counter.spill(0)]
    got = Counter()
    for batch in batches:
        for row in batch.to_pylist():
            first, second, lang = row["prefix"].split(" ")
            assert lang == "en"
            got[first, second, row["rest"]] += row["n"]
    decoded = [w.decode() for w in words]
    assert got == Counter(zip(decoded, decoded[1:], decoded[2:], strict=False))


def test_filter_lets_members_through(spark):
    rows = [("en", f"w{k}", f"v{k % 7}") for k in range(500)] + [("é", "ß", "x y")]
    table = spark.createDataFrame(rows, "lang string, w1 string, w2 string")
    for most in (1 << 15, 1 << 28):
        held = collocations.Filter(np.frombuffer(collocations.phrase_filter(table, 2, most).value, np.uint8))
        hashes = np.array([[collocations.word_hash(lang.encode(), w.encode()) for w in ws] for lang, *ws in rows], np.uint64)
        assert held(hashes).all()
        assert held(hashes + np.uint64(1)).mean() < 0.2


def test_collocations_query(spark):
    got = QUERIES["op11_collocations"](spark, FOLDER)
    same_as_sql(got, ORACLES["op11_collocations"], documents=f"{FOLDER}/documents.parquet")


# Main texts

PAGES = "page_id long, url string, html string, text string, low string"


def texts(pages):
    return {r["page_id"]: r["text"] for r in styletree.extract(pages).collect()}


def test_query_keeps_the_article(spark):
    """The pages of the tables mark their article; all in it is its text."""
    got = QUERIES["op12_html_text"](spark, FOLDER)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = {r["page_id"]: r for r in got.collect()}
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for page in pages:
        article = re.search("<article>(.*)</article>", page["html"], re.S)[1]
        blocks = [re.sub("<[^>]*>", "", b) for b in re.split("</?p>|</?h1>", article)]
        want = "\n".join(t for t in (" ".join(markup.unescape(b).split()) for b in blocks) if t)
        assert rows[page["page_id"]]["text"] == want and rows[page["page_id"]]["n_chars"] == len(want)


def test_unnamed_branches_go_by_entropy(spark):
    """Pages of plain containers: what all pages of a host share goes, what differs stays, however short."""
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(6))
    rows, want = [], {}
    for k in range(40):
        paras = [" ".join(word() for _ in range(9)) for _ in range(1 + k % 4)]
        links = "".join(f"<li><a href='/{s}'>{s}</a></li>" for s in ("Home", "News", "Sport"))
        body = "".join(f"<p>{p}</p>" for p in paras)
        top = f"<div class=k1><ul>{links}</ul></div>"
        page = f"{top}<div class=k2><h2>Title {word()}</h2>{body}</div><div class=k3>Page {k} of 40, all rights kept</div>"
        rows.append((k, f"https://One.example:80/{k}", page, "old", None))
        want[k] = "\n".join([re.search("<h2>(.*)</h2>", page)[1], *paras])
    # A host with one page keeps what no name removes.
    rows.append((100, "http://two.example/", "<div>Home</div><div>Body</div>", None, None))
    want[100] = "Home\nBody"
    # All pages of a host are copies: they keep their text.
    rows += [(200 + k, "http://three.example/a", "<div>Same</div>", None, None) for k in range(20)]
    want |= {200 + k: "Same" for k in range(20)}
    assert texts(spark.createDataFrame(rows, PAGES)) == want


def test_tree_importance(spark):
    """Entropies of one host's nodes, worked out by hand from their definitions."""
    shapes = ["<div>x1</div><p>a</p>", "<div>x2</div><p>b</p>", "<div>x3</div><p>c</p><p>b</p>", "<div>x4</div><ul><li>d</ul>"]
    pages = spark.createDataFrame([("h", s) for s in shapes], "host string, html string")
    rows = styletree.site_tree(pages).collect()
    root = [r for r in rows if r["content"] is None and r["pages"] == 4]
    # Styles of the root: (div, p) on three pages, (div, ul) on one; two kinds of children.
    entropy = -(0.75 * math.log(0.75, 4) + 0.25 * math.log(0.25, 4))
    assert len(root) == 1 and abs(root[0]["presentation"] - entropy) < 1e-9
    assert abs(root[0]["importance"] - entropy) < 1e-9
    # Under the first style: x1, x2, x3 are alike without digits; a, b, c with b on two of three pages.
    leaves = sorted(round(r["content"], 9) for r in rows if r["pages"] == 3)
    assert leaves == [0.0, round(1 - math.log(2, 3) / 3, 9)]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp text &lt;b&gt; a < b", "plain & text <b> a < b"),
        ("<p>one<p>two<br>three<ul><li>x<li>y</ul>", "one\ntwo three\nx\ny"),
        ("<nav><p>n</p></nav><header>h</header><main><header><h1>T</h1></header>b</main><footer>f</footer>", "T\nb"),
        ("<article><p>a<span class='ad'> buy</span> b</p><form><p>f</p></form></article><div>out</div>", "a b"),
        ("<div class='page has-sidebar'><article>A</article></div><aside><article>t</article></aside>", "A"),
        ("<article>A</article><section id=comments><article>c</article></section>", "A"),
        ("<div class='cookieNotice'>c</div><p>t</p><div role=search>s</div><p hidden>h</p>", "t"),
        ("<script>var a='</p><p>x';</script><style>p{}</style><!-- <p>c --><p>t</p><textarea>z</textarea>", "t"),
        ("<table><tr><td>a<td>b<tr><td>c</table><p title='a>b'>q  r\n</p>", "a b\nc\nq r"),
        ("<div>" * 500 + "deep" + "</div>" * 500, "deep"),
        ("<article> </article><p>t</p>", "t"),
        ("<p>cut <b", "cut"),
    ],
)
def test_pages_by_name(page, want):
    assert "\n".join(styletree.main_blocks(page or "", "h", set())) == want


def test_odd_pages(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "no url", "<p>x</p>", "t", "l")]
    rows += [(2, "http://h/", "<p>" + "y " * 400_000, None, None), (3, "http://h/", "<a " * 300_000, None, None)]
    got = styletree.extract(spark.createDataFrame(rows, PAGES))
    assert got.columns == ["page_id", "url", "low", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got.collect()) == [(0, 1), (1, 0), (1, 0), (2, 799_999), (3, 0)]
    assert styletree.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_parser_takes_anything():
    draw = random.Random(6)
    bits = ["<p>", "</p>", "<div class='a'>", "</div>", "<b>", "</b>", "<li>", "</ul>", "<td>", "<", ">", "&", "'", '"', "=", "<!--", "-->", "x ", "<script>", "</script>", "<main>", "<a href="]
    for _ in range(400):
        page = parse("".join(draw.choice(bits) for _ in range(draw.randrange(60))))
        assert all(page.parent[k] < k for k in range(len(page.parent)))
        assert len(page.parent) == len(page.signature) == len(page.named)


# Audit


def plain_audit(docs, labels):
    least = {}
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    parts = defaultdict(list)
    for doc_id, text, lang, *_ in docs:
        text = text or ""
        words = re.findall(r"[^ \t-\r]+", text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if doc_id is not None and doc_id > least.get(text, doc_id):
            fails.add("E")
        parts[lang or ""].append((fails, doc_id in good and doc_id is not None, doc_id in toxic and doc_id is not None))
    rows, shapley = [], Counter()
    for part, held in parts.items():
        for order in permutations("ABCDE"):
            left = held
            for step, letter in enumerate(order, 1):
                out = [d for d in left if letter in d[0]]
                left = [d for d in left if letter not in d[0]]
                failing = sum(letter in d[0] for d in held)
                rows.append([
                    part, "".join(order), step, len(left), len(out), failing - len(out),
                    sum(d[0] == {letter} for d in held), sum(d[1] for d in out), sum(d[2] for d in out),
                ])
                shapley[part, letter] += len(out)
    return sorted([*r, shapley[r[0], r[1][r[2] - 1]]] for r in rows)


def test_audit(spark):
    draw = random.Random(7)
    bits = ["a ", "b ", "word ", "Cap ", "X\n", "#", "é ", " "]
    docs = []
    for k in range(300):
        vocab = [f"w{draw.randrange(400)} " for _ in range(300)] if k % 3 else [draw.choice(bits) for _ in range(draw.randrange(400))]
        docs.append((k, "".join(vocab), draw.choice(["en", "en", "de", None, ""]), "s", "x"))
    docs += [(1000 + k, docs[draw.randrange(20)][1], "en", "s", "x") for k in range(80)]
    docs += [(5, None, "fr", None, None), (6, "", "fr", None, None), (None, "", "fr", None, None), (None, docs[3][1], "en", None, None)]
    docs += [docs[0], docs[0], (2000, docs[0][1], "de", None, None)]
    labels = [(k, draw.choice([0, 1, None]), draw.choice([0, 1])) for k in range(0, 400, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    table = spark.createDataFrame(docs, DOCS)
    got = audit.audit(audit.failure_counts(table, marks)).collect()
    assert sorted(list(r) for r in got) == plain_audit(docs, labels)
    assert audit.audit(audit.failure_counts(table.limit(0), marks)).collect() == []
    assert len(audit.audit(audit.failure_counts(table, marks.limit(0))).collect()) == 600 * len({d[2] or "" for d in docs})


def test_audit_query(spark):
    got = QUERIES["op13_filter_audit"](spark, FOLDER)
    files = {name: f"{FOLDER}/{name}.parquet" for name in ("documents", "labels")}
    same_as_sql(got, ORACLES["op13_filter_audit"], **files)
