"""Delivery to targets that refuse, break off and change their mind."""

import json
import os
from collections import Counter

import pytest
from conftest import make_documents, make_repo
from pyspark.sql import functions as F

from shardlift import MigrationError, migrate
from shardlift.sinks import transport as sink
from shardlift.sinks.transport import Patience, deliver, delivered, send_patiently, undelivered

QUICK = Patience(tries=3, first=0.001, longest=0.01)


class Busy:
    """Says 429 to each body so many times; notes in a folder, shared by all tasks, what it took."""

    def __init__(self, folder, busy=1, never=(), broken=()):
        self.folder, self.busy, self.never, self.broken = str(folder), busy, never, broken
        self.asked = Counter()

    def send(self, lines):
        out = []
        for head, body in lines:
            self.asked[body] += 1
            if body in self.broken:
                raise ConnectionError("gone")
            if any(n in body for n in self.never):
                out.append(400)
            elif self.asked[body] <= self.busy:
                out.append(429)
            else:
                name = f"{abs(hash((head, body)))}-{os.getpid()}-{self.asked[body]}"
                with open(f"{self.folder}/{name}", "w") as file:
                    file.write(json.dumps([head, body]))
                out.append(201)
        return out

    def probe(self, paths):
        return [404] * len(paths)


def taken(folder):
    return Counter(json.loads((folder / n).read_text())[1] for n in os.listdir(folder))


def test_refused_requests_are_sent_again(tmp_path):
    busy = Busy(tmp_path, busy=1, never=["bad"])
    lines = [("h", "a"), ("h", "bad"), ("h", "b")]
    assert send_patiently(busy, lines, QUICK) == [201, 400, 201]
    assert busy.asked == {"a": 2, "b": 2, "bad": 1}
    assert send_patiently(Busy(tmp_path, busy=9), lines[:1], QUICK) == [429]
    assert send_patiently(Busy(tmp_path, broken=["a"]), lines[:1], QUICK) == [503]
    waits = [Patience(first=1, longest=8).pause(k) for k in range(6)]
    assert all(min(8, 2**k) / 2 <= w <= min(8, 2**k) for k, w in enumerate(waits))


def test_ledger_says_what_is_left(spark, tmp_path):
    (tmp_path / "target").mkdir()
    ledger = str(tmp_path / "ledger")
    rows = spark.range(100).selectExpr("id", "'put' AS action", "concat('doc', id) AS source").repartition(4)
    assert delivered(rows, ["id"], ledger).count() == 0
    first = deliver(rows, ["id"], "action", "source", Busy(tmp_path / "target", 0, never=["doc7"]), patience=QUICK, ledger=ledger)
    assert first.where("status = 400").count() == 11
    # A task that died before its last rows were noted left a file nobody sees.
    (tmp_path / "ledger" / "_half").write_bytes(b"PAR1")
    done = delivered(rows, ["id"], ledger)
    assert done.count() == 89
    changed = rows.withColumn("source", F.expr("if(id = 3, 'new', source)"))
    left = undelivered(changed, ["id"], "action", "source", done)
    assert {r["id"] for r in left.collect()} == {3, 7, *range(70, 80)}


def test_ledger_is_written_as_tasks_go(spark, tmp_path, monkeypatch):
    """A task that fails late has noted what it delivered early."""
    notes = []
    monkeypatch.setattr(sink, "LEDGER_ROWS", 3)
    monkeypatch.setattr(sink, "_add_to_ledger", lambda folder, rows: notes.append(sum(b.num_rows for b in rows)))
    got = {}

    class Frame:
        def select(self, *columns):
            return self

        schema = None

        def mapInArrow(self, run, schema):  # noqa: N802
            got["run"] = run

    import pyarrow as pa

    monkeypatch.setattr(sink, "content_of", lambda head, body: F.lit(1))
    deliver(Frame(), ["k"], "k", "b", Busy(tmp_path, 0), patience=QUICK, ledger="x")
    batches = [pa.RecordBatch.from_pydict({"k": ["a", "b"], "b": ["1", "2"], "_content": [1, 2]}) for _ in range(3)]

    def dying():
        yield from batches
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        list(got["run"](dying()))
    assert notes == [4]


def test_migration_goes_on_where_it_stopped(spark, tmp_path):
    repo, docs = make_repo(tmp_path / "repo", "7.10"), make_documents(tmp_path / "docs")
    out, target = str(tmp_path / "out"), tmp_path / "target"
    target.mkdir()

    def go(transport, **options):
        return migrate(spark, str(repo), "nightly0", "7.10", output=out, documents=docs, transport=transport, patience=QUICK, **options)

    with pytest.raises(MigrationError, match="1 refused"):
        go(Busy(target, 1, never=['"n":4']))
    dead = spark.read.parquet(f"{out}/dead_letters").collect()
    assert [(r["target_index"], r["status"], r["source"]) for r in dead] == [("users_reindexed", 400, '{"n":4}')]
    first = taken(target)
    assert first['{"n":2}'] == 1 and '{"n":4}' not in first
    go(Busy(target, 1), resume=True)
    second = taken(target)
    assert second['{"n":2}'] == 1 and second['{"n":4}'] == 1
    results = spark.read.parquet(f"{out}/document_results").collect()
    assert len(results) == 3 and {r["outcome"] for r in results} == {"ok"}
    assert spark.read.parquet(f"{out}/dead_letters").count() == 0
    # Without `resume` everything is sent.
    go(Busy(target, 0))
    assert taken(target)['{"n":2}'] == 2


def test_a_failed_stage_stops_the_next(spark, tmp_path):
    repo = make_repo(tmp_path / "repo", "7.10")
    out, target = str(tmp_path / "out"), tmp_path / "target"
    target.mkdir()
    with pytest.raises(MigrationError, match="refused"):
        migrate(spark, str(repo), "nightly0", "7.10", output=out, transport=Busy(target, 0, never=["composed_of"]), patience=QUICK)
    sent = spark.read.parquet(f"{out}/request_results")
    assert {r["kind"] for r in sent.collect()} == {"template", "component_template", "index_template"}
    migrate(
        spark, str(repo), "nightly0", "7.10", output=out, transport=Busy(target, 0, never=["composed_of"]), patience=QUICK, strict=False
    )
    assert spark.read.parquet(f"{out}/request_results").where("kind = 'index'").count() == 2
