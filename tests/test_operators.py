import json
import random

import pytest
from conftest import catalog_json, make_documents
from pyspark.sql import functions as F

from shardlift.operators.catalog import all_snapshot_indices, index_file_ids, indices_in_snapshot, snapshot_id
from shardlift.operators.documents import last_write_wins
from shardlift.operators.files import concat_parts, file_parts, shard_rows
from shardlift.operators.preflight import catalog_rules, check, shard_rules, target_collisions
from shardlift.operators.requests import allowed, decide, missing_components, missing_names, with_components
from shardlift.operators.transforms import (
    RULES,
    picked_rules,
    rules_for,
    template_rows,
    transform_indices,
    transform_templates,
)
from shardlift.sinks.bulk import register, write_ndjson
from shardlift.sinks.transport import deliver, in_batches, with_outcome
from shardlift.sources.blobs import byte_ranges
from shardlift.sources.catalog import newest, parse_catalog
from shardlift.sources.documents import read_documents
from shardlift.sources.metadata import parse_shards


def catalogs(spark, version, snapshots=1, **extra):
    text = json.dumps({**catalog_json(version, snapshots), **extra})
    return parse_catalog(spark.createDataFrame([("r", text)], "repo_id string, value string"), version)


@pytest.mark.parametrize("version", ["6.8", "7.10"])
def test_catalog_lookups(spark, version):
    catalog = catalogs(spark, version, 2)
    held = indices_in_snapshot(catalog, "nightly1", version).collect()
    file_id = "snapId1" if version == "6.8" else "file-idxLogs"
    assert [(r["index_name"], r["index_id"], r["file_id"]) for r in held] == [("logs", "idxLogs", file_id)]
    assert indices_in_snapshot(catalog, "never", version).count() == 0
    assert catalog.select(snapshot_id("never")).first()[0] is None
    wanted = spark.createDataFrame(
        [("r", "nightly1", "users"), ("r", "nightly0", "users"), ("r", "nightly0", "none")],
        "repo_id string, snapshot_name string, index_name string",
    )
    got = {(r["snapshot_name"], r["index_name"]): r["file_id"] for r in index_file_ids(wanted, catalog, version).collect()}
    if version == "7.10":
        assert got == {("nightly1", "users"): None, ("nightly0", "users"): "file-idxUsers", ("nightly0", "none"): None}
    else:
        assert got["nightly0", "users"] == "snapId0"


def test_catalog_violations(spark):
    good, odd = catalogs(spark, "6.8"), catalogs(spark, "6.8", 2, surprise=1)
    assert check(good, F.lit("c"), catalog_rules()).count() == 0
    assert {r["rule"] for r in check(odd, F.lit("c"), catalog_rules()).collect()} == {"unknown_keys", "one_snapshot"}
    for text in ("not json", '{"snapshots":5}'):
        bad = parse_catalog(spark.createDataFrame([("r", text)], "repo_id string, value string"), "6.8")
        assert "malformed" in {r["rule"] for r in check(bad, F.lit("c"), catalog_rules()).collect()}
    manifest = '{"name":"n","files":[{"name":"a","length":1}],"more":1}'
    shard = parse_shards(spark.createDataFrame([("r", manifest)], "repo_id string, value string"))
    found = {r["rule"]: r["detail"] for r in check(shard, F.lit("s"), shard_rules()).collect()}
    assert found == {"unknown_keys": "more", "missing_keys": "physical_name,checksum,part_size,written_by"}


def test_newest(spark):
    names = ["index-9", "index-10", "index-", "index-11.tmp", "index.latest", "incompatible-snapshots"]
    files = spark.createDataFrame([("r", n, n) for n in names], "repo_id string, file_name string, value string")
    assert newest(files).first()["file_name"] == "index-10"


@pytest.mark.parametrize("shared", [False, True])
def test_last_write_wins_against_brute_force(spark, shared):
    rng = random.Random(7)
    # A third of all rows share one key.
    rows = [
        ("i", "hot" if n % 3 == 0 else f"k{rng.randrange(400)}", rng.randrange(4), n, f"body{n}") for n in range(3000)
    ]
    best = {}
    for row in rows:
        if row[:2] not in best or row[2:4] > best[row[:2]][2:4]:
            best[row[:2]] = row
    docs = spark.createDataFrame(rows, "target_index string, id string, shard int, ord long, source string")
    once = last_write_wins(docs, shared=shared)
    assert sorted(tuple(r) for r in once.select(docs.columns).collect()) == sorted(best.values())
    twice = last_write_wins(once.select(docs.columns), shared=shared)
    assert twice.count() == len(best)


def test_shared_keys_are_broadcast(spark):
    docs = spark.range(1000).selectExpr(
        "'i' AS target_index", "cast(id % 900 AS string) AS id", "0 AS shard", "id AS ord", "'x' AS source"
    )
    plan = last_write_wins(docs, shared=True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("chunk", [1, 25, 10**9])
def test_split_and_reassemble(spark, chunk):
    rng = random.Random(3)
    whole = {f"f{n}": rng.randbytes(rng.choice([1, 9, 10, 11, 95, 400])) for n in range(40)}
    files = spark.createDataFrame(
        [(f"__{k}", k, len(v), 10, v) for k, v in whole.items()],
        "name string, physical_name string, length long, part_size long, whole binary",
    )
    cut = F.substring("whole", F.col("part_offset").cast("int") + 1, F.col("part_length").cast("int"))
    parts = file_parts(files).select("physical_name", "part", "part_size", cut.alias("content"))
    got = {}
    for r in concat_parts(parts.repartition(7), [], chunk).orderBy("physical_name", "offset").collect():
        assert len(got.get(r["physical_name"], b"")) == r["offset"]
        got[r["physical_name"]] = got.get(r["physical_name"], b"") + bytes(r["content"])
        assert len(r["content"]) <= max(chunk, 10)
    assert got == whole


def test_byte_ranges(spark):
    df = spark.createDataFrame([(100, 0), (100, 1), (100, 10), (100, 25)], "start long, length long")
    got = [r[0] for r in df.select(byte_ranges(F.col("start"), F.col("length"), 10)).collect()]
    assert got[0] is None
    assert [[tuple(x) for x in g] for g in got[1:]] == [
        [(0, 1, 100)], [(0, 10, 100)], [(0, 10, 100), (10, 10, 110), (20, 5, 120)],
    ]


def test_target_collisions(spark):
    rows = [("a", "same", "x"), ("b", "same", "x"), ("a", "other", "x"), ("b", "other", "y"), ("a", "lost", None), ("b", "lost", "x"),
            ("a", "none", None), ("b", "none", None), ("a", "once", "x")]
    table = spark.createDataFrame(rows, "repo_id string, name string, body string")
    assert {r["subject"] for r in target_collisions(table, ["name"], "c", "body").collect()} == {"other", "lost"}
    assert {r["subject"] for r in target_collisions(table, ["name"], "c").collect()} == {"same", "other", "lost", "none"}


def test_shard_rows(spark):
    df = spark.createDataFrame([("a", 0), ("b", 2), ("c", None)], "i string, n_shards int")
    assert [(r["i"], r["shard"]) for r in shard_rows(df).collect()] == [("b", 0), ("b", 1)]


def test_allow_lists(spark):
    rows = [("r", k, i, n) for k in ("template", "index_template") for i, n in enumerate("abc")]
    df = spark.createDataFrame(rows, "repo_id string, kind string, ord int, name string")

    def kept(allow):
        return [(r["kind"], r["name"]) for r in allowed(df, allow).orderBy("kind", "ord").collect()]

    assert len(kept({})) == 6 and len(kept({"template": None})) == 6
    assert kept({"template": [], "index_template": ["c", "a", "c"]}) == [("index_template", "c"), ("index_template", "a")]
    missing = missing_names(df, df, {"template": ["a", "x"], "index_template": []}).collect()
    assert [(r["kind"], r["name"]) for r in missing] == [("template", "x")]


def test_components_of_templates(spark):
    rows = [
        ("r", "index_template", "a", '{"composed_of":["c1","c2","c2"]}'),
        ("r", "index_template", "b", '{"composed_of":[]}'),
        ("r", "index_template", "c", "{}"),
        ("r", "index_template", "d", None),
        ("q", "index_template", "a", '{"composed_of":["c3"]}'),
        ("r", "component_template", "c1", "{}"),
        ("r", "component_template", "c3", "{}"),
        ("r", "template", "c2", "{}"),
    ]
    table = spark.createDataFrame(rows, "repo_id string, kind string, name string, body string").withColumn("ord", F.lit(0))
    kept = table.where("kind <> 'component_template'")
    closed = with_components(kept, table)
    assert [(r["repo_id"], r["name"]) for r in closed.where("kind = 'component_template'").collect()] == [("r", "c1")]
    assert with_components(closed, table).count() == closed.count()
    lacking = {(r["repo_id"], r["name"], r["component"]) for r in missing_components(closed).collect()}
    assert lacking == {("r", "a", "c2"), ("q", "a", "c3")}


def test_decisions(spark):
    df = spark.createDataFrame([(404,), (None,), (200,), (500,)], "s int")
    assert [r[0] for r in df.select(decide(F.col("s"))).collect()] == [
        "create", "create", "skip: already exists", "skip: could not confirm",
    ]


def test_rules():
    assert "index_template" not in rules_for("6.8", "2.11")
    with pytest.raises(ValueError):
        rules_for("2.11", "6.8")


def test_rules_as_rows(spark):
    pairs = spark.createDataFrame([("6.8", "2.11"), ("5.6", "2.11"), (None, "2.11")], "source string, target string")
    got = {(r["source"], r["kind"]): (r["steps"], r["problem"]) for r in picked_rules(pairs).collect()}
    assert got == {
        ("6.8", "template"): (["unwrap", "hoist", "replicas"], None),
        ("6.8", "index"): (["unwrap", "tree", "hoist", "replicas"], None),
        ("5.6", None): (None, "no transformation from 5.6 to 2.11"),
        (None, None): (None, "no transformation from null to 2.11"),
    }


def test_index_steps_follow_the_rule(spark, monkeypatch):
    body = json.dumps({"settings": {"index": {"number_of_shards": "1", "a.b": 1}, "number_of_replicas": "1"}, "mappings": [{}]})
    rows = spark.createDataFrame([("r", body)], "repo_id string, body string")

    def run(*steps):
        monkeypatch.setitem(RULES, ("6.8", "2.11", "index"), steps)
        return transform_indices(rows, "6.8").first()

    assert json.loads(run("tree")["settings"]) == {"index": {"number_of_shards": "1", "a.b": 1}, "number_of_replicas": "1"}
    assert json.loads(run("tree", "replicas")["settings"])["number_of_replicas"] == 2
    hoisted = run("hoist", "replicas")
    assert json.loads(hoisted["settings"]) == {"number_of_shards": "1", "a.b": 1, "number_of_replicas": 2}
    assert hoisted["mappings"] == "[{}]" and hoisted["problem"] == "mappings are not an object"
    with pytest.raises(ValueError, match="inner"):
        run("inner")


def test_template_rules(spark):
    settings = {"index": {"number_of_replicas": "1"}}
    body = json.dumps(
        {
            "templates": {"a": {"settings": settings}, "settings": {"number_of_replicas": 0}, "bad": 5,
                          "worse": {"settings": {"index": 1}}},
            "index_template": {"index_template": {"b": {"template": {"settings": settings}}, "c": {}, "d": {"template": None}}},
        }
    )
    rows = template_rows(spark.createDataFrame([("r", body)], "repo_id string, body string"))

    def run(version, **options):
        done = transform_templates(rows, version, **options).collect()
        return {r["name"]: (json.loads(r["body"]) if r["problem"] is None else r["problem"]) for r in done}

    old, new = run("6.8"), run("7.10")
    assert set(old) == {"a", "settings", "bad", "worse"}
    assert old["a"] == {"settings": {"number_of_replicas": 2}} and old["settings"] == {"number_of_replicas": 0}
    assert new["a"] == {"settings": {"number_of_replicas": "1"}} and new["settings"] == {"number_of_replicas": 2}
    assert run("7.10", legacy_replica_fix=True)["a"] == {"settings": {"number_of_replicas": 2}}
    assert new["b"] == {"template": {"settings": {"number_of_replicas": 2}}} and new["c"] == {}
    assert new["d"] == new["bad"] == "template is not an object"
    assert new["worse"] == "settings.index is not an object"


def test_index_problems(spark):
    good = '"settings":{"index.number_of_shards":"2"}'
    bodies = {
        "ok": "{" + good + "}",
        "list": '{"mappings":[5],' + good + "}",
        "aliases": '{"aliases":[],' + good + "}",
        "shards": '{"settings":{}}',
        "none": "{}",
        "tree": '{"settings":{"index":{"number_of_shards":3}}}',
    }
    df = spark.createDataFrame(list(bodies.items()), "index_name string, body string")
    got = {r["index_name"]: (r["n_shards"], r["problem"]) for r in transform_indices(df, "7.10").collect()}
    assert got == {
        "ok": (2, None),
        "list": (2, "mappings are not an object"),
        "aliases": (2, "aliases are not an object"),
        "shards": (None, "number of shards is missing"),
        "none": (None, "settings are missing or not an object"),
        "tree": (3, None),
    }


def test_documents_are_pruned(spark, tmp_path):
    path = make_documents(tmp_path / "docs")
    docs = read_documents(spark, path, "logs", 1)
    assert docs.count() == 1
    assert "PartitionFilters: [isnotnull(index" in docs._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="_source"):
        spark.range(1).selectExpr("'i' AS index", "0 AS shard", "id AS ord", "'x' AS _id").write.parquet(str(tmp_path / "x"))
        read_documents(spark, str(tmp_path / "x"))


class Moody:
    """Answers by body, and remembers nothing: it runs in tasks."""

    def __init__(self, folder=""):
        self.folder = folder

    def send(self, lines):
        return [500 if body == "bad" else 201 for _, body in lines]


def test_deliver_gives_a_result_per_row(spark):
    rows = spark.range(50).selectExpr("id", "cast(id AS string) AS action", "if(id % 10 = 0, 'bad', 'good') AS source")
    got = with_outcome(deliver(rows, ["id"], "action", "source", Moody(), max_rows=7)).collect()
    assert len(got) == 50 and {r["id"] for r in got if r["outcome"] == "error"} == {0, 10, 20, 30, 40}
    assert {r["level"] for r in got if r["outcome"] == "error"} == {"error"}
    quiet = with_outcome(deliver(rows, ["id"], "action", "source", Moody()), quiet=True)
    assert {r["level"] for r in quiet.collect()} == {"debug"}


def test_batches():
    rows = [("a", "x" * n) for n in (1, 2, 30, 3, 4)]
    cut = [[len(b) for _, b in batch] for batch in in_batches(iter(rows), 2, 10)]
    assert cut == [[1, 2], [30], [3, 4]]


def test_bulk_source(spark, tmp_path):
    register(spark)
    rows = spark.range(20).selectExpr("concat('a', id) AS action", "concat('s', id) AS source")
    target = str(tmp_path / "bulk")
    (
        rows.write.format("shardlift_bulk").mode("append").option("batchRows", "3").option("target", target)
        .option("transport", "shardlift.sinks.transport:FileTransport").save()
    )
    lines = "".join(p.read_text() for p in (tmp_path / "bulk").glob("*.ndjson")).split()
    assert len(lines) == 40 and set(lines) == {f"{c}{n}" for c in "as" for n in range(20)}


def test_ndjson_by_index(spark, tmp_path):
    rows = spark.createDataFrame([("i", "a1", "s1"), ("j", "a2", "s2")], "target_index string, action string, source string")
    write_ndjson(rows, str(tmp_path / "out"), by_index=True)
    assert "a1\ns1" in "".join(p.read_text() for p in (tmp_path / "out" / "target_index=i").glob("*.txt"))


def test_lookups_of_7_10_with_shared_names_ids_and_keys(spark):
    """Two snapshots of one name, two indices of one id, one metadata file for two indices, a key without a file."""
    shots = [
        {"name": "n", "uuid": "s1", "index_metadata_lookup": {"b": "k1", "a": "k1", "gone": "k1", "c": "lost"}},
        {"name": "n", "uuid": "s2", "index_metadata_lookup": {"d": "k1"}},
        {"name": "m", "uuid": "s3"},
    ]
    entries = {"A": {"id": "a"}, "A2": {"id": "a"}, "B": {"id": "b"}, "C": {"id": "c"}, "D": {"id": "d"}}
    text = json.dumps({"snapshots": shots, "indices": entries, "index_metadata_identifiers": {"k1": "f1", "k2": "f2"}})
    catalog = parse_catalog(spark.createDataFrame([("r", text)], "repo_id string, value string"), "7.10")
    held = indices_in_snapshot(catalog, "n", "7.10").collect()
    assert sorted((r["pos"], r["index_name"], r["index_id"], r["file_id"]) for r in held) == [
        (0, "B", "b", "f1"), (1, "A", "a", "f1"), (1, "A2", "a", "f1"), (3, "C", "c", None),
    ]
    listed = all_snapshot_indices(catalog, "7.10").collect()
    assert sorted(tuple(r) for r in listed) == [("r", "n", "s1", n, i) for n, i in zip(["A", "A2", "B", "C"], "aabc")]
    wanted = spark.createDataFrame(
        [("r", "n", "B"), ("r", "n", "D"), ("r", "m", "A")], "repo_id string, snapshot_name string, index_name string"
    )
    got = {r["index_name"]: (r["index_id"], r["file_id"]) for r in index_file_ids(wanted, catalog, "7.10").collect()}
    assert got == {"B": ("b", "f1"), "D": ("d", None), "A": ("a", None)}
    for rows in (indices_in_snapshot(catalog, "n", "7.10"), all_snapshot_indices(catalog, "7.10")):
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
