import json
import os

import pytest
from conftest import catalog_json, make_documents, make_repo
from pyspark.sql import functions as F

from shardlift import MigrationError, build_plan, inspect, migrate
from shardlift.operators.documents import decoded, last_write_wins, live, repeated_keys
from shardlift.sinks.transport import FileTransport


def bodies(rows):
    return {(r["kind"], r["name"]): json.loads(r["body"]) for r in rows}


@pytest.mark.parametrize("version", ["6.8", "7.10"])
def test_everything(spark, tmp_path, version):
    repo = make_repo(tmp_path / "repo", version)
    docs = make_documents(tmp_path / "docs")
    out = str(tmp_path / "out")
    plan = migrate(
        spark,
        f"{repo}/",
        "nightly0",
        version,
        output=out,
        documents=docs,
        allow={"template": ["posts", "absent"], "component_template": ["part"]},
        target_state=spark.createDataFrame(
            [("index", "users_reindexed", 200)], "kind string, name string, status int"
        ),
        check_documents=True,
    )
    requests = spark.read.parquet(f"{out}/requests").orderBy("stage", "ord").collect()
    body = bodies(requests)
    index = body["index", "logs_reindexed"]
    assert index == {
        "aliases": {"all": {"routing": "r"}},
        "mappings": {"properties": {"author": {"type": "keyword"}}},
        "settings": {
            "number_of_shards": "2",
            "number_of_replicas": 2,
            "analysis": {"filter": {"f": {"type": "stop"}}},
        },
    }
    settings = {"priority": 1.0, "number_of_shards": "1"}
    legacy = body["template", "posts"]
    assert ("template", "other") not in body
    if version == "6.8":
        assert legacy["settings"] == {**settings, "number_of_replicas": 2}
        assert legacy["mappings"] == {"properties": {"author": {"type": "keyword"}}}
        assert {k for k, _ in body} == {"template", "index"}
    else:
        assert legacy["settings"] == {**settings, "number_of_replicas": "1"}
        assert isinstance(legacy["mappings"], list)
        inner = body["index_template", "posts"]["template"]["settings"]
        assert inner == {**settings, "number_of_replicas": 2}
        assert body["index_template", "bare"] == {"index_patterns": ["q*"], "composed_of": ["part"]}
        untouched = body["component_template", "part"]["template"]["settings"]
        assert untouched == {"index": {"number_of_shards": "1", "number_of_replicas": "1"}, "priority": 1.0}
    decisions = {r["name"]: r["decision"] for r in requests if r["kind"] == "index"}
    assert decisions == {"logs_reindexed": "create", "users_reindexed": "skip: already exists"}
    assert [r["stage"] for r in requests] == sorted(r["stage"] for r in requests)

    missing = {(r["rule"], r["subject"]) for r in plan.warnings.collect()}
    assert missing == {("template_missing", "template absent")} | (
        {("template_missing", "component_template part")} if version == "6.8" else set()
    )

    files = {}
    for r in spark.read.parquet(f"{out}/shard_files").orderBy("offset").collect():
        key = (r["index_name"], r["shard"], r["physical_name"])
        files[key] = files.get(key, b"") + bytes(r["content"])
    assert len(files) == 3 * 4
    assert files["logs", 1, "_0.cfs"] == bytes(range(256)) * 10
    assert files["users", 0, "_0.empty"] == b""
    assert files["users", 0, "segments_1"] == b"hello"

    lines = [r["value"] for r in spark.read.text(f"{out}/bulk").collect()]
    actions = [json.loads(line)["index"] for line in lines if '"_index"' in line]
    assert sorted((a["_index"], a["_id"]) for a in actions) == [
        ("logs_reindexed", "12"),
        ("logs_reindexed", "x y/z"),
        ("users_reindexed", "12"),
    ]
    sources = sorted(json.loads(line)["n"] for line in lines if '"_index"' not in line)
    assert sources == [2, 3, 4]


def test_transport_and_results(spark, tmp_path):
    repo = make_repo(tmp_path / "repo", "7.10")
    out = str(tmp_path / "out")
    migrate(
        spark,
        str(repo),
        "nightly0",
        "es_7_10",
        "os_2_11",
        output=out,
        documents=make_documents(tmp_path / "docs"),
        transport=FileTransport(str(tmp_path / "target")),
    )
    docs = spark.read.parquet(f"{out}/document_results").collect()
    assert len(docs) == 3 and {r["outcome"] for r in docs} == {"ok"}
    sent = spark.read.parquet(f"{out}/request_results")
    assert {r["kind"]: r["count"] for r in sent.groupBy("kind").count().collect()} == {
        "template": 2,
        "component_template": 1,
        "index_template": 2,
        "index": 2,
    }
    assert list((tmp_path / "target").glob("*.ndjson"))


def test_movements(spark, tmp_path):
    repo = make_repo(tmp_path / "repo", "6.8")
    docs = make_documents(tmp_path / "docs")
    data = build_plan(spark, str(repo), "nightly0", "6.8", movement="data", documents=docs)
    assert data.requests.count() == 0 and data.documents.count() == 3
    meta = build_plan(spark, str(repo), "nightly0", "6.8", movement="metadata", documents=docs)
    assert meta.requests.count() == 4 and meta.documents is None and meta.files is None


def test_again_is_the_same(spark, tmp_path):
    repo, docs, out = make_repo(tmp_path / "repo", "6.8"), make_documents(tmp_path / "docs"), str(tmp_path / "out")
    seen = []
    for _ in range(2):
        migrate(spark, str(repo), "nightly0", "6.8", movement="data", documents=docs, output=out)
        lines = sorted(r["value"] for r in spark.read.text(f"{out}/bulk").collect())
        seen.append((lines, spark.read.parquet(f"{out}/shard_files").count()))
    assert seen[0] == seen[1] and len(seen[0][0]) == 6


def test_fleet(spark, tmp_path):
    a = make_repo(tmp_path / "fleet" / "of a+b %41", "6.8")
    b = make_repo(tmp_path / "fleet" / "b", "6.8")
    stored = spark.read.parquet(make_documents(tmp_path / "docs")).withColumn("shard", F.col("shard").cast("int"))
    # Each repository under another form of its root, and one nobody knows.
    names = [f"{a}/", f"file://{b}", "/elsewhere"]
    docs = stored.withColumn("repo_id", F.explode(F.array(*map(F.lit, names))))
    docs = docs.where("not (index = 'users' and repo_id like 'file:%')")
    plan = build_plan(spark, f"{tmp_path}/fleet/*", "nightly0", "6.8", documents=docs)
    counts = {r["repo_id"]: r["count"] for r in plan.requests.groupBy("repo_id").count().collect()}
    assert counts == {str(a): 4, str(b): 4}
    found = {(r["rule"], r["subject"], r["repo_id"]) for r in plan.violations.collect()}
    assert found == {
        ("target_collision", "logs_reindexed", min(str(a), str(b))),
        ("target_collision", "users_reindexed", min(str(a), str(b))),
        ("document_repository", "/elsewhere", "/elsewhere"),
    }
    assert [(r["rule"], r["subject"], r["repo_id"]) for r in plan.warnings.collect()] == [
        ("index_without_documents", "users", str(b))
    ]
    # Of equal ids the index that is written last has the last word.
    got = {(r["target_index"], r["id"]): r["repo_id"] for r in plan.documents.collect()}
    assert plan.documents.count() == len(got) == 3
    assert got["logs_reindexed", "12"] == max(str(a), str(b)) and got["users_reindexed", "12"] == str(a)
    plan.close()
    assert not os.path.exists(plan.run.folder)


def test_relative_roots_and_roots_with_spaces(spark, tmp_path):
    make_repo(tmp_path / "of a", "6.8")
    relative = os.path.relpath(tmp_path / "of a")
    docs = spark.read.parquet(make_documents(tmp_path / "docs")).withColumn("shard", F.col("shard").cast("int"))
    for root in (f"{tmp_path}/of a", relative):
        plan = build_plan(spark, root, "nightly0", "6.8", documents=docs.withColumn("repo_id", F.lit(root)))
        assert plan.violations.count() == 0 and plan.warnings.count() == 0
        assert plan.documents.count() == 3


class Target:
    """A target that has some paths already; what is sent to it goes to a file."""

    def __init__(self, folder, there):
        self.folder, self.there = str(folder), there

    def probe(self, paths):
        return [200 if p in self.there else 404 for p in paths]

    def send(self, lines):
        return FileTransport(self.folder).send(lines)


def test_what_the_target_has_is_left_alone(spark, tmp_path):
    repo = make_repo(tmp_path / "repo", "6.8")
    target = Target(tmp_path / "sent", ["_template/posts", "/_template/posts"])
    out = str(tmp_path / "out")
    migrate(spark, str(repo), "nightly0", "6.8", movement="metadata", output=out, transport=target)
    decided = {r["name"]: r["decision"] for r in spark.read.parquet(f"{out}/request_decisions").collect()}
    assert decided == {
        "posts": "skip: already exists",
        "other": "create",
        "logs_reindexed": "create",
        "users_reindexed": "create",
    }
    sent = {r["name"] for r in spark.read.parquet(f"{out}/request_results").collect()}
    assert sent == {"other", "logs_reindexed", "users_reindexed"}


def test_global_metadata(spark, tmp_path):
    repo = make_repo(tmp_path / "repo", "6.8")
    path = repo / "meta-snapId0.json"
    path.write_text('{"meta-data":{"templates":{"x":{"order":1,"order":2},"y":{"order":3}}}}')
    plan = build_plan(spark, str(repo), "nightly0", "6.8", movement="metadata")
    assert plan.violations.count() == 0
    made = {r["name"]: json.loads(r["body"]) for r in plan.requests.where("kind = 'template'").collect()}
    assert made["x"]["order"] == 2 and made["y"]["order"] == 3
    for text in ('{"meta-data":{"templates":[]}}', '{"meta-data":', "{}"):
        path.write_text(text)
        plan = build_plan(spark, str(repo), "nightly0", "6.8", movement="metadata")
        assert [r["rule"] for r in plan.violations.collect()] == ["global_metadata"]


def test_first_pass_over_documents_reads_no_sources(spark, tmp_path):
    docs = spark.read.parquet(make_documents(tmp_path / "docs"))
    sized = docs.withColumn("source_size", F.coalesce(F.length("_source"), F.lit(0)).cast("long"))
    sized.write.parquet(str(tmp_path / "sized"))
    stored = spark.read.parquet(str(tmp_path / "sized")).withColumn("target_index", F.col("index"))
    again = repeated_keys(decoded(live(stored)), ("target_index", "id"))
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "source_size" in plan and "_source:" not in plan and "_source#" not in plan
    assert last_write_wins(decoded(live(stored))).count() == last_write_wins(
        decoded(live(docs.withColumn("target_index", F.col("index"))))
    ).count()


def test_inspect_names_missing_files(spark, tmp_path):
    repo = make_repo(tmp_path / "repo", "6.8")
    (repo / "meta-snapId0.json").unlink()
    (repo / "indices" / "idxUsers" / "0" / "snap-snapId0.json").unlink()
    tables = inspect(spark, str(repo), "nightly0", "6.8")
    assert {(r["kind"], r["subject"]) for r in tables["missing"].collect()} == {("global", "snapId0"), ("shard", "users/0")}


def test_violations_stop_the_run(spark, tmp_path):
    repo = make_repo(tmp_path / "repo", "7.10")
    (repo / "index-11").write_text(json.dumps({**catalog_json("7.10", 2), "extra": 1}))
    snap = json.loads((repo / "snap-snapId0.json").read_text())
    snap["snapshot"].update(state="PARTIAL", version_id=6082499, include_global_state=False, odd=1)
    (repo / "snap-snapId0.json").write_text(json.dumps(snap))
    (repo / "indices" / "idxLogs" / "0" / "__a.part1").unlink()
    (repo / "indices" / "idxLogs" / "0" / "__b").write_bytes(b"s")
    (repo / "indices" / "idxUsers" / "meta-file-idxUsers.json").unlink()
    out = str(tmp_path / "out")
    with pytest.raises(MigrationError):
        migrate(spark, [str(repo), str(tmp_path / "nowhere")], "nightly0", "7.10", output=out)
    found = {(r["rule"], r["detail"]) for r in spark.read.parquet(f"{out}/violations").collect()}
    assert found == {
        ("catalog_missing", "no index-<n> file"),
        ("one_snapshot", "2 snapshots"),
        ("unknown_keys", "extra"),
        ("unknown_keys", "odd"),
        ("snapshot_state", "PARTIAL"),
        ("snapshot_version", "6082499"),
        ("global_state", "snapshot has no global state"),
        ("file_missing", "index metadata"),
        ("blob_missing", "no such blob"),
        ("blob_length", "1 bytes instead of 300"),
    }


def test_unknown_snapshot_moves_nothing(spark, tmp_path):
    repo = make_repo(tmp_path / "repo", "6.8")
    plan = build_plan(spark, str(repo), "never", "6.8")
    assert [r["rule"] for r in plan.warnings.collect()] == ["snapshot_missing"]
    assert plan.requests.count() == 0 and plan.violations.count() == 0 and plan.files.count() == 0


@pytest.mark.parametrize(
    "bad",
    [
        {"source": "2.11"},
        {"source": "5.6"},
        {"target": "6.8"},
        {"movement": "all"},
        {"dimensionality": 0},
    ],
)
def test_arguments(spark, tmp_path, bad):
    with pytest.raises(ValueError):
        build_plan(spark, str(tmp_path), "s", **{"source": "6.8", **bad})


@pytest.mark.parametrize("version", ["6.8", "7.10"])
def test_inspect(spark, tmp_path, version):
    repo = make_repo(tmp_path / "repo", version)
    (repo / "index-11").write_text(json.dumps(catalog_json(version, 2)))
    tables = inspect(spark, str(repo), "nightly0", version, make_documents(tmp_path / "docs"))
    assert sorted((r["snapshot_name"], r["index_name"]) for r in tables["snapshot_indices"].collect()) == [
        ("nightly0", "logs"),
        ("nightly0", "users"),
        ("nightly1", "logs"),
    ]
    assert tables["snapshots"].count() == 2 and tables["missing"].count() == 0
    assert tables["snapshot"].first()["state"] == "SUCCESS"
    names = sorted(r["name"] for r in tables["templates"].collect())
    assert names == (["other", "posts"] if version == "6.8" else ["bare", "part", "posts"])
    logs = tables["indices"].where("index_name = 'logs'").first()
    assert logs["n_shards"] == 2 and logs["problem"] is None
    assert json.loads(logs["settings"])["index"]["number_of_replicas"] == "1"
    assert json.loads(logs["mappings"]) == {"properties": {"author": {"type": "keyword"}}}
    manifest = json.loads(tables["shards"].where("index_name = 'users'").first()["manifest"])
    assert manifest["shardId"] == 0 and manifest["files"][0]["numberOfParts"] == 3
    fields = {(r["index"], r["field"]) for r in tables["documents"].collect()}
    assert ("logs", "deleted") in fields and ("users", "_source") in fields
