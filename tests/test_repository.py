"""The data source of metadata files: what is listed, what is read, which filters reach it."""

import contextlib
import io
import json
import re

import pytest
from conftest import make_repo
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from shardlift.sources import repository
from shardlift.sources.catalog import parse_catalog, read_catalog
from shardlift.sources.metadata import read_metadata
from shardlift.sources.repository import RepositoryReader, read_repository


def names(rows):
    return sorted((r["kind"], r["index_id"] or "", -1 if r["shard"] is None else r["shard"], r["file_name"]) for r in rows)


@pytest.mark.parametrize("version", ["6.8", "7.10"])
def test_all_files(spark, tmp_path, version):
    repo = make_repo(tmp_path / "repo", version)
    rows = read_repository(spark, [str(repo), str(tmp_path / "nowhere")]).collect()
    file_id = (lambda i: "snapId0") if version == "6.8" else (lambda i: f"file-{i}")
    want = [("catalog", "", -1, "index-10"), ("global", "", -1, "meta-snapId0.json"), ("snapshot", "", -1, "snap-snapId0.json")]
    want += [("index", i, -1, f"meta-{file_id(i)}.json") for i in ("idxLogs", "idxUsers")]
    want += [("shard", i, n, "snap-snapId0.json") for i, n in (("idxLogs", 0), ("idxLogs", 1), ("idxUsers", 0))]
    assert names(rows) == sorted(want) and {r["repo_id"] for r in rows} == {str(repo)}
    manifest = next(r for r in rows if r["kind"] == "shard" and r["shard"] == 1)
    assert json.loads(manifest["value"])["number_of_files"] == 4 and manifest["snapshot_id"] == "snapId0"
    # The same rows as by Spark's listing, and the same catalog.
    for kind in ("snapshot", "global", "index", "shard"):
        by_task = read_metadata(spark, str(repo), kind)
        by_glob = read_metadata(spark, f"{tmp_path}/rep*", kind)
        assert by_task.columns == by_glob.columns
        assert sorted(map(tuple, by_task.collect())) == sorted(map(tuple, by_glob.collect()))
    newest = repository.metadata_files(spark, str(repo), "catalog")
    assert parse_catalog(newest, version).collect() == read_catalog(spark, str(repo), version).collect()


def test_filters_reach_the_source(spark, tmp_path):
    repos = [make_repo(tmp_path / name, "7.10") for name in ("one", "two")]
    table = read_repository(spark, [str(r) for r in repos])
    picked = table.where(
        (table.repo_id == str(repos[0])) & (table.kind == "shard") & table.snapshot_id.isin("snapId0", "x") & (table.shard >= 0)
    )
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        picked.explain("formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", told.getvalue())[1]
    assert all(f"({name}" in pushed for name in ("repo_id", "kind", "snapshot_id")) and "shard," not in pushed
    assert picked.count() == 3
    # Half a repository is broken; nobody who filters it away notices.
    (repos[1] / "snap-snapId0.json").unlink()
    (repos[1] / "snap-snapId0.json").symlink_to("/nonexistent")
    assert table.where(table.repo_id == str(repos[0])).where("kind = 'snapshot'").count() == 1
    assert table.where("kind = 'none'").count() == 0
    assert table.where("kind = 'catalog' AND snapshot_id = 'snapId0'").count() == 0
    assert table.where("index_id IS NULL").where(table.repo_id == str(repos[0])).count() == 3


def test_pushed_filters_choose_partitions():
    def reader(*filters):
        made = RepositoryReader({"repos": json.dumps(["/a", "/b"]), "splits": "4"})
        left = list(made.pushFilters(list(filters)))
        return left, {(p.repo_id, p.kind, p.split) for p in made.partitions()}

    left, parts = reader()
    assert not left and len(parts) == 2 * (3 + 2 * 4)
    left, parts = reader(EqualTo(("kind",), "shard"), EqualTo(("repo_id",), "/b"), GreaterThan(("shard",), 1))
    assert [type(f) for f in left] == [GreaterThan] and parts == {("/b", "shard", k) for k in range(4)}
    _, parts = reader(In(("kind",), ("shard", "global")), EqualTo(("kind",), "global"))
    assert parts == {("/a", "global", 0), ("/b", "global", 0)}
    _, parts = reader(EqualTo(("repo_id",), "/c"))
    assert parts == {("", "", 0)}


def test_named_snapshots_are_not_listed(tmp_path, monkeypatch):
    repo = make_repo(tmp_path / "repo", "7.10")
    listed = []
    names_of = repository._names
    monkeypatch.setattr(repository, "_names", lambda folder, folders=False: listed.append(folder) or names_of(folder, folders))
    made = RepositoryReader({"repos": json.dumps([str(repo)]), "splits": "1"})
    wanted = [EqualTo(("kind",), "shard"), EqualTo(("snapshot_id",), "snapId0"), EqualTo(("index_id",), "idxLogs")]
    assert list(made.pushFilters(wanted)) == []
    rows = [row for part in made.partitions() for batch in made.read(part) for row in batch.to_pylist()]
    assert [r["shard"] for r in rows] == [0, 1] and listed == [f"{repo}/indices/idxLogs"]
