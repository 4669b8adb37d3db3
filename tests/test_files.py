"""Work packing, listings, container audits by ranges and committed shard files."""

import os
import random
import zlib

import pytest
from conftest import make_repo
from pyspark.sql import functions as F

from shardlift import MigrationError, inspect, migrate
from shardlift.functions.checksums import moved_on
from shardlift.operators.files import reconciled
from shardlift.operators.packing import packed
from shardlift.sinks import files as sink
from shardlift.sources.blobs import listed_files
from shardlift.sources.containers import audited, container_problem


def test_checksums_of_pieces():
    draw = random.Random(1)
    for _ in range(200):
        whole = draw.randbytes(draw.randrange(0, 500))
        cuts = sorted({0, len(whole), *(draw.randrange(len(whole) + 1) for _ in range(5))})
        share = 0
        for a, b in zip(cuts, cuts[1:], strict=False):
            share ^= moved_on(zlib.crc32(whole[a:b]), len(whole) - b)
        assert share == zlib.crc32(whole)
    assert moved_on(zlib.crc32(b"x"), 10**13) == moved_on(moved_on(zlib.crc32(b"x"), 10**13 - 7), 7)


def test_packed_tasks_are_equal(spark):
    """One file with a third of all work, and a long tail: the largest task is within a row of the mean."""
    rows = [("big", k, 100) for k in range(1000)] + [(f"f{k}", 0, 1 + k % 130) for k in range(3000)]
    table = spark.createDataFrame(rows, "name string, at long, size long")
    spread = ["name", F.call_function("div", F.col("at"), F.lit(20))]
    cut = packed(table, F.col("size"), ["name", "at"], 6000, spread)
    held = cut.select("*", F.spark_partition_id().alias("task")).collect()
    assert sorted((r["name"], r["at"], r["size"]) for r in held) == sorted(rows)
    work = {}
    for r in held:
        work[r["task"]] = work.get(r["task"], 0) + r["size"]
    total = sum(r[2] for r in rows)
    tasks = -(-total // 6000)
    assert len(work) == tasks and max(work.values()) <= total / tasks + 130
    assert packed(table, F.lit(0), ["name", "at"], 5).count() == len(rows)
    assert packed(table, F.col("size"), ["name", "at"], 1, most_tasks=7).rdd.getNumPartitions() == 7
    assert packed(table.limit(0), F.col("size"), ["name", "at"], 5).count() == 0
    lost = table.select("name", "at", F.lit(None).cast("long").alias("size"))
    assert packed(lost, F.col("size"), ["name", "at"], 5).count() == len(rows)


def container(size=0, name=b"snapshot", magic="3FD76C17", version=1, foot="C02893E8", algorithm=0, shift=0):
    body = bytes.fromhex(magic) + bytes([len(name)]) + name + version.to_bytes(4, "big") + bytes(k % 251 for k in range(size))
    body += bytes.fromhex(foot) + algorithm.to_bytes(4, "big")
    return body + (zlib.crc32(body) + shift).to_bytes(8, "big")


CASES = {
    "good": container(5000),
    "bare": container(),
    "name": container(70, name=b"metadata"),
    "magic": container(100, magic="3FD76C18"),
    "version": container(100, version=2),
    "foot": container(100, foot="C02893E9"),
    "algorithm": container(100, algorithm=1),
    "shift": container(3333, shift=1),
    "short": b"short",
    "flipped": container(900)[:500] + b"?" + container(900)[501:],
    "sixteen": bytes(16),
}


@pytest.mark.parametrize("range_bytes", [29, 64, 1 << 20])
def test_audit_by_ranges_is_the_audit_of_the_whole(spark, tmp_path, range_bytes):
    for name, content in CASES.items():
        (tmp_path / name).write_bytes(content)
    rows = [(f"{tmp_path}/{name}", len(content), "snapshot", content) for name, content in CASES.items()]
    files = spark.createDataFrame(rows, "path string, length long, format string, content binary")
    want = {r[0]: r[1] for r in files.select("path", container_problem(F.col("content"), F.col("format"))).collect()}
    got = audited(files.drop("content"), range_bytes, task_bytes=1 << 20).collect()
    assert len(got) == len(CASES) and {r["path"]: r["problem"] for r in got} == want


def test_reconciliation(spark, tmp_path):
    (tmp_path / "0").mkdir()
    for name, size in (("__a", 3), ("__b.part0", 4), ("__left", 1), ("snap-x.json", 9)):
        (tmp_path / "0" / name).write_bytes(b"x" * size)
    (tmp_path / "0" / "__folder").mkdir()
    folders = spark.createDataFrame([("r", f"{tmp_path}/0"), ("r", f"{tmp_path}/none")], "repo_id string, folder string")
    parts = spark.createDataFrame(
        [("r", f"{tmp_path}/0", "__a", 3), ("r", f"{tmp_path}/0", "__b.part0", 5), ("r", f"{tmp_path}/none", "__a", 3)],
        "repo_id string, folder string, blob_name string, part_length long",
    )
    got = {(r["folder"][-1], r["name"]): r["state"] for r in reconciled(parts, listed_files(folders)).collect()}
    assert got == {("0", "__a"): "fits", ("0", "__b.part0"): "wrong size", ("0", "__left"): "orphan", ("e", "__a"): "missing"}


def test_broken_containers_stop_a_run(spark, tmp_path):
    repo = make_repo(tmp_path / "repo", "7.10")
    (repo / "snap-snapId0.dat").write_bytes(container(200))
    (repo / "meta-snapId0.dat").write_bytes(container(200, name=b"metadata", shift=1))
    (repo / "indices" / "idxLogs" / "meta-file-idxLogs.dat").write_bytes(container(5, name=b"index-metadata"))
    (repo / "indices" / "idxLogs" / "1" / "snap-snapId0.dat").write_bytes(container(5, name=b"metadata"))
    (repo / "indices" / "idxLogs" / "1" / "__stray").write_bytes(b"x")
    tables = inspect(spark, str(repo), "nightly0", "7.10")
    want = {("global", "checksum"), ("shard", "format name")}
    assert {(r["kind"], r["problem"]) for r in tables["broken"].collect()} == want
    out = str(tmp_path / "out")
    with pytest.raises(MigrationError):
        migrate(spark, str(repo), "nightly0", "7.10", output=out)
    found = spark.read.parquet(f"{out}/violations").collect()
    assert {(r["rule"], r["detail"]) for r in found} == {("container", "checksum"), ("container", "format name")}
    orphans = [r["subject"] for r in spark.read.parquet(f"{out}/warnings").where("rule = 'blob_orphan'").collect()]
    assert len(orphans) == 1 and orphans[0].endswith("/1/__stray")


def test_shard_files_as_files(spark, tmp_path):
    repo = make_repo(tmp_path / "repo", "6.8")
    out = tmp_path / "out"
    migrate(spark, str(repo), "nightly0", "6.8", output=str(out), shard_files="files")
    root = out / "shard_files"
    assert (root / "logs" / "1" / "_0.cfs").read_bytes() == bytes(range(256)) * 10
    assert (root / "users" / "0" / "_0.empty").read_bytes() == b""
    assert (root / "users" / "0" / "segments_1").read_bytes() == b"hello"
    listed = spark.read.parquet(sink.file_manifest(str(root))).collect()
    assert len(listed) == 12 and all(os.path.getsize(r["path"]) == r["length"] for r in listed)
    assert not [n for n in os.listdir(root) if n.startswith("_attempts")]


def records(spark, repo, sizes):
    rows = []
    folder = repo / "indices" / "i" / "0"
    folder.mkdir(parents=True)
    for name, size in sizes.items():
        (folder / f"__{name}").write_bytes(random.Random(name).randbytes(size))
        rows.append((str(repo), "logs", "i", 0, f"__{name}", name, size, 1 << 40, None))
    return spark.createDataFrame(rows, records_schema())


def test_files_of_many_pieces(spark, tmp_path):
    sizes = {"a": 10_000, "b": 1, "c": 999, "..": 7, "x/y": 5, "d": 0}
    repo = tmp_path / "repo"
    (repo / "indices" / "i" / "0").mkdir(parents=True)
    rows = []
    for k, (name, size) in enumerate(sizes.items()):
        (repo / "indices" / "i" / "0" / f"__{k}").write_bytes(random.Random(name).randbytes(size))
        rows.append((str(repo), "logs", "i", 0, f"__{k}", name, size, 1 << 40, None))
    files = spark.createDataFrame(rows, records_schema())
    manifest = sink.write_shard_files(files, str(tmp_path / "out"), task_bytes=600 * 1024, range_bytes=100).collect()
    assert {r["physical_name"]: r["length"] for r in manifest} == sizes
    for r in manifest:
        assert r["path"].startswith(f"{tmp_path}/out/logs/0/") and "/../" not in r["path"]
        with open(r["path"], "rb") as file:
            assert file.read() == random.Random(r["physical_name"]).randbytes(sizes[r["physical_name"]])
    # Again, over what is there.
    again = sink.write_shard_files(files, str(tmp_path / "out"), task_bytes=1 << 20, range_bytes=5000)
    assert again.count() == len(sizes)


def records_schema():
    return (
        "repo_id string, index_name string, index_id string, shard int, name string, physical_name string, length long,"
        " part_size long, meta_hash binary"
    )


def test_killed_attempts_leave_nothing_visible(spark, tmp_path):
    """Pieces are copied by an attempt that dies, then by one that lives; then a commit is repeated."""
    repo, out = tmp_path / "repo", tmp_path / "out"
    files = records(spark, repo, {"a": 5000, "b": 300})
    ranges = sink.packed_ranges(files, 1 << 30, 100).toArrow().to_batches()
    dying = sink._pieces(f"{out}/_attempts")(iter(ranges))
    next(dying)
    dying.close()
    assert os.listdir(out) == ["_attempts"]
    pieces = [row for batch in sink._pieces(f"{out}/_attempts")(iter(ranges)) for row in batch.to_pylist()]
    assert {(p["physical_name"], p["offset"], p["length"]) for p in pieces} == {("a", 0, 5000), ("b", 0, 300)}
    assert os.listdir(out) == ["_attempts"]
    (repo / "indices" / "i" / "0" / "__a").unlink()
    with pytest.raises(Exception, match="__a|No such file"):
        sink.write_shard_files(files, str(out))
    assert not os.path.exists(sink.file_manifest(str(out))) and not (out / "logs").exists()


def test_a_repeated_commit_changes_nothing(tmp_path):
    import pyarrow as pa

    (tmp_path / "p1").write_bytes(b"one")
    (tmp_path / "p2").write_bytes(b"two")

    def rows():
        piece = lambda n, at: {"offset": at, "length": 3, "piece": f"{tmp_path}/{n}"}
        table = [
            {"path": f"{tmp_path}/f/x", "length": 3, "pieces": [piece("p1", 0)], "content": None},
            {"path": f"{tmp_path}/f/y", "length": 6, "pieces": [piece("p2", 0), piece("p2", 3)], "content": None},
            {"path": f"{tmp_path}/f/z", "length": 2, "pieces": None, "content": b"hi"},
        ]
        return iter(pa.Table.from_pylist(table).to_batches())

    for _ in range(2):
        for batch in sink._commit(f"{tmp_path}/again")(rows()):
            assert batch.num_rows == 3 and batch.schema.names == ["path", "length"]
        assert [(tmp_path / "f" / n).read_bytes() for n in "xyz"] == [b"one", b"twotwo", b"hi"]
