import json
import os
import pathlib
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import SparkSession

# Tasks that run Python find the package here; on a cluster it is shipped with --py-files.
ROOT = str(pathlib.Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, f"{ROOT}/tests", os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _json(path: pathlib.Path, value) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(value))


def catalog_json(version: str, snapshots: int = 1) -> dict:
    """A catalog with the indices `logs` (in all snapshots) and `users` (in the first)."""
    ids = [f"snapId{i}" for i in range(snapshots)]
    held = {"logs": ("idxLogs", ids), "users": ("idxUsers", ids[:1])}
    shots = []
    for i, uid in enumerate(ids):
        shot = {"name": f"nightly{i}", "uuid": uid, "state": 1}
        if version == "7.10":
            shot["index_metadata_lookup"] = {
                iid: f"key-{iid}" for iid, members in held.values() if uid in members
            }
            shot["version"] = "7.10.2"
        shots.append(shot)
    catalog = {
        "snapshots": shots,
        "indices": {n: {"id": iid, "snapshots": members} for n, (iid, members) in held.items()},
    }
    if version == "7.10":
        for entry in catalog["indices"].values():
            entry["shard_generations"] = ["g0"]
        catalog["min_version"] = "7.9.0"
        catalog["index_metadata_identifiers"] = {f"key-{iid}": f"file-{iid}" for iid, _ in held.values()}
    return catalog


TEMPLATE_SETTINGS = {"index": {"number_of_shards": "1", "number_of_replicas": "1"}, "priority": 1.0}


def make_repo(root: pathlib.Path, version: str) -> pathlib.Path:
    """A complete exported repository with two indices, multi-part, inline and empty files."""
    catalog = catalog_json(version)
    _json(root / "index-9", {"snapshots": [], "indices": {}})
    _json(root / "index-10", catalog)
    (root / "index.latest").write_text("10")
    (root / "index-old").write_text("not a catalog")
    _json(
        root / "snap-snapId0.json",
        {
            "snapshot": {
                "name": "nightly0",
                "uuid": "snapId0",
                "version_id": 6082499 if version == "6.8" else 7100299,
                "indices": ["logs", "users"],
                "state": "SUCCESS",
                "reason": None,
                "include_global_state": True,
                "start_time": 1,
                "end_time": 2,
                "total_shards": 3,
                "successful_shards": 3,
                "failures": [],
            }
        },
    )
    wrapped = [{"_doc": {"properties": {"author": {"type": "keyword"}}}}]
    meta = {
        "templates": {
            "posts": {"index_patterns": ["p*"], "settings": TEMPLATE_SETTINGS, "mappings": wrapped},
            "other": {"order": 0},
        }
    }
    if version == "7.10":
        meta["index_template"] = {
            "index_template": {
                "posts": {"index_patterns": ["p*"], "template": {"settings": TEMPLATE_SETTINGS}},
                "bare": {"index_patterns": ["q*"], "composed_of": ["part"]},
            }
        }
        meta["component_template"] = {"component_template": {"part": {"template": {"settings": TEMPLATE_SETTINGS}}}}
    _json(root / "meta-snapId0.json", {"meta-data": meta})

    for name, iid, shards in (("logs", "idxLogs", 2), ("users", "idxUsers", 1)):
        file_id = "snapId0" if version == "6.8" else f"file-{iid}"
        _json(
            root / "indices" / iid / f"meta-{file_id}.json",
            {
                name: {
                    "version": 3,
                    "settings": {
                        "index.number_of_shards": str(shards),
                        "index.number_of_replicas": "1",
                        "index.uuid": "u",
                        "index.creation_date": "1",
                        "index.provided_name": name,
                        "index.version.created": "6082499",
                        "index.analysis.filter.f.type": "stop",
                    },
                    "mappings": wrapped,
                    "aliases": {"all": {"routing": "r"}},
                }
            },
        )
        for shard in range(shards):
            folder = root / "indices" / iid / str(shard)
            folder.mkdir(parents=True)
            big = bytes(range(256)) * 10
            files = [
                {"name": "__a", "physical_name": "_0.cfs", "length": len(big), "part_size": 1000},
                {"name": "__b", "physical_name": "_0.si", "length": 300, "part_size": 1000},
                {"name": "__c", "physical_name": "_0.empty", "length": 0, "part_size": 1000},
                {
                    "name": "v__d",
                    "physical_name": "segments_1",
                    "length": 5,
                    "part_size": 1000,
                    "meta_hash": "aGVsbG8=",
                },
            ]
            for f in files:
                f.update(checksum="x", written_by="8.7.0")
            _json(
                folder / "snap-snapId0.json",
                {
                    "name": "nightly0",
                    "index_version": 4,
                    "start_time": 1,
                    "time": 2,
                    "number_of_files": len(files),
                    "total_size": sum(f["length"] for f in files),
                    "files": files,
                },
            )
            for part in range(3):
                (folder / f"__a.part{part}").write_bytes(big[part * 1000 : part * 1000 + 1000])
            (folder / "__b").write_bytes(b"s" * 300)
            (folder / "__c").write_bytes(b"")
    return root


def make_documents(path: pathlib.Path) -> str:
    """Documents with numeric, text and raw ids, a deleted one, and an id on two shards."""
    rows = [
        ("logs", 0, 0, bytes.fromhex("FE12"), b'{"n":1}'),
        ("logs", 0, 1, b"\xffx y/z", b'{"n":2}'),
        ("logs", 0, 2, bytes.fromhex("010203"), None),
        ("logs", 1, 0, bytes.fromhex("FE12"), b'{\n"n":3}'),
        ("users", 0, 0, bytes.fromhex("FE12"), b'{"n":4}'),
        ("unknown", 0, 0, bytes.fromhex("FE12"), b'{"n":5}'),
    ]
    columns = list(zip(*rows, strict=True))
    table = pa.table(
        {
            "index": pa.array(columns[0]),
            "shard": pa.array(columns[1], pa.int32()),
            "ord": pa.array(columns[2], pa.int64()),
            "_id": pa.array(columns[3], pa.binary()),
            "_source": pa.array(columns[4], pa.binary()),
        }
    )
    pq.write_to_dataset(table, str(path), partition_cols=["index", "shard"])
    return str(path)
