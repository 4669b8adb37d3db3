"""Narrow tables that are much work: dealt out over the cores, though their file is one row group."""

import pathlib

import pyarrow as pa
import pytest

from shardlift.operators.transforms import template_rows, transform_templates
from shardlift.queries import QUERIES
from shardlift.queries.configs import customer_globals
from shardlift.sinks import files as sink
from shardlift.sources.blobs import open_path

FOLDER = "/root/testdata/sf0.001"

# Queries whose rows each become a config body.
SPREAD = [
    "templates_7_10_fixed",
    "templates_7_10",
    "templates_6_8",
    "index_6_8",
    "index_7_10",
    "report_index",
    "report_templates",
    "report_templates_6_8",
    "settings_tree",
    "settings_conflicts",
    "replicas",
    "mappings",
    "global_violations",
]


@pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", SPREAD)
def test_tasks(spark, name):
    sizes = QUERIES[name](spark, FOLDER).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    cores = spark.sparkContext.defaultParallelism
    assert len(sizes) >= cores
    # Before, one task had all rows.
    assert max(sizes) <= 2 * sum(sizes) / cores


# Each level is parsed for its texts and once more for their kinds: the file, its metadata and what holds templates.
@pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="test tables are not here")
@pytest.mark.parametrize(("name", "parses"), [("report_templates_6_8", 6), ("report_templates", 12)])
def test_only_the_kinds_asked_for_are_parsed(spark, name, parses):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == parses


@pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="test tables are not here")
def test_legacy_templates_are_rewritten_without_parsing_the_others(spark):
    def parses(rows):
        done = transform_templates(rows, "6.8").select("name", "body")
        return done._jdf.queryExecution().executedPlan().toString().count("from_json(")

    bodies = customer_globals(spark, FOLDER)
    asked = parses(template_rows(bodies, ["template"]))
    assert parses(template_rows(bodies)) - asked == 8
    query = QUERIES["templates_6_8"](spark, FOLDER)
    assert query._jdf.queryExecution().executedPlan().toString().count("from_json(") == asked


@pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="test tables are not here")
def test_report_shards_parses_twice(spark):
    """The exported manifest once and the printed one once, not for each place that is read back."""
    plan = QUERIES["report_shards"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") + plan.count("get_json_object(") == 2


def test_blob_of_many_ranges_is_opened_once(tmp_path, monkeypatch):
    source = tmp_path / "blob"
    source.write_bytes(bytes(range(100)))
    asked = []

    def counted(path):
        asked.append(path)
        return open_path(path)

    monkeypatch.setattr(sink, "open_path", counted)
    keys = {"repo_id": "r", "index_name": "i", "shard": 0}
    rows = [
        {**keys, "physical_name": name, "path": str(source), "at": at, "count": 10, "offset": at}
        for name in "ab"
        for at in range(0, 100, 10)
    ]
    found = list(sink._pieces(str(tmp_path / "out"))(iter([pa.RecordBatch.from_pylist(rows)])))
    assert asked.count(str(source)) == 1
    # One batch for the two pieces.
    assert [b.num_rows for b in found] == [2]
    assert [open(r["piece"], "rb").read() for r in found[0].to_pylist()] == [bytes(range(100))] * 2
