"""Every registered query against its SQL, over whole tables of the smallest test data."""

import importlib.util
import pathlib

import duckdb
import pytest
from conftest import ROOT

from shardlift.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

spec = importlib.util.spec_from_file_location("entry", f"{ROOT}/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([v[i] for i in order]) for v in values)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER)
    want = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
