import json
import random
import time
import zlib

import pytest
from pyspark.sql import functions as F

from shardlift.functions.ids import decode_id, id_problem
from shardlift.functions.inrow import BLOCK, blocks_of, found_in
from shardlift.functions.jsontext import as_int, entries, let, object_text
from shardlift.functions.mappings import unwrap_mappings
from shardlift.functions.paths import (
    document_path,
    generation,
    part_count,
    part_name,
    request_path,
    trim_root,
)
from shardlift.functions.settings import (
    drop_rejected,
    flat_to_tree,
    hoist_leaves,
    hoist_members,
    replica_leaves,
    replica_members,
    round_replicas,
    tree_leaves,
    tree_text,
)
from shardlift.functions.versions import version_of
from shardlift.sources.containers import container_problem, read_containers


def apply(spark, values, kind, make):
    """Results of an expression over a list of inputs, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r["y"] for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_ids(spark):
    cases = [
        (bytes.fromhex("FE1234"), "1234"),
        (bytes.fromhex("FE123F"), "123"),
        (bytes.fromhex("FE"), ""),
        (bytes.fromhex("FE1AF0"), "1:?0"),
        (b"\xffh\xc3\xa9/x", "h\xe9/x"),
        (b"\xff", ""),
        (bytes.fromhex("FDFE010203"), "_gECAw"),
        (bytes.fromhex("FD"), ""),
        (b"a" * 100, "YWFh" * 33 + "YQ"),
        (None, None),
    ]
    assert apply(spark, [c[0] for c in cases], "binary", decode_id) == [c[1] for c in cases]
    with pytest.raises(Exception, match="cannot be empty"):
        apply(spark, [b""], "binary", decode_id)
    assert apply(spark, [b"\xffa\xffb"], "binary", decode_id) == ["a\ufffdb"]
    problems = apply(spark, [None, b"", b"\xff\xff", b"\xffok", b"\xfe\x12"], "binary", id_problem)
    assert problems == ["id is missing", "id is empty", "id is not valid UTF-8", None, None]


def test_entries_keep_order_and_types(spark):
    text = '{"b":"1","a":1.0,"c":{"z":1,"y":[1,2.50,"q"]},"d":null,"e\\"":true,"b2":"{"}'
    assert apply(spark, [text], "string", lambda x: object_text(entries(x))) == [
        '{"b":"1","a":1.0,"c":{"z":1,"y":[1,2.5,"q"]},"d":null,"e\\"":true,"b2":"{"}'
    ]
    assert apply(spark, ["[1]", "5", "nope", None], "string", entries) == [None] * 4


def test_entries_tell_strings_from_what_they_look_like(spark):
    values = ['"{}"', "{}", '"[1]"', "[1]", '"{\\"a\\":true}"', '{"a":true}', '"1"', "1", '"true"', "true", '"null"', "null",
              '[{"a":"x"},"y",null]', '{"":{"struct":[]}}', '""', '"\\u0001\\t"', '"\u00e9/"', "-1.5", '[["[]"]]']
    text = "{" + ",".join(f'"k{i}":{v}' for i, v in enumerate(values)) + "}"
    assert [e["value"] for e in apply(spark, [text], "string", entries)[0]] == values


@pytest.mark.parametrize(
    ("flat", "tree", "hoisted"),
    [
        ('{"index.a.b":"1","index.a.c":[1,2.0],"z":null}', {"index": {"a": {"b": "1", "c": [1, 2.0]}}, "z": None},
         {"a": {"b": "1", "c": [1, 2.0]}, "z": None}),
        ('{"a.":1}', {"a": 1}, {"a": 1}),
        ('{".a":1,"b..c":2}', {"": {"a": 1}, "b": {"": {"c": 2}}}, {"": {"a": 1}, "b": {"": {"c": 2}}}),
        ('{"a.b":2,"a":1}', {"a": 1}, {"a": 1}),
        ('{"a":{"x":1,"y":{"z":2}},"a.y.w":3}', {"a": {"x": 1, "y": {"z": 2, "w": 3}}},
         {"a": {"x": 1, "y": {"z": 2, "w": 3}}}),
        ('{"a":{},"a.b":1}', {"a": {"b": 1}}, {"a": {"b": 1}}),
        ('{"a.b":1,"a":{"c":1},"a.d":2}', {"a": {"c": 1, "d": 2}}, {"a": {"c": 1, "d": 2}}),
        ('{"z":1,"index.z.q":2,"index.index.k":3,"":5}', {"": 5, "index": {"index": {"k": 3}, "z": {"q": 2}}, "z": 1},
         {"": 5, "z": {"q": 2}}),
        ('{"index":{"b":1},"index.c":2}', {"index": {"b": 1, "c": 2}}, {"b": 1, "c": 2}),
        ('{"index":{},"k":{"dotted.key":1}}', {"index": {}, "k": {"dotted.key": 1}}, {"k": {"dotted.key": 1}}),
        ("{}", {}, {}),
    ],
)
def test_flat_to_tree(spark, flat, tree, hoisted):
    got = apply(spark, [flat], "string", flat_to_tree)[0]
    assert got["problem"] is None and json.loads(got["value"]) == tree
    up = apply(spark, [flat], "string", lambda x: tree_text(hoist_leaves(tree_leaves(x)["leaves"])["leaves"]))
    assert json.loads(up[0]) == hoisted


def simulated(flat):
    """The tree by writing key after key; none if a key has to pass through a value."""
    tree = {}
    for key, value in flat.items():
        *above, last = key.rstrip(".").split(".")
        node = tree
        for step in above:
            if not isinstance(node.get(step, {}), dict):
                return None
            node = node.setdefault(step, {})
        node[last] = json.loads(json.dumps(value))
    return tree


def test_flat_to_tree_by_simulation(spark):
    draw = random.Random(3)

    def value(depth=0):
        if depth < 2 and draw.random() < 0.4:
            return {draw.choice("abc"): value(depth + 1) for _ in range(draw.randrange(3))}
        return draw.choice([1, "x", [1]])

    cases = []
    for _ in range(800):
        keys = [".".join(draw.choice("abc") for _ in range(draw.randrange(1, 4))) for _ in range(draw.randrange(1, 8))]
        cases.append({key + draw.choice(["", "", "", "."]): value() for key in keys})
    got = apply(spark, [json.dumps(c) for c in cases], "string", flat_to_tree)
    trees = [None if g["problem"] else json.loads(g["value"]) for g in got]
    assert trees == [simulated(c) for c in cases] and None in trees


def test_many_overlapping_keys(spark):
    flat = {"a": {"x": 1}} | {f"a.k{i}": i for i in range(2500)}
    flat |= {f"b.k{i}": {"u": 1} for i in range(1250)} | {f"b.k{i}.v": 2 for i in range(1250)}
    begin = time.monotonic()
    got = apply(spark, [json.dumps(flat)], "string", flat_to_tree)[0]
    assert got["problem"] is None and json.loads(got["value"]) == simulated(flat)
    assert time.monotonic() - begin < 60


def test_flat_to_tree_problems(spark):
    bad = ['{"a":1,"a.b":2}', '{"a":1,"a.b":2,"a":3}', '{"a":{"x":5},"a.x.w":3}', '{"...":1}', "[]", None]
    through, none = "settings key passes through a value", "settings are missing or not an object"
    got = apply(spark, bad, "string", flat_to_tree)
    assert [g["problem"] for g in got] == [through, through, through, "settings key has no name", none, none]
    lifted = apply(spark, ['{"index":5}'], "string", lambda x: hoist_leaves(tree_leaves(x)["leaves"]))
    assert lifted[0]["problem"] == "settings.index is not an object"


def test_rejected_and_replicas_on_trees(spark):
    flat = '{"uuid":"u","version.created":"1","creation_date":"1","provided_name":"n","number_of_replicas":"3","k":1}'
    done = apply(
        spark, [flat, '{"number_of_replicas.x":1}', "{}"], "string",
        lambda x: tree_text(replica_leaves(drop_rejected(tree_leaves(x)["leaves"]), 3)),
    )
    assert [json.loads(d) for d in done] == [{"k": 1, "number_of_replicas": 5}, {"number_of_replicas": 2}, {}]


def test_hoist_members(spark):
    text = '{"k":2,"index":{"number_of_replicas":"1","k":1,"index":3},"x":5}'
    done = apply(
        spark, [text, '{"k":1}'], "string", lambda x: object_text(replica_members(hoist_members(entries(x))["items"], 3))
    )
    assert done == ['{"x":5,"number_of_replicas":2,"k":1}', '{"k":1}']


def test_replicas(spark):
    cases = {
        "0": 2, "1": 2, "2": 2, "3": 5, "5": 5, '"1"': 2, '"auto"': 2, "-1": -1, "-5": -5, "1.7": 2, "true": 2,
        '"true"': 2, "null": 2, '""': 2, '" 4 "': 5, '"1e1"': 11, "99999999999": 2, '{"a":1}': 2, '"+4"': 5,
    }
    assert apply(spark, list(cases), "string", lambda x: round_replicas(x, 3)) == list(cases.values())


def test_replica_property(spark):
    counts = list(range(0, 60))
    for dim in (1, 2, 3, 7):
        got = apply(spark, [str(c) for c in counts], "string", lambda x, d=dim: round_replicas(x, d))
        assert all(n >= r and n - r < dim and (n + 1) % dim == 0 for r, n in zip(counts, got, strict=True))


def test_as_int(spark):
    assert apply(spark, ['"12"', "7", '"NaN"', '"x"'], "string", as_int) == [12, 7, 0, 0]


def test_mappings(spark):
    unknown, empty = "mappings have none of the expected wrappers", "mappings array is empty"
    cases = [
        ('[{"_doc":{"p":1}}]', '{"p":1}', None),
        ('[{"audit_message":{"x":1},"doc":{"y":1}},{"_doc":{}}]', '{"y":1}', None),
        ('[{"audit_message":{}}]', "{}", None),
        ('[{"other":{}}]', '[{"other":{}}]', unknown),
        ("[]", "[]", empty),
        ('{"_doc":1}', '{"_doc":1}', None),
        ("[5]", "[5]", None),
        ('[{"_doc":5}]', '[{"_doc":5}]', None),
        ("null", "null", None),
        (None, None, None),
    ]
    got = apply(spark, [c[0] for c in cases], "string", unwrap_mappings)
    assert [(g["value"], g["problem"]) for g in got] == [c[1:] for c in cases]


def test_parts_and_paths(spark):
    rows = [(0, 10, 1), (10, 10, 1), (11, 10, 2), (2**62, 2**63 - 1, 1), (5, 0, None)]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "l long, p long")
    assert [r[0] for r in df.select(part_count(F.col("l"), F.col("p"))).collect()] == [r[2] for r in rows]
    one = spark.range(1).select(
        part_name(F.lit("f"), F.lit(1), F.lit(0)),
        part_name(F.lit("f"), F.lit(2), F.lit(1)),
        trim_root(F.lit("s3a://b/p//")),
        request_path(F.lit("component_template"), F.lit("n")),
        document_path(F.lit("i"), F.lit("a b/ü")),
    ).first()
    assert list(one) == ["f", "f.part1", "s3a://b/p/", "_component_template/n", "i/_doc/a%20b%2F%C3%BC"]
    names = ["index-12", "index-", "index-1x", "index.latest", "xindex-1"]
    assert apply(spark, names, "string", generation) == [12, None, None, None, None]
    assert apply(spark, [6082499, 7100299, 2110000], "int", version_of) == ["6.8", "7.10", None]


def container(name=b"snapshot", magic="3FD76C17", version=1, foot="C02893E8", algorithm=0, shift=0):
    body = bytes.fromhex(magic) + bytes([len(name)]) + name + version.to_bytes(4, "big") + b"payload"
    body += bytes.fromhex(foot) + algorithm.to_bytes(4, "big")
    return body + (zlib.crc32(body) + shift).to_bytes(8, "big")


def test_containers(spark):
    cases = [
        (container(), None),
        (container(name=b"metadata"), "format name"),
        (container(magic="3FD76C18"), "header magic"),
        (container(version=2), "format version"),
        (container(foot="C02893E9"), "footer magic"),
        (container(algorithm=1), "checksum algorithm"),
        (container(shift=1), "checksum"),
        (b"short", "too short for a footer"),
    ]
    got = apply(spark, [c[0] for c in cases], "binary", lambda x: container_problem(x, F.lit("snapshot")))
    assert got == [c[1] for c in cases]


def test_container_files(spark, tmp_path):
    (tmp_path / "meta-a.dat").write_bytes(container())
    (tmp_path / "meta-b.dat").write_bytes(container(shift=1))
    found = read_containers(spark, f"{tmp_path}/meta-*.dat").select(
        "path", container_problem(F.col("content"), F.lit("snapshot")).alias("problem")
    )
    assert {r["path"][-5]: r["problem"] for r in found.collect()} == {"a": None, "b": "checksum"}


def test_lookups_inside_a_row(spark):
    """Against a dictionary: keys on both sides of block edges, unknown, repeated and missing ones."""
    many = {f"k{i:04d}": f"v{i}" for i in range(3 * BLOCK + 1)}
    texts = {
        "many": json.dumps(many),
        "one": '{"k0000":"x"}',
        "none": "{}",
        "repeated": "{" + ",".join(f'"k0007":"v{i}"' for i in range(2 * BLOCK)) + "}",
    }
    asked = [*many, "", "k", "k9999"]
    rows = [(name, text, asked) for name, text in texts.items()] + [("missing", None, asked)]
    held = spark.createDataFrame(rows, "name string, text string, asked array<string>")
    blocks = blocks_of(F.from_json("text", "map<string,string>"))
    got = held.select("name", let(blocks, lambda b: F.transform("asked", lambda k: found_in(b, k))).alias("found"))
    for row in got.collect():
        want = json.loads(texts.get(row["name"], "{}"))
        assert [f and f["value"] for f in row["found"]] == [want.get(k) for k in asked]
        if row["name"] == "many":
            assert [f["pos"] for f in row["found"][: len(many)]] == list(range(len(many)))
