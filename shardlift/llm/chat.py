"""Chat formatting with tool calls, in DataFrame functions only: link, order, validate, serialise.

Assistant messages hold calls as `<tool_call>{"id": ..., "name": ..., "arguments": {...}}</tool_call>`; messages of
the role `tool` hold one result, `{"call_id": ..., "content": ...}`. An argument `"$call:ID"` stands for the result
of another call of the conversation, which has to come first.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.shared import write_shared

OPEN, CLOSE = "<tool_call>", "</tool_call>"
_CALL = rf"(?s){OPEN}(.*?){CLOSE}"
_REFERENCE = r'"\$call:([^"\\]+)"'
# Kinds of values by the first letters of a variant's type.
_KINDS = {
    "string": ("STRING",),
    "integer": ("BIGINT", "INT", "SMALLINT", "TINYINT"),
    "number": ("BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "DOUBLE", "FLOAT"),
    "boolean": ("BOOLEAN",),
    "object": ("OBJECT",),
    "array": ("ARRAY",),
    "null": ("VOID",),
}
_FIELD = (
    "struct<kind:string,required:boolean,minimum:double,maximum:double,choices:array<string>,pattern:string,"
    "shortest:int,longest:int>"
)
_TOOL_KEYWORDS = {"type", "properties", "required", "additionalProperties", "title", "description"}
_FIELD_KEYWORDS = {
    "type", "minimum", "maximum", "enum", "pattern", "minLength", "maxLength", "title", "description"
}


def schema_table(spark: SparkSession, schemas: dict[str, dict]) -> DataFrame:
    """Rows (name, fields, closed) from JSON schemas of the arguments of each tool: `properties` with `type`,
    `minimum`, `maximum`, `enum`, `pattern`, `minLength` and `maxLength`, `required`, `additionalProperties`.

    A keyword that is not checked here is refused, so that no call passes for a rule nobody looked at.
    """
    rows = []
    for name, schema in sorted(schemas.items()):
        _refuse(name, set(schema) - _TOOL_KEYWORDS)
        if schema.get("type", "object") != "object" or schema.get("additionalProperties") not in (None, True, False):
            _refuse(name, {"type" if schema.get("type", "object") != "object" else "additionalProperties"})
        fields = {}
        for field in {**dict.fromkeys(schema.get("required", [])), **schema.get("properties", {})}:
            rule = schema.get("properties", {}).get(field, {})
            _refuse(f"{name}.{field}", set(rule) - _FIELD_KEYWORDS)
            if not (rule.get("type") is None or isinstance(rule["type"], str) and rule["type"] in _KINDS):
                _refuse(f"{name}.{field}", {"type"})
            fields[field] = {
                "kind": rule.get("type"),
                "required": field in schema.get("required", []),
                "minimum": rule.get("minimum"),
                "maximum": rule.get("maximum"),
                "choices": [json.dumps(x) for x in rule["enum"]] if "enum" in rule else None,
                "pattern": rule.get("pattern"),
                "shortest": rule.get("minLength"),
                "longest": rule.get("maxLength"),
            }
        rows.append((name, json.dumps(fields), schema.get("additionalProperties") is False))
    table = spark.createDataFrame(rows, "tool string, fields string, closed boolean")
    comparable = lambda text: _comparable(F.try_parse_json(text))
    return table.withColumn(
        "fields",
        F.transform_values(
            F.from_json("fields", f"map<string,{_FIELD}>"),
            lambda k, v: v.withField("choices", F.transform(v["choices"], comparable)),
        ),
    )


def _refuse(where: str, keywords: set[str]) -> None:
    if keywords:
        raise ValueError(f"schema of {where}: not supported: {', '.join(sorted(keywords))}")


def _kind_of(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _comparable(value: Column) -> Column:
    """A text that is the same for equal JSON values: `true` is not `"true"`, and 1.0 is 1."""
    number = F.try_variant_get(value, "$", "decimal(38,18)").cast("string")
    text = F.to_json(value)
    return F.when(_kind_of(value).isin(*_KINDS["number"]), F.coalesce(number, text)).otherwise(text)


def _members(text: Column) -> Column:
    """How many members the objects of a JSON text have at all depths: colons outside strings."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?s)\\.", ""), '"[^"]*"', "")
    return F.length(F.regexp_replace(bare, "[^:]", ""))


def canonical(text: Column) -> Column:
    """JSON with members in order of their names, without blanks; null if it is no JSON or repeats a member.

    Repeated members are counted here, since what the parser makes of them is a setting of the session.
    """
    parsed = F.to_json(F.try_parse_json(text))
    return F.when(_members(parsed) == _members(text), parsed)


def message_calls(messages: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, call_id, name, arguments, broken) of the calls inside assistant messages."""
    found = F.regexp_extract_all("text", F.lit(_CALL), F.lit(1))
    calls = messages.where(F.col("role") == "assistant").select("conv_id", "turn", F.explode(found).alias("call"))
    shape = "id string, name string, arguments string"
    calls = calls.withColumn("c", F.from_json("call", shape))
    # Only objects are arguments, as text in canonical form.
    arguments = canonical(F.col("c.arguments"))
    arguments = F.when(F.substring(arguments, 1, 1) == "{", arguments)
    return calls.select(
        "conv_id",
        "turn",
        F.coalesce("c.id", F.concat(F.lit("?"), F.xxhash64("call").cast("string"))).alias("call_id"),
        F.col("c.name").alias("name"),
        arguments.alias("arguments"),
        (F.col("c.id").isNull() | F.col("c.name").isNull() | arguments.isNull()).alias("broken"),
    )


def message_results(messages: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, call_id, content) of the tool messages; those without an identifier have null."""
    parsed = F.from_json("text", "call_id string, content string")
    tools = messages.where(F.col("role") == "tool").select("conv_id", "turn", parsed.alias("r"), "text")
    return tools.select(
        "conv_id", "turn", F.col("r.call_id").alias("call_id"), F.coalesce("r.content", "text").alias("content")
    )


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Adds `problems`, the sorted violations of each call's arguments."""
    joined = calls.join(schemas, F.col("name") == F.col("tool"), "left")
    joined = joined.withColumn("args", F.from_json("arguments", "map<string,variant>"))
    allowed = F.create_map(*(x for kind, of in _KINDS.items() for x in (F.lit(kind), F.array(*map(F.lit, of)))))
    reference = lambda v: F.coalesce(F.try_variant_get(v, "$", "string").startswith("$call:"), F.lit(False))

    def rule(e: Column) -> Column:
        return F.element_at("fields", e["key"])

    entries = F.map_entries("args")
    wrong = F.filter(
        entries,
        lambda e: rule(e)["kind"].isNotNull()
        & ~reference(e["value"])
        & ~F.coalesce(F.array_contains(F.element_at(allowed, rule(e)["kind"]), _kind_of(e["value"])), F.lit(True)),
    )
    number = lambda e: F.try_variant_get(e["value"], "$", "double")
    out_of_range = F.filter(
        entries,
        lambda e: ~reference(e["value"])
        & _kind_of(e["value"]).isin(*_KINDS["number"])
        & F.coalesce((number(e) < rule(e)["minimum"]) | (number(e) > rule(e)["maximum"]), F.lit(False)),
    )
    no_choice = F.filter(
        entries,
        lambda e: ~reference(e["value"])
        & F.coalesce(~F.array_contains(rule(e)["choices"], _comparable(e["value"])), F.lit(False)),
    )
    string = lambda e: F.when(_kind_of(e["value"]) == "STRING", F.try_variant_get(e["value"], "$", "string"))
    no_match = F.filter(
        entries,
        lambda e: ~reference(e["value"]) & F.coalesce(~F.regexp_like(string(e), rule(e)["pattern"]), F.lit(False)),
    )
    bad_length = F.filter(
        entries,
        lambda e: ~reference(e["value"])
        & F.coalesce(
            (F.length(string(e)) < rule(e)["shortest"]) | (F.length(string(e)) > rule(e)["longest"]), F.lit(False)
        ),
    )
    unknown = F.filter(F.map_keys("args"), lambda k: F.col("closed") & ~F.map_contains_key("fields", k))
    required = F.map_keys(F.map_filter("fields", lambda k, v: v["required"]))
    missing = F.filter(required, lambda k: ~F.map_contains_key("args", k))

    def told(what: str, of: Column) -> Column:
        return F.transform(of, lambda x: F.concat(F.lit(f"{what}: "), x))

    keys = lambda of: F.transform(of, lambda e: e["key"])
    found = F.concat(
        told("wrong type", keys(wrong)),
        told("out of range", keys(out_of_range)),
        told("not a choice", keys(no_choice)),
        told("no match", keys(no_match)),
        told("wrong length", keys(bad_length)),
        told("unknown argument", unknown),
        told("missing argument", missing),
    )
    problems = (
        F.when(F.col("broken"), F.array(F.lit("no call")))
        .when(F.col("tool").isNull(), F.array(F.lit("unknown tool")))
        .otherwise(F.array_sort(found))
    )
    return joined.withColumn("problems", problems).drop("args", "tool", "fields", "closed")


def _call_depths(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, call_id, depth) of calls that wait for others of their own turn, and (conv_id, call_id, problem).

    A call can only use results of earlier turns or of its own turn, so turns are an order already; inside a turn
    calls are peeled off in rounds, each round those that wait for none that is left. The number of rounds is the
    longest chain inside one turn. What never gets free is a circle.
    """
    keys = ["conv_id", "call_id"]
    names = calls.groupBy(*keys).agg(F.min("turn").alias("turn"))
    named = F.array_distinct(F.regexp_extract_all("arguments", F.lit(_REFERENCE), F.lit(1)))
    needs = calls.select(*keys, "turn", F.explode(named).alias("need"))
    needs = needs.alias("n").join(
        names.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("turn").alias("needed_turn")),
        (F.col("n.conv_id") == F.col("c")) & (F.col("n.need") == F.col("i")),
        "left",
    )
    needs = write_shared(needs.select("n.*", "needed_turn"), "needs")
    late = needs.where(F.col("needed_turn").isNull() | (F.col("needed_turn") > F.col("turn")))
    problems = late.select(
        *keys, F.when(F.col("needed_turn").isNull(), "needs an unknown call").otherwise("needs a later call").alias("problem")
    )
    waiting = needs.where(F.col("needed_turn") == F.col("turn")).select(*keys, "need").distinct()
    depths, depth = None, 0
    while True:
        waiting = write_shared(waiting, "waiting")
        left = waiting.count()
        if not left:
            break
        open_calls = waiting.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i")).distinct()
        stuck = waiting.join(open_calls, (F.col("conv_id") == F.col("c")) & (F.col("need") == F.col("i")), "left_semi")
        stuck = write_shared(stuck, "stuck")
        held = stuck.select(*keys).distinct()
        if stuck.count() == left:
            circle = held.withColumn("problem", F.lit("waits for itself"))
            problems = problems.unionByName(circle)
            break
        depth += 1
        free = waiting.select(*keys).distinct().join(held, keys, "left_anti").withColumn("depth", F.lit(depth))
        depths = free if depths is None else depths.unionByName(free)
        # Needs that are met no longer hold a call.
        waiting = stuck
    if depths is None:
        depths = calls.select(*keys).limit(0).withColumn("depth", F.lit(0))
    return write_shared(depths, "depths"), problems


def format_chats(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, step, kind, call_id, problems, json) in the order (conv_id, turn, step, call_id).

    Every message but tool results gives a row of kind `message` at step 0, every call one of kind `call` at step
    1 or higher, with the result linked to it, and every result without a call one of kind `orphan`. `json` is
    canonical: members by name, no blanks, absent values left out. Calls and results meet in a hash join by
    conversation and identifier; a repeated result counts by its first turn, then by its content, and is reported.
    Rows are never gathered by conversation, so a long one is no larger task. Null texts are empty, null roles
    are kept as absent, a null conversation links nothing, repeated rows are rows each, an empty table gives none,
    and other columns are not looked at.
    """
    messages = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    keys = ["conv_id", "call_id"]
    calls = write_shared(validated(message_calls(messages), schemas), "calls")
    first = F.min(F.struct("turn", "content"))
    results = message_results(messages)
    named = results.where("call_id is not null").groupBy(*keys).agg(first.alias("first"), F.count("*").alias("n_results"))
    depths, waits = _call_depths(calls)
    waits = waits.groupBy(*keys).agg(F.array_sort(F.collect_set("problem")).alias("waits"))
    copies = calls.groupBy(*keys).agg(F.count("*").alias("n_calls")).where("n_calls > 1")
    linked = calls.join(named.hint("SHUFFLE_HASH"), keys, "left")
    for found in (depths, waits, copies):
        linked = linked.join(found, keys, "left")
    none = F.array().cast("array<string>")
    linked = linked.withColumn(
        "problems",
        F.concat(
            "problems",
            F.coalesce("waits", none),
            F.when(F.col("n_calls").isNotNull(), F.array(F.lit("repeated call"))).otherwise(none),
            F.when(F.col("first").isNull(), F.array(F.lit("no result"))).otherwise(none),
            F.when(F.col("n_results") > 1, F.array(F.lit("repeated result"))).otherwise(none),
            F.when(F.col("first.turn") < F.col("turn"), F.array(F.lit("result before call"))).otherwise(none),
        ),
    )
    line = F.to_json(
        F.struct(
            F.try_parse_json("arguments").alias("arguments"),
            "call_id",
            F.lit("call").alias("kind"),
            "name",
            F.col("first.content").alias("result"),
        )
    )
    call_rows = linked.select(
        "conv_id",
        "turn",
        (F.coalesce("depth", F.lit(0)) + 1).cast("int").alias("step"),
        F.lit("call").alias("kind"),
        "call_id",
        F.array_join(F.array_sort("problems"), "; ").alias("problems"),
        line.alias("json"),
    )
    content = F.when(F.col("role") == "assistant", F.regexp_replace("text", _CALL, "")).otherwise(F.col("text"))
    shown = messages.where(~F.col("role").eqNullSafe("tool"))
    message_rows = shown.select(
        "conv_id",
        "turn",
        F.lit(0).alias("step"),
        F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("call_id"),
        F.lit("").alias("problems"),
        F.to_json(F.struct(content.alias("content"), F.lit("message").alias("kind"), "role")).alias("json"),
    )
    known = calls.select(*keys).distinct().withColumn("known", F.lit(True))
    lost = results.join(known, keys, "left").where("known is null")
    orphans = lost.select(
        "conv_id",
        "turn",
        F.lit(0).alias("step"),
        F.lit("orphan").alias("kind"),
        "call_id",
        F.lit("result without a call").alias("problems"),
        F.to_json(F.struct("call_id", F.lit("orphan").alias("kind"), F.col("content").alias("result"))).alias("json"),
    )
    return message_rows.unionByName(call_rows).unionByName(orphans)
