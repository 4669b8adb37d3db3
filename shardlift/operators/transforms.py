"""Templates and index metadata rewritten for the target.

A rule says which steps a kind of object takes from a source version; the same steps serve all
versions, and all objects of all repositories are rewritten row by row without a shuffle.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.functions.jsontext import (
    as_int,
    entries,
    has_member,
    is_object,
    let,
    member,
    object_text,
    replace_member,
)
from shardlift.functions.mappings import unwrap_mappings
from shardlift.functions.settings import (
    drop_rejected,
    hoist_leaves,
    hoist_members,
    leaf_value,
    plain_leaves,
    replica_leaves,
    replica_members,
    tree_leaves,
    tree_text,
)
from shardlift.unnest import unnest

# (source, target, kind) -> steps, in order. A kind without a rule does not exist for that source.
RULES = {
    ("6.8", "2.11", "template"): ("unwrap", "hoist", "replicas"),
    ("6.8", "2.11", "index"): ("unwrap", "tree", "hoist", "replicas"),
    ("7.10", "2.11", "template"): ("hoist",),
    ("7.10", "2.11", "index_template"): ("inner", "hoist", "replicas"),
    ("7.10", "2.11", "component_template"): (),
    ("7.10", "2.11", "index"): ("unwrap", "tree", "hoist", "replicas"),
}


INDEX_STEPS = frozenset(["unwrap", "tree", "hoist", "replicas"])


def rules_for(source: str, target: str) -> dict[str, tuple[str, ...]]:
    rules = {kind: steps for (s, t, kind), steps in RULES.items() if (s, t) == (source, target)}
    if not rules:
        raise ValueError(f"no transformation from {source} to {target}")
    return rules


def rule_rows(spark: SparkSession) -> DataFrame:
    """The rules as rows (source, target, kind, steps)."""
    rows = [(*key, list(steps)) for key, steps in RULES.items()]
    return spark.createDataFrame(rows, "source string, target string, kind string, steps array<string>")


def picked_rules(pairs: DataFrame) -> DataFrame:
    """Rows with (source, target) to a row for each kind of object, with its steps; or one with a `problem`.

    The rules are a handful of rows, so Spark broadcasts them by their own size.
    """
    found = pairs.join(rule_rows(pairs.sparkSession), ["source", "target"], "left")
    told = F.concat(F.lit("no transformation from "), F.coalesce("source", F.lit("null")), F.lit(" to "), F.coalesce("target", F.lit("null")))
    return found.withColumn("problem", F.when(F.col("kind").isNull(), told))


# Where global metadata keeps templates: under `templates`, or under its own name twice.
TEMPLATE_KINDS = ("template", "component_template", "index_template")


def template_rows(bodies: DataFrame, kinds: Collection[str] = TEMPLATE_KINDS) -> DataFrame:
    """(repo_id, kind, ord, name, body): the templates of global metadata, in document order.

    Kinds that are not asked for are not parsed.
    """

    def bucket(kind: str, items: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), entries(items).alias("items"))

    def held_in(top: Column, kind: str) -> Column:
        return member(top, "templates") if kind == "template" else member(entries(member(top, kind)), kind)

    def buckets(top: Column) -> Column:
        return F.array(*[bucket(k, held_in(top, k)) for k in TEMPLATE_KINDS if k in kinds])

    held = unnest(bodies.select("repo_id", let(entries(F.col("body")), buckets).alias("buckets")), "buckets", "at", "b")
    return unnest(held, F.col("b.items"), "ord", "item").select(
        "repo_id", F.col("b.kind").alias("kind"), "ord", F.col("item.key").alias("name"), F.col("item.value").alias("body")
    )


def with_global_problem(bodies: DataFrame) -> DataFrame:
    """Adds `problem`: global metadata, or a group of templates in it, that is there but cannot be read."""

    def unreadable(top: Column) -> Column:
        def told(what: str, value: Column) -> Column:
            return F.when(value.isNotNull() & entries(value).isNull(), F.lit(f"{what} is not an object"))

        nested = [
            F.coalesce(told(k, member(top, k)), told(f"{k}.{k}", member(entries(member(top, k)), k)))
            for k in ("component_template", "index_template")
        ]
        return F.when(top.isNull(), F.lit("no readable meta-data")).otherwise(
            F.coalesce(told("templates", member(top, "templates")), *nested)
        )

    return bodies.withColumn("problem", let(entries(F.col("body")), unreadable))


def _done(value: Column, problem: Column) -> Column:
    return F.struct(value.alias("value"), problem.alias("problem"))


def _new_mappings(items: Column) -> Column:
    """struct<items, problem> with the mappings out of their wrapper."""
    return let(
        unwrap_mappings(member(items, "mappings")),
        lambda m: F.struct(
            replace_member(items, "mappings", m["value"]).alias("items"), m["problem"].alias("problem")
        ),
    )


def _new_settings(items: Column, dimensionality: int | None) -> Column:
    """struct<items, problem> with the settings hoisted, and replicas rounded if a dimensionality is given."""

    def put(settings: Column, hoisted: Column) -> Column:
        inner = hoisted["items"]
        if dimensionality is not None:
            inner = replica_members(inner, dimensionality)
        wrong = F.when(settings.isNotNull() & ~is_object(settings), F.lit("settings is not an object"))
        return F.struct(
            replace_member(items, "settings", object_text(inner)).alias("items"),
            F.coalesce(wrong, hoisted["problem"]).alias("problem"),
        )

    return let(
        member(items, "settings"),
        lambda settings: let(hoist_members(entries(settings)), lambda h: put(settings, h)),
    )


def _rewritten(body: Column, steps: tuple[str, ...], dimensionality: int) -> Column:
    """struct<value, problem>: the steps applied to a template's mappings and settings."""

    def settings(before: Column) -> Column:
        return let(
            _new_settings(before["items"], dimensionality if "replicas" in steps else None),
            lambda after: _done(
                object_text(after["items"]), F.coalesce(before["problem"], after["problem"])
            ),
        )

    def mappings(items: Column) -> Column:
        same = F.struct(items.alias("items"), F.lit(None).cast("string").alias("problem"))
        return let(_new_mappings(items) if "unwrap" in steps else same, settings)

    none = F.lit(None).cast("string")
    return let(
        entries(body),
        lambda items: F.when(items.isNull(), _done(none, F.lit("template is not an object"))).otherwise(
            mappings(items)
        ),
    )


def _inner_rewritten(body: Column, steps: tuple[str, ...], dimensionality: int) -> Column:
    """The same for bodies that keep mappings and settings under `template`; without one they stay."""
    none = F.lit(None).cast("string")

    def put(items: Column, done: Column) -> Column:
        return _done(object_text(replace_member(items, "template", done["value"])), done["problem"])

    return let(
        entries(body),
        lambda items: F.when(items.isNull(), _done(none, F.lit("template is not an object")))
        .when(~has_member(items, "template"), _done(body, none))
        .otherwise(
            let(_rewritten(member(items, "template"), steps, dimensionality), lambda d: put(items, d))
        ),
    )


def transform_templates(
    templates: DataFrame,
    source: str,
    target: str = "2.11",
    dimensionality: int = 3,
    legacy_replica_fix: bool = False,
) -> DataFrame:
    """Templates with `body` rewritten and `problem`; kinds the source version lacks are dropped.

    From 7.10, replicas of legacy templates stay as they are: the count is looked for beside the
    templates instead of inside them, which only hits a template that is itself called `settings`.
    `legacy_replica_fix` rounds them.
    """
    rules = rules_for(source, target)
    result = F.lit(None).cast("struct<value:string,problem:string>")
    for kind, steps in rules.items():
        if kind == "index":
            continue
        if kind == "template" and source == "7.10":
            if legacy_replica_fix:
                steps = (*steps, "replicas")
            done = let(
                _rewritten(F.col("body"), steps, dimensionality),
                lambda d: F.when(
                    F.col("name") == "settings",
                    _done(object_text(replica_members(entries(d["value"]), dimensionality)), d["problem"]),
                ).otherwise(d),
            )
        elif "inner" in steps:
            done = _inner_rewritten(F.col("body"), steps, dimensionality)
        elif steps:
            done = _rewritten(F.col("body"), steps, dimensionality)
        else:
            done = _done(F.col("body"), F.lit(None).cast("string"))
        result = F.when(F.col("kind") == kind, done).otherwise(result)
    return (
        templates.where(F.col("kind").isin(*rules))
        .withColumn("done", result)
        .withColumns({"body": F.col("done.value"), "problem": F.col("done.problem")})
        .drop("done")
    )


def index_parts(indices: DataFrame, flat: bool = True) -> DataFrame:
    """Index metadata bodies with aliases, mappings and settings projected, settings as leaves.

    Dotted keys of `flat` settings become paths; otherwise members are taken as they are.
    """
    projected = let(
        entries(F.col("body")),
        lambda items: F.struct(
            member(items, "aliases").alias("aliases"),
            member(items, "mappings").alias("mappings"),
            (tree_leaves if flat else plain_leaves)(member(items, "settings")).alias("tree"),
        ),
    )
    return indices.withColumn("parts", projected).select(*indices.columns, "parts.*")


def _index_settings(leaves: Column, steps: tuple[str, ...], dimensionality: int) -> Column:
    """struct<leaves, problem>: the settings after the steps that concern them, in their order."""
    done = F.struct(leaves.alias("leaves"), F.lit(None).cast("string").alias("problem"))
    for step in steps:
        if step == "hoist":
            done = let(
                done,
                lambda d: let(
                    hoist_leaves(d["leaves"]),
                    lambda h: F.struct(h["leaves"].alias("leaves"), F.coalesce(d["problem"], h["problem"]).alias("problem")),
                ),
            )
        elif step == "replicas":
            done = let(
                done,
                lambda d: F.struct(replica_leaves(d["leaves"], dimensionality).alias("leaves"), d["problem"].alias("problem")),
            )
    return done


def shard_count(leaves: Column) -> Column:
    """`index.number_of_shards`, null when it is not there."""
    inside = member(entries(leaf_value(leaves, ["index"])), "number_of_shards")
    return let(
        F.coalesce(leaf_value(leaves, ["index", "number_of_shards"]), inside),
        lambda text: F.when(text.isNotNull(), as_int(text)),
    )


def transform_indices(
    indices: DataFrame, source: str, target: str = "2.11", dimensionality: int = 3
) -> DataFrame:
    """(keys, aliases, mappings, settings, n_shards, problem) of index metadata bodies.

    `settings` has the fields the target rejects already removed. The steps are those of the rule, in its order.
    """
    steps = rules_for(source, target)["index"]
    unknown = set(steps) - INDEX_STEPS
    if unknown:
        raise ValueError(f"no such steps for an index: {', '.join(sorted(unknown))}")
    same = F.struct(F.col("mappings").alias("value"), F.lit(None).cast("string").alias("problem"))
    keys = [c for c in indices.columns if c != "body"]
    rewritten = F.struct(
        (unwrap_mappings(F.col("mappings")) if "unwrap" in steps else same).alias("unwrapped"),
        let(
            _index_settings(F.col("tree.leaves"), steps, dimensionality),
            lambda d: F.struct(
                tree_text(drop_rejected(d["leaves"])).alias("settings"), d["problem"].alias("problem")
            ),
        ).alias("hoisted"),
        shard_count(F.col("tree.leaves")).alias("n_shards"),
    )
    done = index_parts(indices, "tree" in steps).withColumn("r", rewritten).select("*", "r.*")
    mappings, shards = F.col("unwrapped.value"), F.col("n_shards")
    settings_problem = F.coalesce(
        F.when(F.col("body").isNull(), F.lit("index metadata has no body for the index")),
        F.col("tree.problem"),
        F.when(shards.isNull(), F.lit("number of shards is missing")),
    )
    problem = F.coalesce(
        F.col("unwrapped.problem"),
        F.when(mappings.isNotNull() & ~is_object(mappings), F.lit("mappings are not an object")),
        F.when(
            F.col("aliases").isNotNull() & ~is_object(F.col("aliases")), F.lit("aliases are not an object")
        ),
        settings_problem,
        F.col("hoisted.problem"),
    )
    return done.select(
        *keys,
        F.coalesce("aliases", F.lit("null")).alias("aliases"),
        F.coalesce(mappings, F.lit("null")).alias("mappings"),
        F.col("hoisted.settings").alias("settings"),
        "n_shards",
        problem.alias("problem"),
        settings_problem.alias("settings_problem"),
    )
