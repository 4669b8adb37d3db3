"""The create requests: which entities, under which path, in which order, and whether to send them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardlift.fixed import HTTP_NOT_FOUND, HTTP_OK, STAGES
from shardlift.functions.paths import request_path

AllowLists = Mapping[str, Sequence[str] | None]

TEMPLATE_KINDS = ("template", "component_template", "index_template")


def stage_of(kind: Column) -> Column:
    stages = F.create_map(*[F.lit(x) for pair in STAGES.items() for x in pair])
    return F.element_at(stages, kind)


def in_movement(rows: DataFrame, movement: str) -> DataFrame:
    """Rows whose `kind` the movement covers: metadata is templates and indices, data is documents."""
    if movement == "metadata":
        return rows.where(F.col("kind") != "document")
    if movement == "data":
        return rows.where(F.col("kind") == "document")
    return rows


def allow_table(spark: SparkSession, allow: AllowLists) -> DataFrame:
    """(kind, name, place) of the kinds that have a list; a name given twice keeps its first place."""
    rows = [
        (kind, name, place)
        for kind, names in allow.items()
        if names is not None
        for name, place in {n: p for p, n in reversed(list(enumerate(names)))}.items()
    ]
    return spark.createDataFrame(rows, "kind string, name string, place int")


def allowed(entities: DataFrame, allow: AllowLists) -> DataFrame:
    """Entities their kind's list names, in list order; no list keeps all, an empty one none."""
    listed = [kind for kind, names in allow.items() if names is not None]
    if not listed:
        return entities
    table = allow_table(entities.sparkSession, allow)
    return (
        entities.join(table, ["kind", "name"], "left")
        .where(~F.col("kind").isin(*listed) | F.col("place").isNotNull())
        .withColumn("ord", F.coalesce("place", "ord"))
        .drop("place")
    )


def missing_names(entities: DataFrame, repos: DataFrame, allow: AllowLists) -> DataFrame:
    """(repo_id, kind, name) that a list asks for and a repository lacks."""
    wanted = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"))
            for kind, names in allow.items()
            for name in dict.fromkeys(names or [])
        ]
    ).cast("array<struct<kind:string,name:string>>")
    asked = repos.select("repo_id").distinct().select("repo_id", F.explode(wanted).alias("w"))
    return asked.select("repo_id", "w.*").join(entities, ["repo_id", "kind", "name"], "left_anti")


def component_links(templates: DataFrame) -> DataFrame:
    """(repo_id, name, component): the component templates that index templates are composed of, once each."""
    named = templates.where(F.col("kind") == "index_template")
    parts = F.from_json(F.get_json_object("body", "$.composed_of"), "array<string>")
    return named.select("repo_id", "name", F.explode(parts).alias("component")).distinct()


def with_components(kept: DataFrame, templates: DataFrame) -> DataFrame:
    """The kept templates and all component templates that kept index templates need, whatever the lists say."""
    needed = component_links(kept).select("repo_id", F.col("component").alias("name")).distinct()
    components = templates.where(F.col("kind") == "component_template").join(needed, ["repo_id", "name"], "left_semi")
    have = kept.where(F.col("kind") == "component_template").select("repo_id", "name")
    return kept.unionByName(components.join(have, ["repo_id", "name"], "left_anti").select(*kept.columns))


def missing_components(kept: DataFrame) -> DataFrame:
    """(repo_id, name, component): kept index templates whose component template is not among those to be created."""
    have = kept.where(F.col("kind") == "component_template").select("repo_id", F.col("name").alias("component"))
    return component_links(kept).join(have, ["repo_id", "component"], "left_anti")


def union_requests(*tables: DataFrame) -> DataFrame:
    head, *rest = tables
    for table in rest:
        head = head.unionByName(table)
    return head


def template_requests(templates: DataFrame) -> DataFrame:
    return templates.select(
        "repo_id",
        "kind",
        "ord",
        "name",
        request_path(F.col("kind"), F.col("name")).alias("path"),
        "body",
        "problem",
    )


def index_body(aliases: Column, mappings: Column, settings: Column) -> Column:
    return F.concat(
        F.lit('{"aliases":'), aliases, F.lit(',"mappings":'), mappings, F.lit(',"settings":'), settings, F.lit("}")
    )


def index_requests(indices: DataFrame) -> DataFrame:
    """Create requests of transformed indices (repo_id, pos, target_index, aliases, mappings, settings)."""
    return indices.select(
        "repo_id",
        F.lit("index").alias("kind"),
        F.col("pos").alias("ord"),
        F.col("target_index").alias("name"),
        request_path(F.lit("index"), F.col("target_index")).alias("path"),
        index_body(F.col("aliases"), F.col("mappings"), F.col("settings")).alias("body"),
        "problem",
    )


def decide(status: Column) -> Column:
    """Create what the target does not have; leave what it has or may have. No answer counts as absent."""
    code = F.coalesce(status, F.lit(HTTP_NOT_FOUND))
    return (
        F.when(code == HTTP_NOT_FOUND, F.lit("create"))
        .when(code == HTTP_OK, F.lit("skip: already exists"))
        .otherwise(F.lit("skip: could not confirm"))
    )


def with_decisions(requests: DataFrame, target_state: DataFrame) -> DataFrame:
    """Requests with `stage` and `decision`, from the state (kind, name, status) of the target."""
    return (
        requests.join(target_state.select("kind", "name", "status"), ["kind", "name"], "left")
        .withColumns({"stage": stage_of(F.col("kind")), "decision": decide(F.col("status"))})
        .drop("status")
    )
