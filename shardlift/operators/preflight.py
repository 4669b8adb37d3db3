"""Checks before anything is moved. Every rule is tested over all rows at once; results are violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardlift.fixed import SNAPSHOT_SUCCESS
from shardlift.functions.versions import version_of
from shardlift.unnest import unnest

Rule = tuple[str, Column, Column]


def check(rows: DataFrame, subject: Column, rules: Sequence[Rule]) -> DataFrame:
    """(repo_id, rule, subject, detail) of each rule a row breaks, in one scan."""
    found = F.filter(
        F.array(
            *[
                F.when(broken, F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail")))
                for rule, broken, detail in rules
            ]
        ),
        lambda v: v.isNotNull(),
    )
    checked = rows.select("repo_id", subject.cast("string").alias("subject"), found.alias("found"))
    return unnest(checked, "found", "at", "v").select("repo_id", "v.rule", "subject", "v.detail")


def catalog_rules() -> list[Rule]:
    return [
        ("malformed", F.col("malformed"), F.lit("record does not fit its schema")),
        ("unknown_keys", F.size("unknown") > 0, F.array_join("unknown", ",")),
        (
            "one_snapshot",
            F.size("snapshots") > 1,
            F.concat(F.size("snapshots").cast("string"), F.lit(" snapshots")),
        ),
    ]


def snapshot_rules(source: str, movement: str) -> list[Rule]:
    rules: list[Rule] = [
        ("malformed", F.col("malformed"), F.lit("record does not fit its schema")),
        ("unknown_keys", F.size("unknown") > 0, F.array_join("unknown", ",")),
        (
            "snapshot_state",
            ~F.col("state").eqNullSafe(SNAPSHOT_SUCCESS),
            F.coalesce("state", F.lit("missing")),
        ),
        (
            "snapshot_version",
            ~version_of(F.col("version_id")).eqNullSafe(source),
            F.coalesce(F.col("version_id").cast("string"), F.lit("missing")),
        ),
    ]
    if movement != "data":
        rules.append(
            (
                "global_state",
                ~F.coalesce("include_global_state", F.lit(False)),
                F.lit("snapshot has no global state"),
            )
        )
    return rules


def shard_rules() -> list[Rule]:
    return [
        ("malformed", F.col("malformed"), F.lit("record does not fit its schema")),
        ("unknown_keys", F.size("unknown") > 0, F.array_join("unknown", ",")),
        ("missing_keys", F.size("missing") > 0, F.array_join("missing", ",")),
    ]


def problem_rule(rule: str) -> list[Rule]:
    """Rows that carry a `problem` of their own."""
    return [(rule, F.col("problem").isNotNull(), F.col("problem"))]


def missing_catalogs(asked: DataFrame, catalog: DataFrame) -> DataFrame:
    """Repositories that were asked for (repo_id) and have no catalog."""
    lost = asked.select("repo_id").distinct().join(catalog.select("repo_id"), "repo_id", "left_anti")
    return lost.select(
        "repo_id",
        F.lit("catalog_missing").alias("rule"),
        F.col("repo_id").alias("subject"),
        F.lit("no index-<n> file").alias("detail"),
    )


def missing_snapshots(chosen: DataFrame, name: str) -> DataFrame:
    """Repositories (repo_id, snapshot_id) without a snapshot of that name; nothing of theirs is moved."""
    return chosen.where(F.col("snapshot_id").isNull()).select(
        "repo_id",
        F.lit("snapshot_missing").alias("rule"),
        F.lit(name).alias("subject"),
        F.lit("snapshot not found, nothing is moved").alias("detail"),
    )


def target_collisions(sources: DataFrame, keys: Sequence[str], rule: str, body: str | None = None) -> DataFrame:
    """Targets (`keys`) that more than one source would create; reported once, for the first repository.

    With `body`, sources that say the same are no collision; a missing body says something else than any other.
    """
    differ = F.lit(True)
    if body:
        some_missing = (F.count(body) > 0) & (F.count(body) < F.count("*"))
        differ = F.coalesce(F.min(body) != F.max(body), F.lit(False)) | some_missing
    return (
        sources.groupBy(*keys)
        .agg(F.min("repo_id").alias("repo_id"), F.count("*").alias("n"), differ.alias("differ"))
        .where("n > 1 and differ")
        .select(
            "repo_id",
            F.lit(rule).alias("rule"),
            F.concat_ws(" ", *keys).alias("subject"),
            F.concat(F.col("n").cast("string"), F.lit(" sources for one target")).alias("detail"),
        )
    )


def document_coverage(docs: DataFrame, plan: DataFrame, repositories: DataFrame) -> DataFrame:
    """Documents of repositories nobody knows, planned indices that have no documents, and documents without a place.

    Documents are counted by (repo_id, index) first, on the map side, so what is joined is a row for each index.
    """
    lost = F.count_if(F.col("shard").isNull() | F.col("ord").isNull())
    held = docs.groupBy("repo_id", "index").agg(F.count("*").alias("n"), lost.alias("lost"))
    unknown = held.join(repositories.select("repo_id"), "repo_id", "left_anti")
    strangers = unknown.groupBy("repo_id").agg(F.sum("n").alias("n")).select(
        "repo_id",
        F.lit("document_repository").alias("rule"),
        F.col("repo_id").alias("subject"),
        F.concat(F.col("n").cast("string"), F.lit(" documents of an unknown repository")).alias("detail"),
    )
    empty = plan.select("repo_id", "index").join(held, ["repo_id", "index"], "left_anti").select(
        "repo_id",
        F.lit("index_without_documents").alias("rule"),
        F.col("index").alias("subject"),
        F.lit("no documents").alias("detail"),
    )
    unplaced = held.where("lost > 0").select(
        "repo_id",
        F.lit("document_order").alias("rule"),
        F.col("index").alias("subject"),
        F.concat(F.col("lost").cast("string"), F.lit(" documents without shard or order")).alias("detail"),
    )
    return strangers.unionByName(empty).unionByName(unplaced)
