"""Move a snapshot: catalog to requests, shard files and documents.

A plan is a set of lazy tables; `migrate` checks it, writes it and sends it. Every table carries
`repo_id`, so one job serves one repository or a fleet (several roots, or a pattern).
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardlift.fixed import STAGES, TARGET_SUFFIX
from shardlift.functions.ids import raised_if_undecodable
from shardlift.functions.versions import parse_movement, parse_source, parse_target
from shardlift.operators import documents as docs_ops
from shardlift.operators import preflight, requests
from shardlift.operators.catalog import indices_in_snapshot, snapshot_id
from shardlift.operators.files import file_parts, file_rules, reconciled, shard_rows
from shardlift.operators.transforms import (
    rules_for,
    template_rows,
    transform_indices,
    transform_templates,
    with_global_problem,
)
from shardlift.schemas import TARGET_STATE, VIOLATION
from shardlift.shared import SharedRun, delete_folder, shared_name, write_shared
from shardlift.sinks.bulk import write_ndjson
from shardlift.sinks.files import write_shard_files, write_shard_rows
from shardlift.sinks.transport import Patience, Transport, deliver, delivered, probed, undelivered, with_outcome
from shardlift.sources.blobs import listed_files, with_blob_paths
from shardlift.sources.catalog import read_catalog
from shardlift.sources.containers import container_files, container_problems
from shardlift.sources.documents import read_documents
from shardlift.sources.metadata import (
    explode_files,
    global_bodies,
    index_bodies,
    index_metadata_of,
    parse_shards,
    parse_snapshots,
    read_metadata,
    shard_manifests_of,
)
from shardlift.sources.roots import asked_names, is_pattern, repo_name, roots_of


class MigrationError(RuntimeError):
    """A plan breaks rules; the message counts them and the table of violations has every one."""


@dataclass
class Plan:
    violations: DataFrame
    warnings: DataFrame
    indices: DataFrame
    requests: DataFrame
    files: DataFrame | None
    documents: DataFrame | None
    run: SharedRun | None = None

    def close(self) -> None:
        """Deletes the intermediate tables; the tables of the plan cannot be computed any more."""
        if self.run is not None:
            self.run.close()


def _in_a_run(build):
    """Intermediate tables of a plan lie in a folder of their own."""

    @functools.wraps(build)
    def run_and_build(spark: SparkSession, *args, **options) -> Plan:
        with SharedRun(spark) as run:
            plan = build(spark, *args, **options)
        plan.run = run
        return plan

    return run_and_build


def _flag(rows: DataFrame, rule: str, subject: str, detail: str) -> DataFrame:
    return rows.select(
        "repo_id",
        F.lit(rule).alias("rule"),
        F.col(subject).cast("string").alias("subject"),
        F.lit(detail).alias("detail"),
    )


def _asked(spark: SparkSession, repos: str | Sequence[str]) -> DataFrame:
    """Names of the repositories that were asked for by their roots."""
    names = [(name,) for root, name in asked_names(spark, repos).items() if not is_pattern(root)]
    return spark.createDataFrame(names, "repo_id string").select(repo_name(F.col("repo_id")).alias("repo_id"))


def _document_repositories(spark: SparkSession, repos: str | Sequence[str], docs: DataFrame) -> DataFrame:
    """Documents with the repository named as everywhere else, whichever form of its root they carry."""
    asked = {root: name for root, name in asked_names(spark, repos).items() if root != name}
    root = F.regexp_replace("repo_id", "(?<=[^/])/+$", "")
    if asked:
        known = F.create_map(*(F.lit(x) for pair in asked.items() for x in pair))
        root = F.coalesce(F.element_at(known, root), root)
    return docs.withColumn("repo_id", repo_name(root))


def _present(texts: DataFrame) -> DataFrame:
    return texts.withColumn("present", F.col("value").isNotNull())


@_in_a_run
def build_plan(
    spark: SparkSession,
    repos: str | Sequence[str],
    snapshot: str,
    source: str,
    target: str = "2.11",
    movement: str = "everything",
    *,
    documents: str | DataFrame | None = None,
    allow: requests.AllowLists | None = None,
    target_state: DataFrame | None = None,
    dimensionality: int = 3,
    suffix: str = TARGET_SUFFIX,
    legacy_replica_fix: bool = False,
    close_components: bool = False,
    check_documents: bool = False,
) -> Plan:
    """Tables of a migration, and everything that speaks against it.

    `documents` is a document table (or its path): index, shard, ord, _id, _source, and repo_id when
    there are several repositories. `target_state` says what the target answers for (kind, name).
    With `close_components` the component templates that kept index templates are composed of are created too, whatever
    the lists say, and one that is nowhere is a violation; without it, one that is not created is a warning.
    `check_documents` reports undecodable ids beforehand at the price of a scan; otherwise the first one
    stops the run.
    """
    source, target = parse_source(source), parse_target(target)
    movement = parse_movement(movement)
    if dimensionality < 1:
        raise ValueError("dimensionality must be positive")
    rules_for(source, target)
    with_metadata, with_data = movement != "data", movement != "metadata"
    allow = allow or {}

    catalog = write_shared(read_catalog(spark, repos, source), "catalog")
    chosen = catalog.select("repo_id", snapshot_id(snapshot).alias("snapshot_id"))
    broken = [
        preflight.missing_catalogs(_asked(spark, repos), catalog),
        preflight.check(catalog, F.lit("catalog"), preflight.catalog_rules()),
    ]
    warnings = [preflight.missing_snapshots(chosen, snapshot)]
    chosen = chosen.where(F.col("snapshot_id").isNotNull())

    described = chosen.join(read_metadata(spark, repos, "snapshot"), ["repo_id", "snapshot_id"], "left")
    broken.append(
        _flag(described.where(F.col("value").isNull()), "file_missing", "snapshot_id", "snapshot metadata")
    )
    broken.append(
        preflight.check(
            parse_snapshots(described.where(F.col("value").isNotNull()), source),
            F.col("snapshot_id"),
            preflight.snapshot_rules(source, movement),
        )
    )

    held = write_shared(indices_in_snapshot(catalog, snapshot, source), "held")
    containers = [container_files("snapshot", chosen), container_files("index", held)]
    texts = index_metadata_of(held)
    # Used by checks, requests, shards and documents alike: read and rewritten once.
    listed = write_shared(
        transform_indices(index_bodies(_present(texts)), source, target, dimensionality).withColumn(
            "target_index", docs_ops.target_name(F.col("index_name"), suffix)
        ),
        "indices",
    )
    broken.append(_flag(listed.where(~F.col("present")), "file_missing", "index_name", "index metadata"))
    indices = listed.where("present").drop("present")
    index_problem = F.col("problem") if with_metadata else F.col("settings_problem")
    broken.append(
        preflight.check(
            indices, F.col("index_name"), [("index_metadata", index_problem.isNotNull(), index_problem)]
        )
    )

    broken.append(preflight.target_collisions(indices, ["target_index"], "target_collision"))

    wanted = [requests.index_requests(indices)]
    if with_metadata:
        containers.append(container_files("global", chosen))
        globals_ = read_metadata(spark, repos, "global").join(chosen, ["repo_id", "snapshot_id"], "left_semi")
        broken.append(
            _flag(chosen.join(globals_, "repo_id", "left_anti"), "file_missing", "snapshot_id", "global metadata")
        )
        bodies = with_global_problem(global_bodies(globals_))
        broken.append(
            preflight.check(bodies, F.col("snapshot_id"), preflight.problem_rule("global_metadata"))
        )
        templates = write_shared(
            transform_templates(
                template_rows(bodies, rules_for(source, target)), source, target, dimensionality, legacy_replica_fix
            ),
            "templates",
        )
        kept = requests.allowed(templates, allow)
        if close_components:
            kept = requests.with_components(kept, templates)
        lacking = requests.missing_components(kept).select(
            "repo_id",
            F.lit("component_missing").alias("rule"),
            F.col("name").alias("subject"),
            F.concat(F.lit("composed of "), F.col("component")).alias("detail"),
        )
        (broken if close_components else warnings).append(lacking)
        warnings.append(
            requests.missing_names(templates, chosen, allow).select(
                "repo_id",
                F.lit("template_missing").alias("rule"),
                F.concat_ws(" ", "kind", "name").alias("subject"),
                F.lit("listed template not found").alias("detail"),
            )
        )
        broken.append(preflight.check(templates, F.col("name"), preflight.problem_rule("template")))
        broken.append(preflight.target_collisions(kept, ["kind", "name"], "template_collision", "body"))
        wanted.insert(0, requests.template_requests(kept))
    state = target_state if target_state is not None else spark.createDataFrame([], TARGET_STATE)
    planned = requests.in_movement(
        requests.with_decisions(requests.union_requests(*wanted), state), movement
    ).drop("problem")

    files = moved = None
    if with_data:
        shards = shard_rows(indices.where(F.col("n_shards").isNotNull()))
        containers.append(container_files("shard", shards))
        manifests = shard_manifests_of(shards.select("repo_id", "snapshot_id", "index_name", "index_id", "shard"))
        where = F.concat_ws("/", "index_name", "shard")
        parsed = write_shared(parse_shards(_present(manifests)), "manifests").withColumn("at", where)
        broken.append(_flag(parsed.where(~F.col("present")), "file_missing", "at", "shard metadata"))
        parsed = parsed.where("present")
        broken.append(preflight.check(parsed, F.col("at"), preflight.shard_rules()))
        files = write_shared(
            explode_files(parsed, ["repo_id", "index_name", "index_id", "shard", "total_size"]), "files"
        )
        broken.append(preflight.check(files, F.col("physical_name"), file_rules()))
        parts = with_blob_paths(file_parts(files)).select("repo_id", "folder", "blob_name", "part_length")
        folders = with_blob_paths(shards.withColumn("blob_name", F.lit(""))).select("repo_id", "folder").distinct()
        blobs = write_shared(reconciled(parts, listed_files(folders)).where("state <> 'fits'"), "blobs")
        at = F.concat_ws("/", "folder", "name")
        differs = F.concat(
            F.col("blob_length").cast("string"),
            F.lit(" bytes instead of "),
            F.col("part_length").cast("string"),
        )
        broken.append(
            preflight.check(
                blobs,
                at,
                [
                    ("blob_missing", F.col("state") == "missing", F.lit("no such blob")),
                    ("blob_length", F.col("state") == "wrong size", differs),
                ],
            )
        )
        warnings.append(
            preflight.check(blobs, at, [("blob_orphan", F.col("state") == "orphan", F.lit("in no manifest"))])
        )
        if documents is not None:
            stored = read_documents(spark, documents) if isinstance(documents, str) else documents
            keys = ["repo_id", "index"]
            if "repo_id" not in stored.columns:
                roots = roots_of(repos)
                if len(roots) > 1 or is_pattern(roots[0]):
                    raise ValueError("documents of several repositories need a repo_id column")
                keys = ["index"]
            else:
                stored = _document_repositories(spark, repos, stored)
            alive = docs_ops.live(stored)
            # Indices of one target, which only a run that is not strict has, are written in this order.
            order = Window.partitionBy("target_index").orderBy("repo_id", "pos")
            plan = indices.select(
                "repo_id",
                F.col("index_name").alias("index"),
                "target_index",
                F.row_number().over(order).alias("place"),
            )
            placed = stored
            if "repo_id" not in stored.columns:
                (name,) = asked_names(spark, repos).values()
                placed = stored.withColumn("repo_id", repo_name(F.lit(name)))
            coverage = write_shared(
                preflight.document_coverage(placed, plan, catalog.select("repo_id")), "coverage"
            )
            broken.append(coverage.where(F.col("rule") != "index_without_documents"))
            warnings.append(coverage.where(F.col("rule") == "index_without_documents"))
            routed = docs_ops.route(alive, plan, keys)
            if check_documents:
                # Bytes that are no text are replaced; ids that are not there stop the run.
                checked = docs_ops.with_id_problem(routed)
                replaced = F.col("problem") == "id is not valid UTF-8"
                where = F.concat_ws("/", "index", "shard", "ord")
                rule = preflight.problem_rule("document_id")
                broken.append(preflight.check(checked.where(~replaced), where, rule))
                warnings.append(preflight.check(checked.where(replaced), where, rule))
            safe = raised_if_undecodable(F.col("_id"))
            last = docs_ops.last_write_wins(
                docs_ops.decoded(routed.withColumn("_id", safe)), ("target_index", "id"), shared=True
            ).drop("place")
            moved = docs_ops.bulk_rows(last)

    damaged = write_shared(container_problems(requests.union_requests(*containers)), "containers")
    broken.append(preflight.check(damaged, F.col("path"), preflight.problem_rule("container")))

    empty = spark.createDataFrame([], VIOLATION)
    return Plan(
        violations=requests.union_requests(empty, *broken),
        warnings=requests.union_requests(empty, *warnings),
        indices=indices,
        requests=planned,
        files=files,
        documents=moved,
    )


def migrate(
    spark: SparkSession,
    repos: str | Sequence[str],
    snapshot: str,
    source: str,
    target: str = "2.11",
    movement: str = "everything",
    *,
    output: str,
    transport: Transport | None = None,
    strict: bool = True,
    shard_files: str = "rows",
    resume: bool = False,
    patience: Patience = Patience(),
    **options,
) -> Plan:
    """Build, check and carry out a plan; tables of what was done go below `output`.

    `violations` and `warnings` are written first, and with `strict` any violation stops the run there.
    Then `requests`, `shard_files` and `bulk`. Shard files are rows of bytes, or with `shard_files="files"` files of
    their own, of which `_manifest` lists those that count. With a transport, requests whose decision is to create are
    sent stage by stage and documents in batches, with a status per row in `request_results` and
    `document_results`; without one the documents are written as NDJSON.

    A target that is busy is asked again with growing `patience`. What it refuses for good stands in `dead_letters`
    (documents) or `request_results`, and with `strict` stops the run: after a stage of requests before the next one,
    after the documents at the end. Tasks note delivered documents in `ledger`; with `resume` a run goes on from
    there and sends what is not noted or has changed, without it the ledger begins anew.
    """
    if shard_files not in ("rows", "files"):
        raise ValueError("shard_files must be rows or files")
    plan = build_plan(spark, repos, snapshot, source, target, movement, **options)
    plan.violations.write.mode("overwrite").parquet(f"{output}/violations")
    plan.warnings.write.mode("overwrite").parquet(f"{output}/warnings")
    if strict:
        # One row per rule, and there is a fixed number of rules.
        counts = spark.read.parquet(f"{output}/violations").groupBy("rule").count().collect()
        if counts:
            told = ", ".join(f"{r['rule']}: {r['count']}" for r in sorted(counts))
            raise MigrationError(f"{told} (see {output}/violations)")

    plan.requests.write.mode("overwrite").parquet(f"{output}/requests")
    if plan.files is not None:
        if shard_files == "files":
            fleet = len(roots_of(repos)) > 1 or any(map(is_pattern, roots_of(repos)))
            write_shard_files(plan.files, f"{output}/shard_files", by_repo=fleet)
        else:
            write_shard_rows(plan.files, f"{output}/shard_files")
    if transport is not None:
        written = spark.read.parquet(f"{output}/requests")
        for stage in sorted(set(STAGES.values()) - {STAGES["document"]}):
            mode = "overwrite" if stage == 0 else "append"
            wanted = written.where(F.col("stage") == stage)
            if options.get("target_state") is None:
                # Nothing is created that was not looked for.
                state = write_shared(probed(wanted.where(F.col("decision") == "create"), transport), "state")
                wanted = requests.with_decisions(wanted.drop("stage", "decision"), state)
            wanted.write.mode(mode).parquet(f"{output}/request_decisions")
            decided = spark.read.parquet(f"{output}/request_decisions").where(F.col("stage") == stage)
            sent = deliver(
                decided.where(F.col("decision") == "create").withColumn(
                    "head", F.to_json(F.struct(F.col("path").alias("put")))
                ),
                ["repo_id", "kind", "name", "stage"],
                "head",
                "body",
                transport,
                patience=patience,
            )
            with_outcome(sent).write.mode(mode).parquet(f"{output}/request_results")
            _stop_at_errors(spark, f"{output}/request_results", strict, F.col("stage") == stage)
    if plan.documents is not None:
        if transport is None:
            write_ndjson(plan.documents, f"{output}/bulk")
        else:
            _deliver_documents(spark, plan.documents, output, transport, patience, resume)
            _stop_at_errors(spark, f"{output}/document_results", strict)
    return plan


def _stop_at_errors(spark: SparkSession, path: str, strict: bool, which: Column | None = None) -> None:
    results = spark.read.parquet(path).where("outcome = 'error'")
    if strict:
        n = results.where(which if which is not None else F.lit(True)).count()
        if n:
            raise MigrationError(f"{n} refused (see {path})")


def _deliver_documents(
    spark: SparkSession, documents: DataFrame, output: str, transport: Transport, patience: Patience, resume: bool
) -> None:
    """Sends what the ledger does not have; writes `document_results` for all documents, and `dead_letters`."""
    keys = ["repo_id", "target_index", "id"]
    ledger = shared_name(spark, f"{output}/ledger")
    waiting, before = documents, None
    if resume:
        # A written table, so that Spark knows whether the join has to shuffle documents.
        before = write_shared(delivered(documents, keys, ledger), "delivered")
        waiting = undelivered(documents, keys, "action", "source", before)
    else:
        delete_folder(spark, ledger)
    sent = deliver(waiting, keys, "action", "source", transport, patience=patience, ledger=ledger)
    results = write_shared(sent, "sent")
    if before is not None:
        # Documents that were sent again, since they changed, have a new result.
        results = results.unionByName(before.select(*results.columns).join(results, keys, "left_anti"))
    with_outcome(results).write.mode("overwrite").parquet(f"{output}/document_results")
    refused = spark.read.parquet(f"{output}/document_results").where("outcome = 'error'").select(*keys, "status")
    documents.join(refused, keys).write.mode("overwrite").parquet(f"{output}/dead_letters")
