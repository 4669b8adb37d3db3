"""Repository catalogs: the newest `index-<n>` file of each repository as a typed row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardlift.functions.paths import GENERATION, generation
from shardlift.schemas import CATALOG
from shardlift.sources.repository import metadata_files
from shardlift.sources.roots import is_pattern, repo_name, roots_of

CORRUPT = "_corrupt"


def strict_json(text: Column, schema: T.StructType) -> Column:
    """A record of a fixed schema; `_corrupt` holds the text of one that does not fit it."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(text, wide, {"columnNameOfCorruptRecord": CORRUPT})


def unknown_keys(text: Column, known: Sequence[str]) -> Column:
    """Keys of a JSON object outside the known ones."""
    keys = F.json_object_keys(text)
    return F.array_except(F.coalesce(keys, F.array().cast("array<string>")), F.array(*map(F.lit, known)))


def read_whole_text(spark: SparkSession, patterns: Sequence[str]) -> DataFrame:
    """(path, value) of every file the patterns match; patterns that match nothing give no rows."""
    reader = spark.read.option("wholetext", True)

    def load(paths: list[str]) -> DataFrame:
        # Spark reports paths as URLs, in which only `+` is not what `url_decode` takes it for.
        shown = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
        return reader.text(paths).select(repo_name(shown).alias("path"), "value")

    try:
        return load(list(patterns))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    found = []
    for pattern in patterns:
        try:
            load([pattern])
            found.append(pattern)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    if found:
        return load(found)
    return spark.createDataFrame([], "path string, value string")


def newest(files: DataFrame, keep: str = "value") -> DataFrame:
    """The file with the highest generation of each repository.

    Names that are no catalog's are dropped before the number is read. The maximum is combined
    map-side, so a repository with any number of generations sends one row per task.
    """
    return (
        files.where(F.col("file_name").rlike(GENERATION))
        .withColumn("generation", generation(F.col("file_name")))
        .groupBy("repo_id")
        .agg(F.max_by(F.struct("generation", "file_name", keep), "generation").alias("top"))
        .select("repo_id", "top.*")
    )


def read_catalog_files(spark: SparkSession, repos: str | Sequence[str]) -> DataFrame:
    """(repo_id, file_name, value) of the catalog files at the top level of each repository.

    Of a repository named by its root it is the newest one only, found in a task.
    """
    if not any(map(is_pattern, roots_of(repos))):
        return metadata_files(spark, repos, "catalog")
    files = read_whole_text(spark, [f"{root}/index-*" for root in roots_of(repos)])
    return files.select(
        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("repo_id"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        "value",
    )


def parse_catalog(texts: DataFrame, version: str) -> DataFrame:
    """Catalog text (repo_id, value) to its typed columns, plus `malformed` and `unknown`."""
    schema = CATALOG[version]
    shot = schema["snapshots"].dataType.elementType
    entry = schema["indices"].dataType.valueType
    parts = F.from_json("value", "struct<snapshots:array<string>,indices:map<string,string>>")
    unknown = F.concat(
        unknown_keys(F.col("value"), schema.names),
        F.flatten(
            F.transform(
                F.coalesce(parts["snapshots"], F.array().cast("array<string>")),
                lambda s: unknown_keys(s, shot.names),
            )
        ),
        F.flatten(
            F.transform(
                F.coalesce(F.map_values(parts["indices"]), F.array().cast("array<string>")),
                lambda i: unknown_keys(i, entry.names),
            )
        ),
    )
    return (
        texts.withColumn("record", strict_json(F.col("value"), schema))
        .withColumn("unknown", F.array_distinct(unknown))
        .select(
            "repo_id",
            *[F.col(f"record.{name}").alias(name) for name in schema.names],
            (F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull()).alias("malformed"),
            "unknown",
        )
    )


def read_catalog(spark: SparkSession, repos: str | Sequence[str], version: str) -> DataFrame:
    return parse_catalog(newest(read_catalog_files(spark, repos)), version)
