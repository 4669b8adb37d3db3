"""Names of repositories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def repo_name(path: Column) -> Column:
    """How a repository is named in all tables: its absolute root, local ones without a scheme.

    Asked-for roots, roots of files that Spark found and `repo_id` of documents all go through this.
    """
    return F.regexp_replace(F.regexp_replace(path, r"^file:/+", "/"), r"(?<=[^/])/+$", "")


def asked_names(spark: SparkSession, repos: str | Sequence[str]) -> dict[str, str]:
    """The absolute form of each root as the caller gave it; patterns stay as they are."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = {}
    for root in roots_of(repos):
        path = jvm.org.apache.hadoop.fs.Path(root)
        out[root] = root if is_pattern(root) else path.getFileSystem(conf).makeQualified(path).toString()
    return out


def is_pattern(root: str) -> bool:
    return any(c in root for c in "*?[{")


def roots_of(repos: str | Sequence[str]) -> list[str]:
    names = [repos] if isinstance(repos, str) else list(repos)
    return [n[:-1] if n.endswith("/") else n for n in names]
