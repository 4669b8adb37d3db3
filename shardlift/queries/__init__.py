"""Queries over the test tables: each frames table rows as repository content and runs operators on it."""

from shardlift.queries import catalogs, configs, docs, files, requests  # noqa: F401
from shardlift.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
