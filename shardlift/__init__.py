"""Snapshot migration as Spark jobs: catalogs, metadata, files and documents as DataFrames."""

from shardlift.plans.inspect import inspect
from shardlift.plans.migrate import MigrationError, build_plan, migrate

__all__ = ["MigrationError", "build_plan", "inspect", "migrate"]
