"""Query functions by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def encoded_number(value: Column) -> Column:
    """Stored form of a numeric id: marker, then two digits per byte, F as filler."""
    digits = value.cast("string")
    return F.unhex(F.concat(F.lit("FE"), digits, F.when(F.length(digits) % 2 == 1, "F").otherwise("")))


def encoded_text(value: Column) -> Column:
    return F.concat(F.unhex(F.lit("FF")), F.encode(value, "UTF-8"))


def encoded_bytes(raw: Column) -> Column:
    """Stored form of a raw id: an escape byte first if it would read as another marker."""
    escape = F.hex(F.substring(raw, 1, 1)) >= "FD"
    return F.when(escape, F.concat(F.unhex(F.lit("FD")), raw)).otherwise(raw)
