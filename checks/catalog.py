"""Registry of the checks: a Spark query and, where SQL can state it, the expected result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}


class Tables:
    """Tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def check(sql: str | None = None) -> Callable:
    """Register a function of `Tables` under its name, with the SQL of its expected rows."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            EXPECTED[build.__name__] = sql
        return build

    return register
