"""Registration, and the table reader."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name, next to the SQL that gives the same rows."""

    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLES[query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
