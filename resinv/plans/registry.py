"""The registered queries of the core and the SQL twins that check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL where SQL can express it."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"two queries named {key}")
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")
