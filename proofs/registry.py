"""Collects the proof queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def proof(name: str, sql: str | None) -> Callable[[Query], Query]:
    """Register a query; without SQL where SQL cannot express it and a test has to."""

    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql:
            ORACLES[name] = sql.strip()
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
