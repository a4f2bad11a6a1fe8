"""Where plans register queries, and how they read tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, oracle: str | None = None) -> Callable:
    """Registers fn(tables), where tables("documents") reads a table."""

    def add(fn: Callable) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: fn(lambda t: table(spark, sf_dir, t))
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


def sql_text(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"
