"""All queries of the library with their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (tables) -> DataFrame under its name, with equivalent SQL."""

    def add(f: Callable) -> Callable:
        _QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def arrival_block(order: str = "event_id") -> Column:
    """Blocks of 100,000 in the order of arrival, the unit of work of running results."""
    return F.floor(F.col(order) / 100_000)


class Tables:
    """The tables of a folder, read on first use; column pruning and filters reach the files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import log_queries, more_queries, record_queries, state_queries, stream_queries, table_queries  # noqa: F401

    return _QUERIES


def oracle_sql() -> dict[str, str]:
    queries()
    return _SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["flagship_clicks_by_segment"](spark, sf_dir)
