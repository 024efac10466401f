"""Registry of the driver queries: name -> (Spark query, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return register
