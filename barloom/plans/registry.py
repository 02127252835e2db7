"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function of (spark, sf_dir) under its name, with DuckDB SQL for the same rows where SQL can express them."""
    def keep(f: Query) -> Query:
        if f.__name__ in QUERIES:
            raise ValueError(f"{f.__name__} is registered twice")
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return keep
