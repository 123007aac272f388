"""Name -> query and name -> oracle, filled by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adlake.session import apply_defaults
from workload.bindings import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with its SQL counterpart."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(apply_defaults(spark), folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
