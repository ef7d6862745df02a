"""Named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def load_all() -> None:
    from claimweft.plans import (  # noqa: F401
        queries_claims,
        queries_encoding,
        queries_joins,
        queries_links,
        queries_models,
        queries_profile,
        queries_reports,
        queries_scalars,
        queries_windows,
    )
