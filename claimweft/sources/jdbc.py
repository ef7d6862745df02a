"""Reads from a relational database."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

# Rows per fetch, and the date format pushed-down predicates rely on.
FETCH_SIZE = 10000
SESSION_INIT = "ALTER SESSION SET NLS_DATE_FORMAT = 'YYYY-MM-DD'"


def oracle_options(
    environ: Mapping[str, str] | None = None, fetch_size: int = FETCH_SIZE, session_init: str | None = SESSION_INIT
) -> dict[str, str]:
    """JDBC options with credentials from the environment (``DB_URL``, ``DB_USER``, ``DB_PASSWORD``)."""
    environ = os.environ if environ is None else environ
    missing = [k for k in ("DB_URL", "DB_USER", "DB_PASSWORD") if not environ.get(k)]
    if missing:
        raise ValueError(f"missing environment variables: {missing}")
    options = {
        "url": environ["DB_URL"],
        "user": environ["DB_USER"],
        "password": environ["DB_PASSWORD"],
        "driver": "oracle.jdbc.OracleDriver",
        "fetchsize": str(fetch_size),
    }
    if session_init:
        options["sessionInitStatement"] = session_init
    return options


def as_derived_table(query: str, alias: str = "T") -> str:
    """A query in the form the ``dbtable`` option takes, so the database runs it."""
    return f"({query.strip().rstrip(';')}) {alias}"


def load(
    spark: SparkSession,
    table_or_query: str,
    options: Mapping[str, str],
    is_query: bool = False,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Table or pushed-down query; one partition per predicate.

    The predicates must cover every row exactly once. They are an argument of
    ``DataFrameReader.jdbc``; as a reader option they would be ignored and a single task
    would pull the whole table.
    """
    source = as_derived_table(table_or_query) if is_query else table_or_query
    if predicates:
        properties = {k: v for k, v in options.items() if k != "url"}
        return spark.read.jdbc(options["url"], source, predicates=list(predicates), properties=properties)
    return spark.read.format("jdbc").options(**options).option("dbtable", source).load()


def month_predicates(column: str, months: Sequence[str]) -> list[str]:
    """One half-open month window per predicate (``months`` as yyyy-MM), then one for all other rows.

    The last predicate takes rows without a date and those outside the months, so that together
    they cover every row once.
    """
    out = []
    for label in dict.fromkeys(months):
        year, month = (int(x) for x in label.split("-"))
        following = f"{year + month // 12}-{month % 12 + 1:02d}-01"
        out.append(f"{column} >= DATE '{label}-01' AND {column} < DATE '{following}'")
    inside = " OR ".join(f"({p})" for p in out) or "1 = 0"
    return [*out, f"({column} IS NULL OR NOT ({inside}))"]


def day_histogram_query(query: str, column: str) -> str:
    """Rows per day of a query's date column, for the database to count: one row a day, one for rows without a date."""
    return f"SELECT TRUNC({column}) AS DAY, COUNT(*) AS N FROM ({query.strip().rstrip(';')}) Q GROUP BY TRUNC({column})"


def balanced_predicates(column: str, days: Sequence[tuple[date | None, int]], tasks: int, key: str | None = None) -> list[str]:
    """Predicates of about equal rows from a histogram of days, in any order; together they cover every row once.

    Neighbouring days go together up to a task's share. A day of more rows than two shares is divided
    by the hash of ``key``, where there is one. The last predicate takes rows without a date and, so that rows
    which arrive after the count are not lost, those outside the days counted.
    """
    counted = sorted((day, n) for day, n in days if day is not None)
    if not counted:
        return ["1 = 1"]
    share = max(1.0, sum(n for _, n in counted) / max(1, tasks))
    windows: list[list[tuple[date, int]]] = []
    filled = 0.0
    for day, n in counted:
        heavy = n >= 2 * share
        if not windows or heavy or filled + n / 2 > share:
            windows.append([])
            filled = 0.0
        windows[-1].append((day, n))
        filled = share if heavy else filled + n
    out = []
    starts = [w[0][0] for w in windows]
    ends = [*starts[1:], counted[-1][0] + timedelta(days=1)]
    for window, start, end in zip(windows, starts, ends, strict=True):
        inside = f"{column} >= DATE '{start}' AND {column} < DATE '{end}'"
        pieces = round(sum(n for _, n in window) / share) if key else 1
        # the hash of an empty key is no number, so such rows go with the first piece
        out += [inside] if pieces < 2 else [f"{inside} AND NVL(ORA_HASH({key}, {pieces - 1}), 0) = {i}" for i in range(pieces)]
    return [*out, f"({column} IS NULL OR {column} < DATE '{starts[0]}' OR {column} >= DATE '{ends[-1]}')"]


def balanced_load(spark: SparkSession, query: str, options: Mapping[str, str], column: str, tasks: int, key: str | None = None) -> DataFrame:
    """The query in about ``tasks`` reads of equal size; the database counts its days first."""
    days = load(spark, day_histogram_query(query, column), options, is_query=True).collect()
    predicates = balanced_predicates(column, [(r[0].date() if isinstance(r[0], datetime) else r[0], int(r[1])) for r in days], tasks, key)
    return load(spark, query, options, is_query=True, predicates=predicates)


def run_extract(spark: SparkSession, text: str, params: Mapping[str, object], **tables: DataFrame) -> DataFrame:
    """SQL with named parameters (``:name``) over data frames (``{name}``); values are never spliced into the text."""
    return spark.sql(text, args=dict(params), **tables)
