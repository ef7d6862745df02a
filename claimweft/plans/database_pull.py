"""Pull a database query into a published table, with an optional one-file sample for inspection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweft.functions.text import strip_delimiter
from claimweft.sources.files import write_sample
from claimweft.sources.jdbc import load
from claimweft.sources.publish import publish, read_published


def pull(
    spark: SparkSession,
    query: str,
    options: Mapping[str, str],
    out: str,
    predicates: Sequence[str],
    clean: Sequence[str] = ("PROVIDERGROUPNAME",),
    sample_rows: int | None = None,
) -> DataFrame:
    """Publish the query result as the next version of ``out`` and return it as read back from there.

    Until all of it is written, readers of ``out`` see the pull before.

    Each predicate is one task's read (see ``jdbc.month_predicates`` and ``jdbc.balanced_predicates``); they must cover every row
    once. Without them a single task would pull everything, so there have to be some.

    The sample comes from the written files, so the database is read once.
    """
    if not predicates:
        raise ValueError("give predicates that divide the rows")
    rows = load(spark, query, options, is_query=True, predicates=predicates)
    rows = rows.withColumns({c: strip_delimiter(F.col(c)) for c in clean if c in rows.columns})
    publish(rows, out)
    stored = read_published(spark, out)
    if sample_rows:
        write_sample(stored, f"{out.rstrip('/')}_sample", sample_rows)
    return stored
