"""One row per key.

Each operator here numbers rows per key and filters the number right away. Spark then
cuts every key to its first row inside each map task, before the shuffle
(``WindowGroupLimit``), so a key that holds a third of all rows sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order; make the order total with a tie-breaker."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], date_col: str, tie: Sequence[str] = ()) -> DataFrame:
    """Row with the newest date per key, unknown dates last."""
    return first_per_key(df, keys, [F.col(date_col).desc_nulls_last(), *[F.col(c) for c in tie]])


# Columns that identify one medical event of one person.
EVENT_KEYS = (
    "patient_first_nm", "patient_last_nm", "patient_birth_dt",
    "first_dos", "original_provider_tax_id", "claim_type",
)


def priority_dedupe(
    df: DataFrame, keys: Sequence[str] = EVENT_KEYS, status: str = "payment_status", tie: Sequence[str] = ()
) -> DataFrame:
    """One row per event; the status that sorts first wins, so PAID beats UNPAID."""
    return first_per_key(df, keys, [F.col(status).asc_nulls_last(), *[F.col(c) for c in tie]])


def exact_dedupe(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and the rows beyond the first copy."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_distinct"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count("*")).alias("n_duplicates"),
    )


def first_seen(df: DataFrame, value: str, position: Sequence[str]) -> DataFrame:
    """Distinct values with the position of their first appearance."""
    spot = F.min(F.struct(*position)).alias("_spot")
    return (
        df.filter(F.col(value).isNotNull() & (F.col(value) != ""))
        .groupBy(value)
        .agg(spot)
        .select(value, *[F.col(f"_spot.{p}").alias(p) for p in position])
    )
