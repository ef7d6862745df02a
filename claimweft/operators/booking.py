"""Booking curve: how long after processing claims get paid.

Everything is derived from one small table, claims per (keys, processed month, entry month,
status); the claim rows are scanned and shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweft.functions.amounts import round_even
from claimweft.functions.dates import month_label, month_of
from claimweft.operators.aggregates import zero_sum
from claimweft.operators.filters import drop_resubmits
from claimweft.session import stage_table


def booking_cells(
    claims: DataFrame, keys: Sequence[str] = ("pcode",), by: Sequence[str] = ("payment_status",)
) -> DataFrame:
    """Claims with savings, resubmits removed, counted per processed and entry month."""
    rows = claims.filter(F.col("savings_amt") > 0).transform(drop_resubmits)
    months = {
        "processed_month": month_of(F.col("processed_dt")),
        "entry_month": month_of(F.col("entry_dt")),
    }
    cells = (
        rows.dropna(subset=[*keys, "processed_dt"])
        .groupBy(*keys, *[m.alias(name) for name, m in months.items()], *by)
        .agg(F.count("claim_id").alias("n"), zero_sum("savings_amt").alias("savings"))
    )
    return cells.withColumns({name: month_label(F.col(name)) for name in months})


def booking_long(claims: DataFrame, keys: Sequence[str] = ("pcode",)) -> DataFrame:
    """Percent of a month's claims entered in each later month.

    The denominator counts never-paid claims too. One row per pair of months that occurs.
    """
    return curve_of_cells(booking_cells(claims, keys, by=()), keys)


def curve_of_cells(cells: DataFrame, keys: Sequence[str] = ("pcode",)) -> DataFrame:
    """``booking_long`` of cells that may be finer than pairs of months."""
    pairs = cells.groupBy(*keys, "processed_month", "entry_month").agg(F.sum("n").alias("n_claims"))
    month = Window.partitionBy(*keys, "processed_month")
    return (
        pairs.withColumn("n_month", F.sum("n_claims").over(month))
        .filter(F.col("entry_month").isNotNull())
        .withColumn("percent", round_even(F.col("n_claims") / F.col("n_month") * 100, 1))
    )


def _status_columns():
    paid = F.col("payment_status") == "PAID"
    unpaid = F.col("payment_status") == "UNPAID"

    def total(col, cond):
        return F.coalesce(F.sum(F.when(cond, F.col(col))), F.lit(0))

    return [
        total("n", paid).alias("paid_claim_count"),
        total("n", unpaid).alias("unpaid_claim_count"),
        total("savings", paid).alias("paid_savings_total"),
        total("savings", unpaid).alias("unpaid_savings_total"),
    ]


def _with_rate(df: DataFrame) -> DataFrame:
    total = F.col("paid_claim_count") + F.col("unpaid_claim_count")
    return df.withColumn("total_claim_count", total).withColumn(
        "pay_rate", F.try_divide(F.col("paid_claim_count"), total)
    )


def booking_status(claims: DataFrame, keys: Sequence[str] = ("pcode",)) -> DataFrame:
    """Counts, savings and pay rate per month; a status a month lacks counts as 0."""
    return status_of_cells(booking_cells(claims, keys), keys)


def status_of_cells(cells: DataFrame, keys: Sequence[str] = ("pcode",)) -> DataFrame:
    return cells.groupBy(*keys, "processed_month").agg(*_status_columns()).transform(_with_rate)


def entry_months(cells: DataFrame) -> list[str]:
    """The months in which claims were entered, ascending; as many as the data has months."""
    return sorted(r.entry_month for r in cells.select("entry_month").dropna().distinct().collect())


def booking_pivot(
    claims: DataFrame, months: Sequence[str] | None = None, keys: Sequence[str] = ("pcode",)
) -> DataFrame:
    """Status totals and booking percents side by side, one column per entry month.

    The months are those of the data unless given. Months without any payment keep NULL percents, as
    an outer join of the two tables gives.
    """
    cells = booking_cells(claims, keys)
    if months is None:
        cells = stage_table(cells, "booking-cells")  # the months are read from it, and then the table
        months = entry_months(cells)
    return pivot_of_cells(cells, months, keys)


def pivot_of_cells(cells: DataFrame, months: Sequence[str], keys: Sequence[str] = ("pcode",)) -> DataFrame:
    every = F.sum("n")
    any_entry = F.count_if(F.col("entry_month").isNotNull()) > 0
    percents = [
        F.when(
            any_entry,
            round_even(
                F.coalesce(F.sum(F.when(F.col("entry_month") == m, F.col("n"))), F.lit(0)) / every * 100, 1
            ),
        ).alias(entry_column(m))
        for m in months
    ]
    return cells.groupBy(*keys, "processed_month").agg(*_status_columns(), *percents).transform(_with_rate)


def entry_column(month: str) -> str:
    return "entry_" + month.replace("-", "_")


def pivot_completeness(cells: DataFrame, pivot: DataFrame) -> DataFrame:
    """One row: entered claims in all, those of a month that the pivot has a column for, and whether none is left out."""
    shown = [c for c in pivot.columns if c.startswith("entry_")]
    column = F.concat(F.lit("entry_"), F.replace("entry_month", F.lit("-"), F.lit("_")))
    entered = F.col("entry_month").isNotNull()
    counts = cells.agg(
        F.coalesce(F.sum(F.when(entered, F.col("n"))), F.lit(0)).alias("n_entered"),
        F.coalesce(F.sum(F.when(entered & column.isin(shown), F.col("n"))), F.lit(0)).alias("n_shown"),
    )
    return counts.withColumn("complete", F.col("n_entered") == F.col("n_shown"))
