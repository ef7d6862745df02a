"""Population filters over claim rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweft.functions.dates import lenient_date, under_age
from claimweft.functions.text import differs_or_null, has_code, null_or_not_like

# Adjustment states that stay in the population, and the void claim state.
KEPT_ADJUSTMENTS = (0, 2004)
OPEN_STATE = 1007
VOID_STATE = 1009


def claim_population(
    df: DataFrame,
    adjustments: Sequence = KEPT_ADJUSTMENTS,
    void_state: int = VOID_STATE,
    transaction_types: Sequence[str] | None = None,
    excluded_status_prefix: str | None = None,
) -> DataFrame:
    """Claims worth reporting: savings, under 65, no test record, not void, kept adjustment.

    A NULL last name or claim state stays in. ``transaction_types`` (types to remove) and
    ``excluded_status_prefix`` are optional filters that are off by default.
    """
    keep = (
        (F.col("savings_amt") > 0)
        & (F.col("patient_age_65_ind") == "No")
        & differs_or_null(F.col("patient_last_nm"), "TEST")
        & ~F.coalesce(has_code(F.col("claimstatus"), void_state), F.lit(False))
        & has_code(F.col("adjustmentstatus"), *adjustments)
    )
    if transaction_types:
        col = F.col("transactiontype")
        keep = keep & (col.isNull() | ~col.isin(*transaction_types))
    if excluded_status_prefix:
        keep = keep & null_or_not_like(F.col("status_code").cast("string"), excluded_status_prefix + "%")
    return df.filter(keep)


def model_population(df: DataFrame, start: str, end: str, adjustments: Sequence = KEPT_ADJUSTMENTS) -> DataFrame:
    """Claims of the payment model: half-open window and null-tolerant text rules."""
    return df.filter(
        (F.col("receiveddate") >= F.to_date(F.lit(start)))
        & (F.col("receiveddate") < F.to_date(F.lit(end)))
        & (F.coalesce(F.col("savings"), F.lit(0)) > 0)
        & has_code(F.col("claimstatus"), OPEN_STATE)
        & null_or_not_like(F.col("status_code").cast("string"), "800%", "900%")
        & null_or_not_like(F.col("patientfirstname"), "%TEST%", ignore_case=True)
        & null_or_not_like(F.col("patientlastname"), "%TEST%", ignore_case=True)
        & F.col("mpi_claim_id").isNotNull()
        & has_code(F.col("adjustmentstatus"), *adjustments)
        & under_age(F.col("receiveddate"), F.col("patientdateofbirth"))
    )


def between_closed(df: DataFrame, col: str, low: str, high: str) -> DataFrame:
    return df.filter(F.col(col).between(F.to_date(F.lit(low)), F.to_date(F.lit(high))))


def between_open(df: DataFrame, col: str, low: str, high: str) -> DataFrame:
    return df.filter((F.col(col) > F.to_date(F.lit(low))) & (F.col(col) < F.to_date(F.lit(high))))


def received_after(df: DataFrame, col: str, day: str) -> DataFrame:
    """Strictly after a day, compared as dates even where the column is text."""
    return df.filter(_as_date(df, col) > F.to_date(F.lit(day)))


def drop_resubmits(df: DataFrame, entry: str = "entry_dt", processed: str = "processed_dt") -> DataFrame:
    """Keep claims entered after processing, and claims never entered."""
    return df.filter((F.col(entry) > F.col(processed)) | F.col(entry).isNull())


def exclude_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is not listed; NULL is not listed, so it stays."""
    return df.filter(F.col(col).isNull() | ~F.col(col).isin(*values))


def anomalies(df: DataFrame, savings: str = "savings_amt", charge: str = "total_charge_amt") -> DataFrame:
    return df.filter(F.col(savings) > F.col(charge))


def share_of_rows(df: DataFrame, condition: Column, name: str = "share") -> DataFrame:
    """Rows meeting the condition over all rows, in one pass."""
    hits = F.count_if(condition)
    return df.agg(hits.alias("n_rows"), F.count("*").alias("n_total"), (hits / F.count("*")).alias(name))


def _as_date(df: DataFrame, col: str) -> Column:
    kind = dict((name.lower(), dtype) for name, dtype in df.dtypes)[col.lower()]
    return lenient_date(F.col(col)) if kind == "string" else F.to_date(F.col(col))
