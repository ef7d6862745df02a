"""Roll-up of accounting rows to one row per claim, and the claims they belong to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Amount columns summed per claim, and the document type of a payment.
LEDGER_AMOUNTS = (
    "billed_amount", "payments", "over_payments", "refunds",
    "writeoffs", "adjustments", "cancellations",
)
PAYMENT_DOCUMENT = "PY"


def ledger_rows(ledger: DataFrame, key: str, fee_type_col: str, fee_type: str, method_col: str, method: str) -> DataFrame:
    """Accounting rows of one fee type and billing method that name a claim."""
    return ledger.filter(
        (F.col(fee_type_col) == fee_type) & (F.col(method_col) == method) & F.col(key).isNotNull()
    )


def roll_up(
    ledger: DataFrame,
    key: str,
    amounts: Sequence[str] = LEDGER_AMOUNTS,
    document: str = "blart",
    posted: str = "budat",
    attributes: Sequence[str] | None = None,
    coherent_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per claim: amount sums, row count, paid flag, posting dates, attributes.

    Attributes default to every other column and take their independent maxima, so the
    combination need not exist in the source. With ``coherent_by`` they are all taken from the
    one row that is highest in those columns.
    """
    taken = {c.lower() for c in (key, document, posted, *amounts)}
    if attributes is None:
        attributes = [c for c in ledger.columns if c.lower() not in taken]
    is_payment = F.col(document) == PAYMENT_DOCUMENT
    sums: list[Column] = [F.sum(F.coalesce(F.col(a), F.lit(0))).alias(f"{a}_sum") for a in amounts]
    flags = [
        F.count("*").alias("accounting_row_count"),
        F.max(F.when(is_payment, 1).otherwise(0)).alias("paid_flag"),
        F.min(F.when(is_payment, F.col(posted))).alias("first_payment_date"),
        F.min(posted).alias("first_budat"),
        F.max(posted).alias("last_budat"),
    ]
    claim = F.col(key).cast("string").alias("claim_key")
    if coherent_by is None:
        extras = [F.max(a).alias(a) for a in attributes]
        return ledger.groupBy(claim).agg(*sums, *flags, *extras)
    chosen = F.max_by(F.struct(*attributes), F.struct(*coherent_by)).alias("_row")
    rolled = ledger.groupBy(claim).agg(*sums, *flags, chosen)
    return rolled.select("*", *[F.col(f"_row.{a}").alias(a) for a in attributes]).drop("_row")


def claims_with_ledger(
    claims: DataFrame, claim_key: str, rolled: DataFrame, received: str, as_of: str
) -> DataFrame:
    """Claims that have accounting rows, with the claim age at the as-of date.

    The ledger arrives with one row per claim, already partitioned by the join key. Claims are
    expected once each; where a claim number can repeat without bound, pass a staged roll-up,
    so that the join can split a hot number.
    """
    keyed = claims.withColumn("claim_key", F.col(claim_key).cast("string"))
    age = F.datediff(F.to_date(F.lit(as_of)), F.to_date(received))
    return keyed.join(rolled, "claim_key").withColumn("days_since_received", age)
