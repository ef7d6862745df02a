"""Fee bounds, revenue estimates, monthly status summary and what remains to be paid.

Revenue is a client-wide fee times savings, so savings are summed first and the fee is
applied to the sums; fee bounds come out of the same grouped rows. One scan, one shuffle of
claim rows, and every client in the same run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweft.functions.dates import month_label, month_of
from claimweft.functions.text import normalise_key
from claimweft.operators.aggregates import with_share_of_group, zero_sum

FEE_KEYS = ("client_cd", "network_cd")


def _paid_fee():
    return F.when((F.col("payment_status") == "PAID") & (F.col("fee_amount") > 0), F.col("fee_amount"))


def _known(keys: Sequence[str]):
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return known


def fee_bounds(claims: DataFrame, by: Sequence[str] = (), fee_keys: Sequence[str] = FEE_KEYS) -> DataFrame:
    """Smallest positive paid fee, and the frequency-weighted average of paid fees.

    Rows with an unknown client or network are left out of the weighted sum but not out of
    the row count it is divided by.
    """
    fee = _paid_fee()
    weighted = F.try_divide(F.sum(F.when(_known(fee_keys), fee)).cast("double"), F.count(fee))
    return claims.groupBy(*by).agg(
        F.min(fee).cast("double").alias("min_fee"),
        weighted.alias("weighted_fee"),
        F.count(fee).alias("n_paid"),
    )


def with_revenue_estimates(claims: DataFrame) -> DataFrame:
    """Row-level low and high revenue from one client's fee bounds (a single broadcast row)."""
    fee = _paid_fee()
    bounds = claims.agg(
        F.min(fee).alias("_low"),
        F.sum(F.when(_known(FEE_KEYS), fee)).alias("_sum"),
        F.count(fee).alias("_n"),
    )
    saved = F.col("savings_amt").cast("double")
    high = F.try_divide(F.col("_sum").cast("double"), F.col("_n"))
    return (
        claims.crossJoin(F.broadcast(bounds))
        .withColumn("revenue_estimate_lower", F.col("_low").cast("double") * F.lit(0.01) * saved)
        .withColumn("revenue_estimate_upper", high * F.lit(0.01) * saved)
        .drop("_low", "_sum", "_n")
    )


def _fee_measures(fee_keys: Sequence[str]) -> list:
    """Sums per cell from which reports of any coarser keys follow."""
    fee = _paid_fee()
    return [
        F.count("claim_id").alias("total_records"),
        zero_sum("total_charge_amt").alias("total_charges"),
        zero_sum("savings_amt").alias("total_savings"),
        F.min(fee).alias("_min_fee"),
        F.sum(F.when(_known(fee_keys), fee)).alias("_fee_sum"),
        F.count(fee).alias("_fee_n"),
    ]


def revenue_cells(
    claims: DataFrame, keys: Sequence[str], client_group: str = "pcode", fee_keys: Sequence[str] = FEE_KEYS
) -> DataFrame:
    """Counts, charges, savings and revenue estimates per client group and ``keys``.

    Fee bounds are per ``client_group``. Rows with a NULL key drop out of the report, but
    their paid fees still count for the bounds.
    """
    return _with_revenue(claims.groupBy(client_group, *keys).agg(*_fee_measures(fee_keys)), keys, client_group)


def _with_revenue(cells: DataFrame, keys: Sequence[str], client_group: str) -> DataFrame:
    group = Window.partitionBy(client_group)
    low = F.min("_min_fee").over(group).cast("double")
    high = F.try_divide(F.sum("_fee_sum").over(group).cast("double"), F.sum("_fee_n").over(group))
    saved = F.col("total_savings").cast("double")
    return (
        cells.withColumns({"min_fee": low, "weighted_fee": high})
        .withColumn("revenue_lower", F.col("min_fee") * F.lit(0.01) * saved)
        .withColumn("revenue_upper", F.col("weighted_fee") * F.lit(0.01) * saved)
        .drop("_min_fee", "_fee_sum", "_fee_n")
        .dropna(subset=[client_group, *keys])
    )


#: Keys of the cells that all monthly reports follow from.
REPORT_KEYS = ("pcode", "processed_month", "entry_month", "client_cd", "payment_status")


def report_cells(claims: DataFrame, fee_keys: Sequence[str] = FEE_KEYS) -> DataFrame:
    """Claims per ``REPORT_KEYS`` and ``booked`` (with savings, no resubmit): one scan, one shuffle of the claims.

    As many rows as pairs of months by clients and statuses.
    """
    booked = F.coalesce((F.col("savings_amt") > 0) & ((F.col("entry_dt") > F.col("processed_dt")) | F.col("entry_dt").isNull()), F.lit(False))
    months = {"processed_month": month_of(F.col("processed_dt")), "entry_month": month_of(F.col("entry_dt"))}
    rows = claims.withColumns({**months, "booked": booked})
    cells = rows.groupBy(*REPORT_KEYS, "booked").agg(*_fee_measures(fee_keys))
    return cells.withColumns({name: month_label(F.col(name)) for name in months})


def booked_cells(cells: DataFrame, keys: Sequence[str] = ("pcode",)) -> DataFrame:
    """Cells of the booking reports (see ``booking_cells``) from report cells."""
    kept = cells.filter("booked").dropna(subset=[*keys, "processed_month"])
    return kept.withColumnsRenamed({"total_records": "n", "total_savings": "savings"})


def month_client_status_of(cells: DataFrame, client_group: str = "pcode") -> DataFrame:
    """``month_client_status`` from report cells."""
    keys = ["processed_month", "client_cd", "payment_status"]
    sums = [F.sum(c).alias(c) for c in ("total_records", "total_charges", "total_savings", "_fee_sum", "_fee_n")]
    return _with_revenue(cells.groupBy(client_group, *keys).agg(*sums, F.min("_min_fee").alias("_min_fee")), keys, client_group)


def month_client_status(claims: DataFrame, client_group: str = "pcode") -> DataFrame:
    return revenue_cells(claims, ["processed_month", "client_cd", "payment_status"], client_group)


def status_summary(claims: DataFrame, client_group: str = "pcode", fee_keys: Sequence[str] = ("network_cd",)) -> DataFrame:
    """Totals and revenue per status, with the status' share of the client group's claims."""
    cells = revenue_cells(claims, ["payment_status"], client_group, fee_keys)
    return with_share_of_group(cells, "total_records", [client_group], "percentage")


MEASURES = ("total_records", "total_charges", "total_savings")


def status_pivot(
    cells: DataFrame, keys: Sequence[str], statuses: Sequence[str] = ("PAID", "UNPAID")
) -> DataFrame:
    """One column per measure and status, NULL where a month lacks the status; rates and total.

    ``keys`` must include the client group, whose fees turn the exact savings sums into revenue.
    """
    sums = [
        F.sum(F.when(F.col("payment_status") == s, F.col(m))).alias(f"{m}_{s.lower()}")
        for m in MEASURES
        for s in statuses
    ]
    wide = cells.groupBy(*keys).agg(*sums, F.max("min_fee").alias("_low"), F.max("weighted_fee").alias("_high"))
    wide = wide.withColumns(
        {
            f"revenue_{bound}_{s.lower()}": F.col(fee)
            * F.lit(0.01)
            * F.col(f"total_savings_{s.lower()}").cast("double")
            for bound, fee in (("lower", "_low"), ("upper", "_high"))
            for s in statuses
        }
    ).drop("_low", "_high")
    paid, unpaid = F.col("total_records_paid"), F.col("total_records_unpaid")
    return (
        wide.withColumn("paid_rate", paid / (paid + unpaid))
        .withColumn("unpaid_rate", unpaid / (paid + unpaid))
        .withColumn("all_claims_total", paid + unpaid)
    )


def remaining_to_pay(monthly: DataFrame, client_group: str = "pcode", recent: int = 3) -> DataFrame:
    """Expected late payments of the last months of each client.

    The mean pay rate of the older months (0 if there are none) minus the month's own rate,
    applied to the unpaid revenue; older months get 0. Runs on monthly rows.
    """
    newest_first = Window.partitionBy(client_group).orderBy(F.col("processed_month").desc())
    client = Window.partitionBy(client_group)
    ranked = monthly.withColumn("_age", F.row_number().over(newest_first))
    older = F.avg(F.when(F.col("_age") > recent, F.col("paid_rate"))).over(client)
    has_older = F.max("_age").over(client) > recent
    expected = F.when(has_older, older).otherwise(F.lit(0.0))
    gap = F.when(F.col("_age") <= recent, expected - F.col("paid_rate")).otherwise(F.lit(0.0))
    return (
        ranked.withColumn("remaining_rate", gap)
        .withColumn("remaining_lower", F.col("remaining_rate") * F.col("revenue_lower_unpaid"))
        .withColumn("remaining_upper", F.col("remaining_rate") * F.col("revenue_upper_unpaid"))
        .drop("_age")
    )


def revenue_by_rate_dim(
    claims: DataFrame, rates: DataFrame, client: str = "pcode", rate_client: str = "parent_client"
) -> DataFrame:
    """Revenue from a rate table (fractions); a client without rates earns 0.

    Savings are summed per client before the rates are joined, so the join sees one row per
    (client, month, status) whatever the client's share of the claims.
    """
    measures = [F.count("claim_id").alias("total_records"), zero_sum("total_charge_amt").alias("total_charges"), zero_sum("savings_amt").alias("total_savings")]
    return _with_rates(claims, measures, rates, client, rate_client)


def revenue_by_rate_dim_of(cells: DataFrame, rates: DataFrame, client: str = "pcode", rate_client: str = "parent_client") -> DataFrame:
    """``revenue_by_rate_dim`` from report cells."""
    return _with_rates(cells, [F.sum(c).alias(c) for c in MEASURES], rates, client, rate_client)


def _with_rates(rows: DataFrame, measures: Sequence, rates: DataFrame, client: str, rate_client: str) -> DataFrame:
    cells = rows.dropna(subset=["processed_month", "payment_status"]).groupBy(client, "processed_month", "payment_status").agg(*measures)
    keyed = rates.select(
        normalise_key(F.col(rate_client)).alias("_client"),
        F.col("min_rate").alias("_low"),
        F.col("avg_rate").alias("_high"),
    )
    saved = F.col("total_savings").cast("double")
    return (
        cells.withColumn("_client", normalise_key(F.col(client)))
        .join(keyed, "_client", "left")
        .withColumn("revenue_lower", F.coalesce(F.col("_low"), F.lit(0.0)) * saved)
        .withColumn("revenue_upper", F.coalesce(F.col("_high"), F.lit(0.0)) * saved)
        .drop("_client", "_low", "_high")
    )
