"""Grouped reports. Grouping drops NULL keys where the reports always have."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweft.functions.amounts import round_even

STATUSES = ("PAID", "UNPAID")


def zero_sum(col: str | Column) -> Column:
    """Sum that is 0, not NULL, when every value is NULL."""
    return F.coalesce(F.sum(col), F.lit(0))


def group_report(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Named aggregates per key; rows with a NULL key are left out."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])


def claim_measures() -> dict[str, Column]:
    return {
        "total_records": F.count("claim_id"),
        "total_charges": zero_sum("total_charge_amt"),
        "total_savings": zero_sum("savings_amt"),
    }


def with_share_of_all(counts: DataFrame, n: str, name: str = "share") -> DataFrame:
    """Each count over the total.

    The total is a single broadcast row, so any number of rows will do. With plain counts the
    shuffle they come from is reused; stage a report of more measures, so that it is computed once.
    """
    total = counts.agg(F.sum(n).alias("_total"))
    return (
        counts.crossJoin(F.broadcast(total))
        .withColumn(name, F.col(n) / F.col("_total"))
        .drop("_total")
    )


def with_share_of_group(counts: DataFrame, n: str, by: Sequence[str], name: str = "share") -> DataFrame:
    """Each count over its group total; meant for already aggregated rows."""
    return counts.withColumn(name, F.col(n) / F.sum(n).over(Window.partitionBy(*by)))


def value_counts(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    rows = df if keep_null else df.dropna(subset=[col])
    counts = rows.groupBy(col).agg(F.count("*").alias("n"))
    return with_share_of_all(counts, "n")


def row_frequency(df: DataFrame) -> DataFrame:
    """How often each full row occurs (rows with a NULL are not counted)."""
    return df.dropna().groupBy(*df.columns).agg(F.count("*").alias("n"))


def monthly_pay_rate(
    df: DataFrame,
    keys: Sequence[str] = ("pcode",),
    month: str = "processed_month",
    status: str = "payment_status",
) -> DataFrame:
    """Paid and unpaid claims per month with whole-percent rates."""
    counts = (
        df.dropna(subset=[*keys, month, status])
        .groupBy(*keys, month)
        .agg(*[F.count(F.when(F.col(status) == s, F.col("claim_id"))).alias(s.lower()) for s in STATUSES])
    )
    paid, unpaid = F.col("paid"), F.col("unpaid")
    total = paid + unpaid
    return counts.select(
        *keys,
        month,
        "paid",
        "unpaid",
        total.alias("claim_total"),
        (round_even(F.try_divide(paid, total), 2) * 100).alias("paid_rate"),
        (round_even(F.try_divide(unpaid, total), 2) * 100).alias("unpaid_rate"),
    )


def pay_rate_by_category(
    df: DataFrame,
    categories: Sequence[str],
    month: str = "processed_month",
    status: str = "payment_status",
) -> DataFrame:
    """Pay rate per month and category value for several categories in one scan.

    The categories are stacked to (category, value) pairs and partially aggregated in the
    same task, so one shuffle carries counts, not rows.
    """
    long = (
        df.dropna(subset=[month, status])
        .select(month, status, *[F.col(c).cast("string").alias(c) for c in categories])
        .unpivot([month, status], list(categories), "category", "value")
        .dropna(subset=["value"])
    )
    counts = long.groupBy(month, "category", "value").agg(
        F.count_if(F.col(status) == "PAID").alias("paid"),
        F.count_if(F.col(status) == "UNPAID").alias("unpaid"),
        F.count("*").alias("total_count"),
    )
    return counts.withColumn("paid_rate", F.col("paid") / F.col("total_count"))


def class_by_category(df: DataFrame, categories: Sequence[str], label: str) -> DataFrame:
    """Rows per (category, value, class) for several categories in one scan."""
    long = df.select(label, *[F.col(c).cast("string").alias(c) for c in categories]).unpivot(
        [label], list(categories), "category", "value"
    )
    return long.dropna(subset=["value", label]).groupBy("category", "value", label).agg(F.count("*").alias("n"))


def cross_tab(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Counts by row value and column value; the column values are listed up front."""
    return (
        df.dropna(subset=[row, col]).groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1))).fillna(0)
    )


def long_means(df: DataFrame, keys: Sequence[str], measures: Sequence[str], scale: int = 4) -> DataFrame:
    """Mean of each measure per key, one row per measure."""
    long = df.select(*keys, *[F.col(m).cast(f"decimal(30,{scale})").alias(m) for m in measures]).unpivot(
        list(keys), list(measures), "measure", "value"
    )
    return long.groupBy(*keys, "measure").agg(
        (F.sum("value").cast("double") / F.count("value")).alias("mean_value"), F.count("value").alias("n")
    )


def target_rate(df: DataFrame, col: str, target: str, top: int = 20) -> DataFrame:
    """Target rate of the most frequent values, NULL being a value."""
    rates = df.groupBy(col).agg(
        (F.sum(target) / F.count(target)).alias("rate"), F.count(target).alias("n")
    )
    return rates.orderBy(F.col("n").desc(), F.col(col).asc_nulls_last()).limit(top)


def per_member_monthly(claims: DataFrame, census: DataFrame, on: str = "group_id") -> DataFrame:
    """Monthly claim totals per group with its census attributes.

    Claims are summed before the join: a group with very many rows meets the census as a few
    rows per month. A group without census has NULL attributes and therefore drops out.
    """
    monthly = (
        claims.withColumn("date", F.make_date("year", "month", F.lit(1)))
        .groupBy(on, "acctid", "ccode", "date")
        .agg(zero_sum("claim_ct").alias("_claims"))
    )
    keys = ["pcode", "client_nm", "date", "acctid", "ccode", "census", on, "census_eff_dt"]
    return (
        monthly.join(census, on, "left")
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.sum("_claims").alias("total_claims"))
    )
