"""Joins between claims, keys and labels.

No join of rows carries a broadcast hint: the optimizer broadcasts a side whose size it knows
to be small, and otherwise adaptive execution splits skewed partitions.

A side that only contributes keys is reduced to distinct keys (copies collapse before the
shuffle) and staged. Reading the staged keys keeps the join a plain shuffled join of two
scans, which adaptive execution can split where the other side has a hot key; directly on top
of the aggregation it could not. Small key lists are broadcast from their known size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweft.operators.dedupe import first_per_key
from claimweft.session import stage_table


def distinct_keys(df: DataFrame, columns: Sequence[str], prefix: str = "_k_") -> DataFrame:
    """Distinct known key tuples, staged, under prefixed names."""
    keys = df.select(*[F.col(c).alias(f"{prefix}{c}") for c in columns]).dropna().distinct()
    return stage_table(keys, "keys")


def with_paid_lookup(
    claims: DataFrame, paid: DataFrame, claim_key: str, paid_key: str, status: str, name: str = "payment_status"
) -> DataFrame:
    """Status PAID where the claim id is in the paid list, else the old status.

    Expects one row per claim (see ``latest_per_key``), so neither side has a hot key and the
    partitioning of that step is reused.
    """
    keys = paid.select(F.col(paid_key).cast("string").alias("_paid_id")).dropna().distinct()
    hit = F.col("_paid_id").isNotNull()
    return (
        claims.join(keys, F.col(claim_key).cast("string") == F.col("_paid_id"), "left")
        .withColumn(name, F.when(hit, F.lit("PAID")).otherwise(F.col(status)))
        .drop("_paid_id")
    )


def dedupe_dimension(dim: DataFrame, keys: Sequence[str], order: str, tie: Sequence[str] = ()) -> DataFrame:
    """First dimension row per key in the order of one column."""
    return first_per_key(dim, keys, [F.col(order).asc_nulls_last(), *[F.col(t) for t in tie]])


def eligible_only(claims: DataFrame, dim: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Claims whose key pair occurs in the dimension (``on``: claim column -> dimension column).

    A semi join: no second copy of the key columns, and repeats in the dimension do not matter.
    """
    keys = distinct_keys(dim, list(on.values()))
    cond = [F.col(c) == F.col(f"_k_{d}") for c, d in on.items()]
    return claims.join(keys, cond, "left_semi")


def present_in(df: DataFrame, other: DataFrame, col: str, other_col: str) -> DataFrame:
    """Rows whose value occurs in the other table."""
    keys = distinct_keys(other, [other_col])
    return df.join(keys, F.col(col) == F.col(f"_k_{other_col}"), "left_semi")


def absent_from(df: DataFrame, other: DataFrame, col: str, other_col: str) -> DataFrame:
    """Rows whose value does not occur in the other table; NULL values stay."""
    keys = distinct_keys(other, [other_col])
    return df.join(keys, F.col(col) == F.col(f"_k_{other_col}"), "left_anti")


def labels_to_rows(raw: DataFrame, labels: DataFrame, on: str) -> DataFrame:
    """Every label row with its raw row, if there is one."""
    return raw.join(labels, on, "right")


def with_feedback(claims: DataFrame, feedback: DataFrame, claim_key: str, feedback_key: str) -> DataFrame:
    return claims.join(feedback, F.col(claim_key) == F.col(feedback_key), "left")


def join_quality(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """How two tables relate on a key: keys and rows per relationship, and their shares.

    Works on per-key counts, so a key with very many rows is one row in the join.
    """
    lk = left.groupBy(F.col(left_key).cast("string").alias("_k")).agg(F.count("*").alias("_l"))
    rk = right.groupBy(F.col(right_key).cast("string").alias("_k")).agg(F.count("*").alias("_r"))
    both = lk.dropna(subset=["_k"]).join(rk.dropna(subset=["_k"]), "_k", "full")
    left_n, right_n = F.coalesce("_l", F.lit(0)), F.coalesce("_r", F.lit(0))
    kind = (
        F.when(right_n == 0, "left_only")
        .when(left_n == 0, "right_only")
        .when((left_n == 1) & (right_n == 1), "1:1")
        .when(left_n == 1, "1:n")
        .when(right_n == 1, "n:1")
        .otherwise("n:m")
    )
    report = both.groupBy(kind.alias("relationship")).agg(
        F.count("*").alias("n_keys"),
        F.sum(left_n).alias("left_rows"),
        F.sum(right_n).alias("right_rows"),
        F.sum(left_n * right_n).alias("joined_rows"),
    )
    total = report.agg(F.sum("n_keys").alias("_total"))
    return (
        report.crossJoin(F.broadcast(total))
        .withColumn("key_share", F.col("n_keys") / F.col("_total"))
        .drop("_total")
    )


def posting_lag(joined: DataFrame, received: str, posted: str) -> DataFrame:
    """Days from claim to first posting: count, minimum, mean, maximum, and postings before the claim."""
    lag = F.datediff(posted, received)
    return joined.agg(
        F.count(lag).alias("n"),
        F.min(lag).alias("min_days"),
        (F.sum(lag) / F.count(lag)).alias("mean_days"),
        F.max(lag).alias("max_days"),
        F.count_if(lag < 0).alias("n_before_claim"),
    )


def leaf_vs_decision(
    leaves: DataFrame, paying: DataFrame, not_paying: DataFrame, claim_key: str = "claim_id", leaf: str = "leaf_label"
) -> DataFrame:
    """Claims per leaf that the client decided to pay and not to pay.

    Both decision lists are reduced to distinct ids and met in one join over the leaves.
    """
    decided = (
        paying.select(F.col(claim_key).alias("_id"), F.lit("paying").alias("_d"))
        .unionByName(not_paying.select(F.col(claim_key).alias("_id"), F.lit("not_paying").alias("_d")))
        .dropna(subset=["_id"])
        .groupBy("_id")
        .agg(
            F.max((F.col("_d") == "paying").cast("int")).alias("_pay"),
            F.max((F.col("_d") == "not_paying").cast("int")).alias("_not"),
        )
    )
    per_claim = leaves.groupBy(F.col(claim_key).alias("_id"), leaf).agg(F.count("*").alias("_n"))
    return (
        per_claim.join(decided, "_id")
        .groupBy(leaf)
        .agg(
            F.sum(F.col("_n") * F.col("_pay")).alias("n_paying"),
            F.sum(F.col("_n") * F.col("_not")).alias("n_not_paying"),
        )
    )


def leaf_worklist(
    labelled: DataFrame,
    raw: DataFrame,
    sent: DataFrame,
    leaves: Sequence[int],
    year: int,
    months: Sequence[int],
    claim_key: str = "claim_id",
    received: str = "received_dt",
) -> DataFrame:
    """Unpaid, unsent claims of the chosen leaves received in the given months, by savings.

    Month and status filters run on the raw claims before the join, where they reach the scan.
    """
    wanted = labelled.filter(F.col("leaf_label").isin(*leaves)).select(claim_key, "leaf_label")
    wanted = absent_from(wanted, sent, claim_key, claim_key)
    rows = raw.filter(
        (F.year(received) == year) & F.month(received).isin(*months) & (F.col("payment_status") == "UNPAID")
    )
    return rows.join(wanted, claim_key).orderBy(F.col("savings_amt").desc(), claim_key)
