"""Payment-prediction job: claims with ledger -> sample -> features -> encoded train and test rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweft.functions.amounts import age_bucket, log_amount, positive_flag, ratio_plus_one
from claimweft.operators.columns import drop_leakage, fill_constants
from claimweft.operators.encoding import encode_columns
from claimweft.operators.filters import model_population
from claimweft.operators.ledger import LEDGER_AMOUNTS, claims_with_ledger, ledger_rows, roll_up
from claimweft.operators.sampling import balanced_sample, stratified_folds, stratified_split
from claimweft.session import stage_table

TARGET = "paid_flag"
CLASSES = (0, 1)
# High-cardinality columns of the payment model that are target-encoded.
ENCODED_COLUMNS = (
    "cpt", "providergroupname", "client_code", "zz1_acctproduct_op1", "claim_type", "provider_state",
)


def extract(
    claims: DataFrame,
    ledger: DataFrame,
    start: str,
    end: str,
    as_of: str,
    sample_size: int,
    fee_type: tuple[str, str],
    bill_method: tuple[str, str],
    claim_key: str = "claimnumber",
    ledger_key: str = "zz1_rims_claim_number_op1",
    amounts: Sequence[str] = LEDGER_AMOUNTS,
) -> DataFrame:
    """Claims of the window with their rolled-up ledger, at most ``sample_size`` per class.

    ``fee_type`` and ``bill_method`` are (column, value) pairs of the ledger. The sample is
    drawn from (claim, paid flag) alone; both wide sides are then reduced to the sampled claims
    before they are rolled up and joined.
    """
    population = model_population(claims, start, end)
    entries = ledger_rows(ledger, ledger_key, *fee_type, *bill_method)
    flags = stage_table(roll_up(entries, ledger_key, (), attributes=()).select("claim_key", TARGET), "paid-flags")
    keys = population.select(F.col(claim_key).cast("string").alias("claim_key"))
    narrow = stage_table(keys.join(flags, "claim_key"), "claim-flags")
    sampled = balanced_sample(narrow, TARGET, CLASSES, ["claim_key"], sample_size)
    sampled = stage_table(sampled.select(F.col("claim_key").alias("_sampled")), "sampled-claims")
    rolled = stage_table(roll_up(_among(entries, ledger_key, sampled), ledger_key, amounts), "rolled-ledger")
    return claims_with_ledger(_among(population, claim_key, sampled), claim_key, rolled, "receiveddate", as_of)


def _among(rows: DataFrame, key: str, sampled: DataFrame) -> DataFrame:
    return rows.join(sampled, F.col(key).cast("string") == F.col("_sampled"), "left_semi")


# Derived column -> (columns it takes, formula).
FEATURES = {
    "log_billed_amount_sum": (("billed_amount_sum",), log_amount),
    "log_reasonableandcustomary": (("reasonableandcustomary",), log_amount),
    "log_noncoveredcharges": (("noncoveredcharges",), log_amount),
    "has_noncoveredcharges": (("noncoveredcharges",), positive_flag),
    "rnc_to_billed_ratio": (("reasonableandcustomary", "billed_amount_sum"), ratio_plus_one),
    "noncovered_to_billed_ratio": (("noncoveredcharges", "billed_amount_sum"), ratio_plus_one),
    "claim_age_bucket": (("days_since_received",), age_bucket),
}


def features(df: DataFrame) -> DataFrame:
    """Columns derived without looking at the outcome; each only where its inputs exist."""
    kinds = {name.lower(): kind for name, kind in df.dtypes}
    amount = lambda c: F.col(c) if c == "days_since_received" else F.col(c).cast("double")
    return df.withColumns(
        {out: formula(*map(amount, takes)) for out, (takes, formula) in FEATURES.items() if kinds.keys() >= set(takes)}
    )


def model_rows(extracted: DataFrame) -> DataFrame:
    """Leakage removed, constants filled, features added."""
    return extracted.transform(drop_leakage).transform(fill_constants).transform(features)


def train_and_test(
    rows: DataFrame, columns: Sequence[str] = ENCODED_COLUMNS, key: str = "claim_key", test_share: float = 0.2
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stratified split, then out-of-fold encodings for training rows; returns (train, test, maps)."""
    rows = stage_table(rows, "model-rows")  # cuts, folds and encodings all go over them
    split = stratified_split(rows, TARGET, CLASSES, [key], test_share)
    train = split.filter("is_test = 0").drop("is_test")
    test = split.filter("is_test = 1").drop("is_test")
    train = stratified_folds(train, TARGET, CLASSES, [key], 5)
    return encode_columns(train, test, columns, TARGET)
