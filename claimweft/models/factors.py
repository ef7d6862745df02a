"""Factor table for the payment tree: one row per claim, one column per factor."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweft.functions.amounts import clean_infinite, raw_ratio
from claimweft.functions.text import is_text, zip3
from claimweft.session import stage_table
from claimweft.operators.encoding import category_index, one_hot_categories, one_hot_long, one_hot_wide

# Factors used by the payment tree.
CATEGORY_FACTORS = (
    "appealed_flag", "client_cd", "claim_specialty", "last_closure_network_cd",
    "mpi_surprise_bill_ind", "zip3", "provider_state",
)
AMOUNT_FACTORS = ("savings_amt", "total_charge_amt", "savings_rate")
# What the target can be: (source column, value that counts as 1).
TARGETS = {"paid": ("payment_status", "PAID"), "allowable_used": ("allowable_used", "YES")}


def factor_rows(
    claims: DataFrame, target: str = "paid", id_col: str = "claim_id", categories: Sequence[str] = CATEGORY_FACTORS
) -> DataFrame:
    """Identifier, categories (claim indicators included), cleaned amounts and 0/1 target.

    A target value that never occurs simply gives a target of 0 everywhere.
    """
    source, hit = TARGETS[target]
    rows = claims
    if "zip3" in categories and "zip3" not in claims.columns:
        rows = rows.withColumn("zip3", zip3(F.col("zip5")))
    indicators = [c for c in rows.columns if c.lower().startswith("claim_indicator_")]
    rate = raw_ratio(F.col("savings_amt").cast("double"), F.col("total_charge_amt").cast("double"))
    rows = rows.withColumn("savings_rate", rate)
    return rows.select(
        F.col(id_col).cast("string").alias(id_col),
        *[F.coalesce(F.col(c).cast("string"), F.lit("0")).alias(c) for c in [*categories, *indicators]],
        *[clean_infinite(F.col(c).cast("double")).alias(c) for c in AMOUNT_FACTORS],
        is_text(F.col(source), hit).alias("target"),
    )


def factor_table(
    claims: DataFrame,
    target: str = "paid",
    id_col: str = "claim_id",
    categories: Sequence[str] = CATEGORY_FACTORS,
    values: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """``factor_rows`` with the categories spread to 0/1 columns.

    The category values are read from the data unless given (as for scoring).
    """
    rows = factor_rows(claims, target, id_col, categories)
    fixed = {id_col, "target", *AMOUNT_FACTORS}
    spread = [c for c in rows.columns if c not in fixed]
    values = one_hot_categories(rows, spread) if values is None else values
    return one_hot_wide(rows, values).drop(*spread)


def factors_long(
    claims: DataFrame, target: str = "paid", id_col: str = "claim_id", categories: Sequence[str] = CATEGORY_FACTORS
) -> DataFrame:
    """(claim, factor, value): every non-zero cell of the factor table, without a limit of values.

    A category's factor is named ``column_value``; amounts and the target keep their names. Zero cells
    are left out, as in a sparse vector.
    """
    rows = factor_rows(claims, target, id_col, categories)
    spread = [c for c in rows.columns if c not in {id_col, "target", *AMOUNT_FACTORS}]
    ones = rows.select(id_col, *spread).unpivot([id_col], spread, "column", "text")
    named = ones.select(id_col, F.concat_ws("_", "column", "text").alias("factor"), F.lit(1.0).alias("value"))
    numbers = rows.select(id_col, F.col("target").cast("double").alias("target"), *AMOUNT_FACTORS)
    long = numbers.unpivot([id_col], ["target", *AMOUNT_FACTORS], "factor", "value").filter("value <> 0")
    return named.unionByName(long)


def factor_vectors(rows: DataFrame, id_col: str, categories: Sequence[str], amounts: Sequence[str] = AMOUNT_FACTORS) -> DataFrame:
    """(claim, features): a sparse vector of all category values and the amounts, of any width."""
    index = stage_table(category_index(rows, categories), "factor-index")
    widths = {r.column: r.n for r in index.groupBy("column").agg(F.count("*").alias("n")).collect()}
    starts, total = {}, 0
    for c in categories:
        starts[c], total = total, total + widths.get(c, 0)
    start = F.element_at(F.create_map(*[F.lit(x) for pair in starts.items() for x in pair]), F.col("column"))
    ones = one_hot_long(rows, id_col, categories, index).select(id_col, (start + F.col("position")).alias("at"), F.lit(1.0).alias("value"))
    number = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(amounts) for x in (c, total + i)]), F.col("column"))
    amount = rows.select(id_col, *amounts).unpivot([id_col], list(amounts), "column", "value").filter("value <> 0")
    cells = ones.unionByName(amount.select(id_col, number.alias("at"), "value"))
    # a claim has one cell for each column, so its list is short
    lists = cells.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("cells"))
    parts = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(total + len(amounts)).alias("size"),
        F.transform("cells", lambda x: x["at"].cast("int")).alias("indices"), F.transform("cells", lambda x: x["value"]).alias("values"),
    )
    return lists.select(id_col, parts.alias("features"))
