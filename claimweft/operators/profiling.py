"""Table profiles: missing values, summaries, cardinality, correlation, box numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweft.functions.stats import chi_square_log_p
from claimweft.operators.quantiles import exact_quantiles, stack_numeric
from claimweft.session import stage_table

QUARTILES = (0.25, 0.5, 0.75)
TAIL = (0.95, 0.99, 0.999)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a missing value in every profile."""
    floats = [c for c, kind in df.dtypes if kind in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def missing_profile(df: DataFrame) -> DataFrame:
    """Columns that have NULLs or NaNs and how many, most first; one pass over the table."""
    counts = nan_to_null(df).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return (
        counts.unpivot([], df.columns, "column", "n_missing")
        .filter(F.col("n_missing") > 0)
        .orderBy(F.col("n_missing").desc(), "column")
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    moments = {
        "mean": F.avg("value"), "std": F.stddev_samp("value"), "min": F.min("value"), "max": F.max("value"),
    }
    return exact_quantiles(df, columns, QUARTILES, extra=moments).select(
        "column", "n", "mean", "std", "min",
        *[F.element_at("quantiles", i + 1).alias(q) for i, q in enumerate(("q25", "q50", "q75"))],
        "max",
    )


def stack_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return text.unpivot([], list(columns), "column", "value")


def categorical_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Known values, distinct values, most frequent value (lowest on ties) and its frequency."""
    counts = stack_text(df, columns).dropna().groupBy("column", "value").agg(F.count("*").alias("_n"))
    top = F.min_by("value", F.struct((-F.col("_n")).alias("_o"), F.col("value")))
    return counts.groupBy("column").agg(
        F.sum("_n").alias("n"), F.count("*").alias("n_unique"), top.alias("top"), F.max("_n").alias("freq")
    )


def tail_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = TAIL) -> DataFrame:
    """(column, prob, value) rows of the upper quantiles."""
    q = exact_quantiles(df, columns, probs)
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("quantiles").alias("value"))
    return q.select("column", F.explode(pairs).alias("_p")).select(
        "column", F.col("_p.prob").alias("prob"), F.col("_p.value").alias("value")
    )


def cardinality(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct known values per column, most first."""
    if approximate:
        counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        out = counts.unpivot([], list(columns), "column", "n_unique")
    else:
        values = stack_text(df, columns).dropna().distinct()
        out = values.groupBy("column").agg(F.count("*").alias("n_unique"))
    return out.orderBy(F.col("n_unique").desc(), "column")


def top_values(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The k most frequent values of each column, NULL being a value."""
    counts = stack_text(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))
    order = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value").asc_nulls_last())
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_a, column_b, corr) for every ordered pair; rows with a missing side are skipped per pair."""
    numeric = nan_to_null(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    upper = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = numeric.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(upper)])
    place = {pair: f"_{i}" for i, pair in enumerate(upper)}
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("column_a"),
                F.lit(b).alias("column_b"),
                F.col(place.get((a, b)) or place[(b, a)]).alias("corr"),
            )
            for a in columns
            for b in columns
        ]
    )
    return wide.select(F.inline(cells))


def correlation_with(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """(column, corr) against the target, highest first."""
    numeric = nan_to_null(df.select(*[F.col(c).cast("double").alias(c) for c in [*columns, target]]))
    wide = numeric.agg(*[F.corr(c, target).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "corr").orderBy(F.col("corr").desc_nulls_last())


def box_numbers(df: DataFrame, columns: Sequence[str], label: str, classes: Sequence) -> DataFrame:
    """Per class and column: quartiles and the outermost values within 1.5 box lengths."""
    long = stack_numeric(df.filter(F.col(label).isin(*classes)), columns, [label])
    q = exact_quantiles(df, columns, QUARTILES, label, classes).select(
        label, "column", "n",
        *[F.element_at("quantiles", i + 1).alias(name) for i, name in enumerate(("q25", "q50", "q75"))],
    )
    reach = F.lit(1.5) * (F.col("q75") - F.col("q25"))
    within = F.col("value").between(F.col("q25") - reach, F.col("q75") + reach)
    boxes = F.broadcast(q)  # classes x columns rows
    return (
        long.join(boxes, [label, "column"])
        .groupBy(label, "column", "n", "q25", "q50", "q75")
        .agg(
            F.min(F.when(within, F.col("value"))).alias("whisker_low"),
            F.max(F.when(within, F.col("value"))).alias("whisker_high"),
            F.count_if(~within).alias("n_outliers"),
        )
    )


def chi_square(
    df: DataFrame, columns: Sequence[str], label: str, classes: Sequence, yates: bool = True
) -> DataFrame:
    """Independence of each column and the class: statistic, degrees of freedom, p-value.

    With ``yates`` a 2x2 table gets the continuity correction. Counts per category carry one
    column per class, so row totals need no second grouping; class totals are a few rows.
    The counts are staged: both uses read them instead of the source.
    """
    names = [f"_o{i}" for i in range(len(classes))]
    rows = stage_table(stack_counts(df, columns, label, classes, names), "contingency")
    per_column = rows.groupBy("column").agg(
        F.count("*").alias("_rows"), F.sum("_row").alias("_all"), *[F.sum(n).alias(f"{n}_all") for n in names]
    )
    cells = rows.join(F.broadcast(per_column), "column")
    used = sum((F.when(F.col(f"{n}_all") > 0, 1).otherwise(0) for n in names), F.lit(0))
    small = (F.col("_rows") == 2) & (used == 2)
    terms = F.lit(0.0)
    for n in names:
        expected = F.col("_row") * F.col(f"{n}_all") / F.col("_all")
        distance = F.abs(F.col(n) - expected)
        if yates:
            distance = F.when(small, distance - F.least(F.lit(0.5), distance)).otherwise(distance)
        terms = terms + F.when(expected > 0, distance * distance / expected).otherwise(F.lit(0.0))
    tests = cells.groupBy("column").agg(
        F.sum(terms).alias("chi2"),
        ((F.max("_rows") - 1) * (F.max(used) - 1)).cast("long").alias("dof"),
        F.max("_all").alias("n"),
    )
    log_p = chi_square_log_p(F.col("chi2"), F.col("dof"))
    return tests.withColumn("log_p", log_p).withColumn("p_value", F.exp("log_p"))


def stack_counts(df, columns, label, classes, names) -> DataFrame:
    """Counts per (column, value) with one output column per class and their row total."""
    long = (
        df.filter(F.col(label).isin(*classes))
        .select(F.col(label).alias("_label"), *[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot(["_label"], list(columns), "column", "value")
        .dropna(subset=["value"])
    )
    counts = long.groupBy("column", "value").agg(
        *[F.count_if(F.col("_label") == c).alias(n) for c, n in zip(classes, names)]
    )
    return counts.withColumn("_row", sum((F.col(n) for n in names), F.lit(0)))
