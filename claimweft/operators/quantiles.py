"""Exact quantiles without gathering a column in one task.

``percentile`` keeps every distinct value of a group in one task's memory. Here a bounded
sketch first brackets each wanted rank; the rows inside the brackets are then counted by
value, everything outside collapses to one cell per gap with its count, minimum and maximum, and
the exact order statistics are read off the running counts. Counts run in two steps, over
at most ``BINS`` equal ranges of each bracket and inside a range, so a column is never ordered in one
task. Groups of every size take the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A bracket holds about 8 rows per ACCURACY rows of its group.
ACCURACY = 50_000
# Ranges of a bracket.
BINS = 1024


def stack_numeric(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, column, value) rows of the numeric columns, NULLs left out."""
    numeric = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return numeric.unpivot(list(keys), list(columns), "column", "value").dropna(subset=["value"])


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    label: str | None = None,
    classes: Sequence = (),
    extra: Mapping[str, Column] | None = None,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per column (and class) with its count ``n`` and ``quantiles`` in the order of ``probs``.

    Linear interpolation between neighbours, as data-frame libraries do. With a ``label``,
    quantiles are per listed class. Columns and classes are named up front, which bounds the
    brackets that are broadcast. ``extra`` aggregates (over ``value``) are computed in the sketch
    pass, so a summary needs no scan of its own for them.
    """
    extra = extra or {}
    value, carried = "value", ["_n", *extra]
    keys = ["column"] if label is None else [label, "column"]
    rows = df if label is None else df.filter(F.col(label).isin(*classes))
    long = stack_numeric(rows, columns, keys[:-1])
    half = 4.0 / accuracy
    order = sorted(range(len(probs)), key=lambda i: probs[i])
    edges = [e for i in order for e in (max(0.0, probs[i] - half), min(1.0, probs[i] + half))]
    sketch = long.groupBy(*keys).agg(
        F.percentile_approx(value, [float(e) for e in edges], accuracy).alias("_edges"),
        F.count(value).alias("_n"),
        *[c.alias(name) for name, c in extra.items()],
    )
    v = F.col(value)
    lows = [F.element_at("_edges", 2 * i + 1) for i in range(len(probs))]
    highs = [F.element_at("_edges", 2 * i + 2) for i in range(len(probs))]
    inside = F.lit(False)
    gap: Column = F.lit(0)
    for low, high in zip(lows, highs):
        inside = inside | v.between(low, high)
        gap = gap + (v > high).cast("int")
    # the gap with number g lies before the bracket with number g
    low, high = F.element_at("_edges", 2 * gap + 1), F.element_at("_edges", 2 * gap + 2)
    part = F.when(high > low, F.least(F.floor((v - low) / (high - low) * BINS), F.lit(BINS - 1)))
    cells = (
        long.join(F.broadcast(sketch), list(keys))
        .groupBy(
            *keys, *carried, gap.alias("_gap"),
            F.when(inside, F.coalesce(part, F.lit(0))).otherwise(F.lit(-1)).cast("int").alias("_bin"),
            F.when(inside, v).alias("_inside"),
        )
        .agg(F.count("*").alias("_c"), F.min(v).alias("_v"), F.max(v).alias("_top"))
    )
    before = Window.partitionBy(*keys).orderBy("_gap", "_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.groupBy(*keys, "_gap", "_bin").agg(F.sum("_c").alias("_c")).select(
        *keys, "_gap", "_bin", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_offset")
    )
    running = Window.partitionBy(*keys, "_gap", "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ordered = cells.join(offsets, [*keys, "_gap", "_bin"]).withColumn("_cum", F.col("_offset") + F.sum("_c").over(running))

    def order_statistic(index: Column) -> Column:
        first = F.col("_cum") - F.col("_c")
        here = (first <= index) & (index < F.col("_cum"))
        # a rank just outside its bracket is an end of the gap
        known = F.when(index == first, F.col("_v")).when(index == F.col("_cum") - 1, F.col("_top"))
        lost = F.raise_error(F.lit("quantile rank outside its bracket; raise the accuracy"))
        return F.min(F.when(here, F.when(F.col("_inside").isNotNull(), F.col("_v")).otherwise(F.coalesce(known, lost))))

    results = []
    for i, p in enumerate(probs):
        position = (F.col("_n") - 1) * F.lit(float(p))
        low = order_statistic(F.floor(position))
        high = order_statistic(F.ceil(position))
        results.append((low + (high - low) * (position - F.floor(position))).alias(f"_q{i}"))
    return (
        ordered.groupBy(*keys, *carried)
        .agg(*results)
        .select(
            *keys, F.col("_n").alias("n"), *extra,
            F.array(*[f"_q{i}" for i in range(len(probs))]).alias("quantiles"),
        )
    )


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, median) rows."""
    q = exact_quantiles(df, columns, [0.5])
    return q.select("column", F.element_at("quantiles", 1).alias("median"))
