"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweft.session import stage_table

__all__ = ["fresh", "kth_largest", "pieces_of", "ship_package", "stage_table", "table", "with_row_key"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once for an application.

    The archive is made in the driver's temporary folder and handed out by Spark itself.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        base = os.path.join(tempfile.mkdtemp(prefix="claimweft-"), "claimweft-package")
        sc.addPyFile(shutil.make_archive(base, "zip", top, "claimweft"))
        _shipped.add(sc.applicationId)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that no column of ``df`` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def with_row_key(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """128 bits of the given columns (default all) as text: the same for equal rows only.

    Nulls, empty texts and neighbouring values cannot run into each other: every value goes
    in with its length, a null as a mark of its own.
    """
    parts = []
    for c in columns or df.columns:
        text = F.to_json(F.struct(F.col(f"`{c}`").alias("v")))
        parts += [F.length(text).cast("string"), F.lit(":"), text]
    return df.withColumn(name, F.md5(F.concat(*parts)))


def pieces_of(sizes: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to about ``limit``; a larger one stands alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def kth_largest(df: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a long column, null if there are fewer rows than k or k < 1.

    Four counts over the leading 16, 32, 48 and 64 bits, each only inside the bracket of the
    one before, so no rows are sorted or gathered; the driver sees at most 65,536 counts.
    """
    if k < 1:
        return None
    inside = df.select(F.col(column).alias("v"))
    left = k
    for shift in (48, 32, 16, 0):
        counts = inside.groupBy(F.shiftright("v", shift).alias("p")).count().collect()
        for row in sorted(counts, key=lambda r: -r.p):
            if row["count"] >= left:
                break
            left -= row["count"]
        else:
            return None
        inside = inside.filter(F.shiftright("v", shift) == row.p)
    return row.p
