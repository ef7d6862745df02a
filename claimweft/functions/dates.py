"""Dates: lenient parsing, month buckets, ages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# shape of the date part -> format to parse it with
DATE_SHAPES = (
    (r"\d{4}-\d\d-\d\d", "yyyy-MM-dd"),
    (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
    (r"\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"),
    (r"\d{1,2}-\d{1,2}-\d{4}", "M-d-yyyy"),
    (r"\d{1,2}-[A-Za-z]{3}-\d{4}", "d-MMM-yyyy"),
    (r"\d{1,2}-[A-Za-z]{3}-\d{2}", "d-MMM-yy"),
    (r"[A-Za-z]{3} \d{1,2}, ?\d{4}", "MMM d,yyyy"),
    (r"\d{8}", "yyyyMMdd"),
)
# optional time of day after the date: seconds, fraction, AM or PM and zone may be missing
TIME_SHAPE = r"([ T]+([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d([.,]\d+)?)?( ?[AaPp][Mm])?( ?(Z|UTC|[+-]\d\d:?\d\d))?)?"


def lenient_date(col: Column, shapes: Sequence[tuple[str, str]] = DATE_SHAPES) -> Column:
    """Date of the first shape that fits and parses; ``'0'``, blanks and junk give NULL.

    A time of day is checked for its shape and left out; a two-digit year is of this century. The shape test keeps the
    parser, whose failures are costly, off text it cannot read.
    """
    text = F.trim(col.cast("string"))

    def parsed(shape: str, fmt: str) -> Column:
        date = F.replace(F.regexp_extract(text, f"^({shape})", 1), F.lit(", "), F.lit(","))
        return F.when(text.rlike(f"^{shape}{TIME_SHAPE}$"), F.to_date(F.try_to_timestamp(date, F.lit(fmt))))

    return F.coalesce(*[parsed(shape, f) for shape, f in shapes])


def unparsed_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_unparsed): texts that are neither blank nor ``'0'`` and give no date."""
    text = {c: F.trim(F.col(c).cast("string")) for c in columns}
    lost = [F.count_if((t != "") & (t != "0") & lenient_date(t).isNull()).alias(c) for c, t in text.items()]
    return df.agg(*lost).unpivot([], list(columns), "column", "n_unparsed")


def month_of(col: Column) -> Column:
    """First day of the month."""
    return F.trunc(col, "month")


def month_label(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def age_years(at: Column, born: Column) -> Column:
    """Completed years between two dates; month ends count as whole months."""
    return F.floor(F.months_between(at, born) / 12)


def under_age(at: Column, born: Column, years: int = 65) -> Column:
    """TRUE below the age, and for an unknown birth date."""
    return born.isNull() | (age_years(at, born) < years)


def days_since(as_of: Column, col: Column) -> Column:
    return F.datediff(as_of, col)
