"""Text and number clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blank-like tokens the reporting files use for a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def null_tokens(col: Column, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """Turn the listed tokens into NULL."""
    return F.when(~col.isin(*tokens), col)


def strip_delimiter(col: Column, delimiter: str = "|") -> Column:
    return F.replace(col, F.lit(delimiter), F.lit(""))


def strip_non_word(col: Column) -> Column:
    """Drop everything but letters, digits and underscore, accented letters kept."""
    return F.regexp_replace(col, r"(?U)\W", "")


def strip_space(col: Column) -> Column:
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def normalise_key(col: Column) -> Column:
    """Join key form of a code: no outer white space, lower case."""
    return F.lower(strip_space(col))


def zip3(col: Column) -> Column:
    """First three digits of a postal code, leading zeros restored.

    A code that went through a float (``2139.0``) or carries a suffix (``30301-1234``)
    is cut to its five-digit part first.
    """
    five = F.lpad(F.regexp_replace(col.cast("string"), r"[.]0$|-.*$", ""), 5, "0")
    return F.substring(five, 1, 3)


def to_number(col: Column) -> Column:
    """Number, or NULL for text that is not one."""
    return col.try_cast("double")


def is_text(col: Column, expected: str) -> Column:
    """1 when the trimmed upper-case text equals ``expected``; NULL counts as 0."""
    return F.coalesce((F.upper(strip_space(col)) == F.lit(expected.upper())).cast("int"), F.lit(0))


def paid_flag(col: Column) -> Column:
    """1 for any spelling of PAID; NULL counts as 0."""
    return F.coalesce((F.upper(col) == "PAID").cast("int"), F.lit(0))


def has_code(col: Column, *codes) -> Column:
    """Whether a code column holds one of the codes, NULL for NULL.

    Whole-number codes match however the column spells them (``2004``, ``'2004'``, ``'2004.0'``);
    text that is no number matches none of them. Text codes are compared as text.
    """
    numbers = [c for c in codes if isinstance(c, int)]
    texts = [c for c in codes if not isinstance(c, int)]
    hit = F.lit(False)
    if numbers:
        number = strip_space(col.cast("string")).try_cast("double")
        hit = hit | F.coalesce(number.isin(*[float(c) for c in numbers]), F.lit(False))
    if texts:
        hit = hit | col.cast("string").isin(*texts)
    return F.when(col.isNotNull(), hit)


def differs_or_null(col: Column, value) -> Column:
    """``!=`` that keeps NULL rows, as data-frame libraries do and SQL does not."""
    return ~F.equal_null(col, F.lit(value))


def null_or_not_like(col: Column, *patterns: str, ignore_case: bool = False) -> Column:
    """TRUE for NULL and for text matching none of the LIKE patterns."""
    probe = F.upper(col) if ignore_case else col
    keep = F.lit(True)
    for pattern in patterns:
        keep = keep & ~probe.like(pattern)
    return col.isNull() | keep
