"""Decoding of ``K=V;`` indicator strings and conditional overwrites."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (text looked for, label given), first match wins.
INDICATOR_RULES: dict[str, tuple[tuple[str, str], ...]] = {
    "adj": (("ADJ=Y;", "ADJ=Y;"), ("ADJ=N;", "ADJ=N;")),
    "bmp": (("BMP=E;", "E"), ("BMP=EN;", "EN"), ("BMP=EY;", "EY"), ("BMP=N;", "N"), ("BMP=O;", "O")),
    "fser": (("FSER=F;", "FSER=F"),),
    "cfr": (
        ("CFR=E401;", "CFR=E401"), ("CFR=E404;", "CFR=E404"),
        ("CFR=E411;", "CFR=E411"), ("CFR=E416;", "CFR=E416"),
    ),
    "mrb": (
        ("MRB=EF;", "E"), ("MRB=EN;", "EN"), ("MRB=EY;", "EY"),
        ("MRB=EYCN;", "EYCN"), ("MRB=EYCY;", "EYCY"), ("MRB=NN;", "NN"),
    ),
    "otp": (("OTP=E;", "OTP=E"), ("OTP=EN;", "OTP=EN"), ("OTP=EY;", "OTP=EY"), ("OTP=N;", "OTP=N")),
    "waf": (("WAF=Y;", "WAF=Y"), ("WAF=N;", "WAF=N")),
}


def first_match(
    col: Column, rules: Sequence[tuple[str, str]], default: str = "NA", strict_compat: bool = False
) -> Column:
    """Label of the first rule whose text occurs in the column.

    NULL gives ``default``; with ``strict_compat`` it gives the first label instead,
    which is what the older reports contain.
    """
    if strict_compat:
        decoded = F.when(col.isNull(), F.lit(rules[0][1]))
        rest = rules
    else:
        decoded = F.when(col.contains(rules[0][0]), F.lit(rules[0][1]))
        rest = rules[1:]
    for needle, label in rest:
        decoded = decoded.when(col.contains(needle), F.lit(label))
    return decoded.otherwise(F.lit(default))


def decode_indicator(
    col: Column,
    prefix: str = "claim_indicator_",
    rules: Mapping[str, Sequence[tuple[str, str]]] = INDICATOR_RULES,
    strict_compat: bool = False,
) -> dict[str, Column]:
    """One derived column per indicator, ready for ``withColumns``."""
    return {
        f"{prefix}{name}": first_match(col, pairs, strict_compat=strict_compat)
        for name, pairs in rules.items()
    }


def remap(col: Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed codes, leave the others."""
    out = col
    for old, new in mapping.items():
        out = F.when(col == old, F.lit(new)).otherwise(out)
    return out


def overwrite_where_contains(col: Column, needle: str, replacement: Column) -> Column:
    """Take ``replacement`` where the text contains ``needle`` (any case) and it is known."""
    hit = F.lower(col).contains(needle.lower()) & replacement.isNotNull()
    return F.when(hit, replacement).otherwise(col)
