"""Distribution functions built from column expressions, for small result tables."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _log_gamma(x: Column) -> Column:
    """ln gamma(x) for x > 0: Stirling's series at x + 8, taken back eight steps."""
    up = x + 8
    series = 1 / (12 * up) - 1 / (360 * up**3) + 1 / (1260 * up**5) - 1 / (1680 * up**7)
    stirling = (up - 0.5) * F.log(up) - up + F.lit(0.5 * math.log(2 * math.pi)) + series
    steps = F.log(x)
    for i in range(1, 8):
        steps = steps + F.log(x + i)
    return stirling - steps


def chi_square_log_p(statistic: Column, dof: Column) -> Column:
    """ln of the chance of a chi-square value at least this large, exact far out in the tail.

    Below the mean, one minus the series of the lower incomplete gamma function; above it, the
    continued fraction of the upper one. Both are kept near 1 and scaled in logarithms, so neither
    overflows; the number of steps grows with the square root of the degrees of freedom.
    """
    a = dof.cast("double") / 2
    x = statistic / 2
    log_scale = a * F.log(x) - x - _log_gamma(a)
    steps = F.sequence(F.lit(1).cast("long"), F.ceil(F.sqrt(a) * 12 + 200).cast("long"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] * x / (a + i)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    one = F.lit(1.0)
    series = F.aggregate(steps, F.struct(one.alias("term"), one.alias("total")), add, lambda acc: acc["total"])
    lower = F.exp(log_scale - F.log(a)) * series

    def fraction(acc: Column, i: Column) -> Column:
        an = -i * (i - a)
        b = x + 1 - a + i * 2
        d = one / (an * acc["d"] + b)
        c = b + an / acc["c"]
        return F.struct(c.alias("c"), d.alias("d"), (acc["h"] * c * d).alias("h"))

    first = one / (x + 1 - a)
    start = F.struct(F.lit(1e300).alias("c"), first.alias("d"), first.alias("h"))
    upper = log_scale + F.log(F.aggregate(steps, start, fraction, lambda acc: acc["h"]))
    below = F.log1p(-F.least(lower, F.lit(1.0 - 1e-16)))
    value = F.when(x < a + 1, below).otherwise(upper)
    return F.when((dof <= 0) | (statistic <= 0), F.lit(0.0)).otherwise(value)


def chi_square_p_value(statistic: Column, dof: Column) -> Column:
    """Chance of a chi-square value at least this large."""
    return F.exp(chi_square_log_p(statistic, dof))
