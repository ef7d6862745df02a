"""Stacking of tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def side_by_side(parts: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    """Columns of several aligned tables next to each other, matched by key."""
    return reduce(lambda a, b: a.join(b, on), parts)


def stack(parts: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all parts, columns matched by name; absent columns become NULL on request."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), parts)
