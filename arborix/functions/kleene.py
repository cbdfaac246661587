"""Three-valued logic on 0 (FALSE), 1 (UNKNOWN), 2 (TRUE): OR is the maximum, AND the minimum (EVAL-1, EVAL-2, S1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

FALSE, UNKNOWN, TRUE = 0, 1, 2
OPERATORS = (">", ">=", "<", "<=", "==", "=")


def any_of(trits: list[Column]) -> Column:
    return reduce(lambda a, b: F.greatest(a, b), trits) if trits else F.lit(FALSE)


def all_of(trits: list[Column]) -> Column:
    return reduce(lambda a, b: F.least(a, b), trits) if trits else F.lit(TRUE)


def any_agg(trit: Column) -> Column:
    return F.coalesce(F.max(trit), F.lit(FALSE))


def all_agg(trit: Column) -> Column:
    return F.coalesce(F.min(trit), F.lit(TRUE))


def name(trit: Column) -> Column:
    return F.when(trit == TRUE, "TRUE").when(trit == FALSE, "FALSE").otherwise("UNKNOWN")


def compare(left: Column, op: str, right: Column) -> Column:
    """EVAL-4: false on NaN (S16)."""
    if op not in OPERATORS:
        raise ValueError(f"unsupported operator: {op}")
    found = {">": left > right, ">=": left >= right, "<": left < right, "<=": left <= right, "==": left == right, "=": left == right}[op]
    return found & ~F.isnan(left) & ~F.isnan(right)
