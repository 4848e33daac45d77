"""Aggregate and ratio helpers with explicit zero / NULL behaviour.

Ratios and averages are computed in double precision from exact sums:
``sum`` keeps the input type (exact for decimals), the quotient is double.
Unguarded divisions give NULL on a zero denominator (the non-ANSI Spark result)
instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den in double; NULL when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def guarded_ratio(num: Column | str, den: Column | str, when: Column, otherwise: float = 0.0) -> Column:
    """``num / den`` where ``when`` holds, else a constant (NULL condition -> constant)."""
    return F.when(when, ratio(num, den)).otherwise(F.lit(otherwise))


def mean(col: Column | str) -> Column:
    """Average of non-NULL values: exact sum, then one double division."""
    c = _c(col)
    return F.try_divide(F.sum(c).cast("double"), F.count(c))
