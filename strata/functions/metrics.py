"""Money and ratio helpers for reports.

Amounts are summed as decimals (exact, independent of the order rows arrive
in) and only the finished figure is handed out as a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(c) -> Column:
    """Exact decimal sum, reported as double."""
    return F.sum(c).cast("double")


def mean(c) -> Column:
    """Average as exact decimal sum divided by the non-null count."""
    return (F.sum(c).cast("double") / F.count(c))


def rounded(c: Column, digits: int = 2) -> Column:
    """Half-away-from-zero rounding of a decimal expression, reported as double."""
    return F.round(c, digits).cast("double")


def ratio(num: Column, den: Column, digits: int | None = 2) -> Column:
    """num / den with a zero guard (NULL when den is 0 or NULL)."""
    q = num / F.nullif(den, F.lit(0))
    return rounded(q, digits) if digits is not None else q.cast("double")


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")
