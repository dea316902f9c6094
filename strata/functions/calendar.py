"""Calendar expressions used by the time-based reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_month(c) -> Column:
    """'yyyy-MM' text of a date (NULL stays NULL)."""
    return F.date_format(c, "yyyy-MM")


def weekday_name(c) -> Column:
    """Full English day name, not blank-padded."""
    return F.date_format(c, "EEEE")


def weekday_number(c) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(c).cast("bigint")


def year_of(c) -> Column:
    return F.year(c).cast("bigint")
