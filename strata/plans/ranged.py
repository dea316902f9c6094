"""A fact in date-range directories, and a reader that prunes them by date.

Spark prunes directories by the partition column only; a filter on the date the ranges
were cut by would read them all.  The table therefore keeps its ranges beside the data,
and the reader turns bounds on the date into the range labels they can touch.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Range partitions of the fact by order date, as declared for large fact tables:
# below 2024-01-01, below 2025-01-01, everything else (a NULL date included).
ORDER_DATE_RANGES = (("p_2023", "2024-01-01"), ("p_2024", "2025-01-01"))
LAST_RANGE = "p_2025"
LABEL = "order_range"
_BESIDE = "_ranges"


@dataclass(frozen=True)
class Ranges:
    """Labels with exclusive upper bounds, rising; ``last`` holds the rest and NULL dates."""

    column: str = "order_date"
    bounds: tuple = ORDER_DATE_RANGES
    last: str = LAST_RANGE

    def __post_init__(self):
        days = [dt.date.fromisoformat(b) for _, b in self.bounds]
        labels = [label for label, _ in self.bounds] + [self.last]
        if sorted(set(days)) != days or len(set(labels)) != len(labels):
            raise ValueError("range bounds must rise and labels differ")

    def label(self, c: Column) -> Column:
        out = F.lit(self.last)
        for label, upper in reversed(self.bounds):
            out = F.when(c < F.lit(upper).cast("date"), F.lit(label)).otherwise(out)
        return out

    def touched(self, start: str | None, end: str | None) -> list[str]:
        """Labels of the ranges that hold dates in [start, end)."""
        lowers = [None, *[b for _, b in self.bounds]]
        uppers = [*[b for _, b in self.bounds], None]
        labels = [*[label for label, _ in self.bounds], self.last]
        return [label for label, lo, hi in zip(labels, lowers, uppers, strict=True)
                if (end is None or lo is None or lo < end) and (start is None or hi is None or start < hi)]


def write_ranged(df: DataFrame, path: str, ranges: Ranges = Ranges()) -> int:
    """Write into one directory per range; returns the rows written.

    No shuffle by label: a label can hold a third of all rows, so every task writes its
    own rows into the label directories.
    """
    obs = Observation()
    (df.withColumn(LABEL, ranges.label(F.col(ranges.column))).observe(obs, F.count(F.lit(1)).alias("rows"))
       .write.mode("overwrite").partitionBy(LABEL).parquet(path))
    text = json.dumps({"column": ranges.column, "bounds": ranges.bounds, "last": ranges.last})
    df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{_BESIDE}")
    return int(obs.get["rows"])


class RangedTable:
    """A table written by :func:`write_ranged`."""

    def __init__(self, spark: SparkSession, path: str):
        kept = json.loads(spark.read.text(f"{path}/{_BESIDE}").first()["value"])
        self.ranges = Ranges(kept["column"], tuple(tuple(b) for b in kept["bounds"]), kept["last"])
        self.rows = spark.read.parquet(path)

    def between(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Rows with a date in [start, end); an open side is None.  Only directories that can hold such
        dates are read."""
        start, end = (str(dt.date.fromisoformat(x)) if x is not None else None for x in (start, end))
        day = F.col(self.ranges.column)
        keep = F.col(LABEL).isin(self.ranges.touched(start, end)) & day.isNotNull()
        if start is not None:
            keep &= day >= F.lit(start).cast("date")
        if end is not None:
            keep &= day < F.lit(end).cast("date")
        return self.rows.where(keep)

    def undated(self) -> DataFrame:
        """Rows without a date: they are in the last range."""
        return self.rows.where((F.col(LABEL) == self.ranges.last) & F.col(self.ranges.column).isNull())
