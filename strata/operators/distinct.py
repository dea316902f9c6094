"""Several exact distinct counts per group without copying every row for each.

Spark plans two or more ``COUNT(DISTINCT …)`` as an Expand: each row once per count, with all
the keys side by side.  Here each count reads its own two columns, folds equal (group, key)
pairs on the map side and counts what is left; a columnar table is read about once in all, and
the shuffle holds narrow pairs only.  Meant for stored tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, group: Mapping[str, Column], keys: Mapping[str, str], measures: Sequence[Column] = ()) -> DataFrame:
    """One row per group: the group columns, the distinct non-NULL values of each of ``keys``
    (result name -> column) and the aggregates ``measures`` (aliased)."""
    by, names = list(group), list(keys)
    head = df.groupBy(*[c.alias(n) for n, c in group.items()]).agg(*(measures or [F.count(F.lit(1)).alias("_rows")]))
    values = [c for c in head.columns if c not in by]
    empty = {c: F.lit(None).cast(head.schema[c].dataType) for c in values}
    zero = F.lit(0).cast("bigint")
    out = head.select(*by, *values, *[zero.alias(n) for n in names])
    for name, key in keys.items():
        pairs = df.where(F.col(key).isNotNull()).select(*[c.alias(n) for n, c in group.items()], F.col(key).alias("_key")).distinct()
        counted = pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
        out = out.unionByName(counted.select(*by, *[empty[c].alias(c) for c in values], *[(F.col("_n") if n == name else zero).alias(n) for n in names]))
    # a row per group and count: folded into one row per group
    folded = out.groupBy(*by).agg(*[F.max(c).alias(c) for c in values], *[F.max(n).alias(n) for n in names])
    return folded if measures else folded.drop("_rows")
