"""Data-quality checks as ordinary DataFrame operators.

Each check has a row-level form (the offending rows or keys) and most have a
count form.  Counts are single global aggregates (partial per task, one tiny
final merge); per-table results are stacked with ``unionByName``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleanse as C
from ..functions import metrics as M


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, and the NULL key: ``(keys…, row_count)``."""
    null_key = C.any_of([F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
              .filter((F.col("row_count") > 1) | null_key))


def untrimmed_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, column_name, violations)`` for every text column: values
    with leading or trailing blanks.  One pass per table."""
    parts = []
    for name, df in tables.items():
        cols = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
        if not cols:
            continue
        agg = df.agg(*[M.count_if(C.untrimmed(c)).alias(c) for c in cols])
        long = agg.unpivot([], cols, "column_name", "violations")
        parts.append(long.select(F.lit(name).alias("table_name"), "column_name", "violations"))
    return _stack(parts)


def domain_values(tables: Mapping[str, Sequence[str]], frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, column_name, value)``: the distinct values of code columns."""
    parts = []
    for name, cols in tables.items():
        for c in cols:
            parts.append(frames[name].select(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                                             F.col(c).cast("string").alias("value")).distinct())
    return _stack(parts)


def null_or_negative(df: DataFrame, col: str, keep: Sequence[str]) -> DataFrame:
    return df.filter(F.col(col).isNull() | (F.col(col) < 0)).select(*keep)


def outside(df: DataFrame, col: str, low, high) -> DataFrame:
    """Rows with ``col`` before ``low`` or after ``high`` (NULLs are not flagged)."""
    c = F.col(col)
    return df.filter((c < low) | (c > high))


def out_of_order(first: str, *later: str) -> Column:
    """Condition: ``first`` after any of ``later``."""
    return C.any_of([F.col(first) > F.col(x) for x in later])


def invalid_int_date(col: str, ceiling: int) -> Column:
    """yyyymmdd integers that cannot be a date: ≤ 0, not 8 digits, or out of bounds."""
    c = F.col(col)
    return (c <= 0) | (F.length(c.cast("string")) != 8) | (c > ceiling)


def run_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """``(check_name, violations)`` of many row conditions in one pass over ``df`` (NULL is no violation)."""
    names = list(checks)
    counts = df.agg(*[F.coalesce(M.count_if(checks[n]), F.lit(0).cast("bigint")).alias(f"c{i}") for i, n in enumerate(names)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(names)])))


def orphan_summary(relations: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``(relation, orphan_rows, orphan_keys)``: keys ``k`` of the left side without one on the right.

    The keys of all relations and sides are tagged and grouped once, counts combined on the map side:
    a key that holds a third of the rows is one row per task in the shuffle.  A NULL left key is an
    orphan row (its relation cannot be resolved) and no key.
    """
    sides = []
    for name, (left, right) in relations.items():
        sides.append(left.select(F.lit(name).alias("relation"), "k", F.lit(1).alias("l"), F.lit(0).alias("r")))
        sides.append(right.where("k is not null").select(F.lit(name).alias("relation"), "k", F.lit(0).alias("l"), F.lit(1).alias("r")))
    per_key = _stack(sides).groupBy("relation", "k").agg(F.sum("l").alias("n"), F.max("r").alias("known"))
    orphan = F.col("known") == 0
    return per_key.groupBy("relation").agg(F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
                                           F.count(F.when(orphan & (F.col("n") > 0), F.col("k"))).alias("orphan_keys"))


def amount_inconsistent(sales: str, qty: str, price: str, full: bool = True) -> Column:
    """sales ≠ qty × price, or any part NULL or not positive (``full``); the short
    form checks the sales amount only."""
    s, q, p = F.col(sales), F.col(qty), F.col(price)
    conds = [s != q * p, s.isNull(), s <= 0]
    if full:
        conds += [q.isNull(), p.isNull(), q <= 0, p <= 0]
    return C.any_of(conds)


def fanout(joined: DataFrame, key: str) -> DataFrame:
    """Keys that a join multiplied: ``(key, row_count)`` with more than one row."""
    return (joined.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
                  .filter(F.col("row_count") > 1))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``, one global count per table, stacked."""
    return _stack([df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()])


def monitor(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``(table_name, row_count, duplicate_keys, null_keys)`` per table."""
    parts = []
    for name, (df, keys) in tables.items():
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        null_key = C.any_of([F.col(k).isNull() for k in keys])
        parts.append(per_key.agg(
            F.sum("_n").cast("bigint").alias("row_count"),
            M.count_if((F.col("_n") > 1) & ~null_key).alias("duplicate_keys"),
            F.sum(F.when(null_key, F.col("_n")).otherwise(F.lit(0))).cast("bigint").alias("null_keys"),
        ).select(F.lit(name).alias("table_name"), F.coalesce("row_count", F.lit(0)).alias("row_count"),
                 F.coalesce("duplicate_keys", F.lit(0)).alias("duplicate_keys"),
                 F.coalesce("null_keys", F.lit(0)).alias("null_keys")))
    return _stack(parts)


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
