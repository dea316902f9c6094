"""Latest-record deduplication.

``row_number() = 1`` over a key is planned by Spark as a partial
WindowGroupLimit *before* the shuffle and a final one after it, so every map
task forwards at most one row per key: a key holding a third of all rows costs
one row per map task in the exchange, not a third of the data in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RN = "_rn"


def _order_spec(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                tie_break: Sequence[str] | None) -> list[Column]:
    # ties are broken by the non-key columns so the winner is deterministic
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in set(keys)]
    return [*order, *[F.col(c).asc_nulls_last() for c in tie_break]]


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], *,
                 tie_break: Sequence[str] | None = None, drop_null_keys: bool = True) -> DataFrame:
    """Keep the first row per key in ``order`` (e.g. ``[desc_nulls_first(date)]``).

    NULL keys are removed before the shuffle when ``drop_null_keys``.
    """
    src = df
    if drop_null_keys:
        for k in keys:
            src = src.filter(F.col(k).isNotNull())
    w = Window.partitionBy(*keys).orderBy(*_order_spec(df, keys, order, tie_break))
    return src.withColumn(RN, F.row_number().over(w)).filter(F.col(RN) == 1).drop(RN)


def superseded(df: DataFrame, keys: Sequence[str], order: Sequence[Column], *,
               tie_break: Sequence[str] | None = None) -> DataFrame:
    """Rows that lose to a newer row of the same key (rank ≠ 1), as a multiset.

    Built so that no key and no group of identical rows lands in one task:
    copies are folded into one row with a count, the winner of each key comes
    from the map-side-limited dedup over the folded rows, one copy of each
    winner is subtracted in a join on the whole row (hash-partitioned by the
    whole row, not by the key), and the remaining copies are expanded again in
    bounded chunks spread over tasks.
    """
    from .ordering import _COPY, _N, expand_copies, fold_copies

    cols = df.columns
    folded = fold_copies(df)
    winners = dedup_latest(folded.drop(_N), keys, order, tie_break=tie_break, drop_null_keys=False)
    marked = winners.select(*[F.col(c).alias(f"_w_{c}") for c in cols], F.lit(1).alias("_won"))
    same_row = None
    for c in cols:
        eq = F.col(c).eqNullSafe(F.col(f"_w_{c}"))
        same_row = eq if same_row is None else (same_row & eq)
    left = folded.join(marked, same_row, "left")
    remaining = F.col(_N) - F.coalesce(F.col("_won"), F.lit(0))
    rest = left.filter(remaining > 0).select(*cols, remaining.alias(_N))
    return expand_copies(rest).drop(_COPY)
