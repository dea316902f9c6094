"""Ordered operators that must not collapse into one task.

``ROW_NUMBER() OVER (ORDER BY …)`` without a partition is planned by Spark as
an ``Exchange SinglePartition``: every row in one task.  ``LEAD`` over a key
sends each key to one task, so a hot key does the same.  Both are rebuilt here
from distributed pieces:

1. exact copies are folded into one row with a count (map-side combined), so
   a group of copies, however large, is one row while sorting;
2. the distinct rows are range-sorted on the order plus every column as tie
   break (Spark samples the range bounds; distinct sort keys always split);
3. copies are expanded again in bounded chunks spread over tasks;
4. each sorted row is tagged with its range partition and its position in
   it, and the tagged rows are written once as a table in the shared
   checkpoint folder: that cuts the lineage (a later read never re-samples
   the range bounds, also not after an executor is lost) and, unlike an eager
   ``checkpoint()``, does not compute the sort twice;
5. a row's number = rows in earlier partitions (a table with one row per
   partition, broadcast) + its position inside its partition.

``lead_within`` then joins each numbered row to the row numbered one higher —
an equi-join on a unique integer, i.e. perfectly balanced.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .joins import broadcast_if_small

COPY_CHUNK = 1_000_000  # rows one task expands from one group of copies

_N, _COPY, _CHUNK, _PID, _MID, _OFF, _CNT = "_n", "_copy", "_chunk", "_pid", "_mid", "_off", "_cnt"


def fold_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with their multiplicity in ``_n`` (map-side combined)."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(_N))


def expand_copies(folded: DataFrame, count_col: str = _N, copy_col: str = _COPY,
                  chunk: int = COPY_CHUNK) -> DataFrame:
    """Inverse of :func:`fold_copies`; each output row carries its copy index.

    Rows with one copy pass straight through.  A larger group is first cut into
    chunk descriptors (a handful of rows), which are hash-spread over tasks
    before each expands at most ``chunk`` rows.
    """
    cnt, part = F.col(count_col), _CHUNK
    while part in folded.columns:
        part += "_"
    single = folded.filter(cnt == 1).withColumn(copy_col, F.lit(1).cast("bigint")).drop(count_col)
    chunks = (folded.filter(cnt > 1)
              .withColumn(part, F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                       F.floor((cnt - 1) / chunk).cast("bigint")))))
    spread = chunks.repartition(*[F.col(c) for c in chunks.columns])
    first = F.col(part) * chunk + 1
    last = F.least(cnt, (F.col(part) + 1) * chunk)
    multi = (spread.withColumn(copy_col, F.explode(F.sequence(first, last)))
             .drop(part, count_col))
    return single.unionByName(multi)


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """Dense 1..n numbering of all rows of ``df`` in ``order`` (ties: all columns).

    Equals ``row_number() OVER (ORDER BY order, <all columns>)`` and keeps every
    input row (copies get consecutive numbers).
    """
    spark = df.sparkSession
    cols = df.columns
    expanded = expand_copies(fold_copies(df))
    # every column is a tie break, so the order (and each row's position) is total
    ordered = expanded.orderBy(*order, *[F.col(c).asc_nulls_last() for c in cols], F.col(_COPY))
    tagged = ordered.select(*cols, F.spark_partition_id().alias(_PID),
                            F.monotonically_increasing_id().alias(_MID))
    path = shared_dir(spark, f"strata-numbering-{uuid.uuid4().hex}")
    tagged.write.parquet(path)
    placed = spark.read.parquet(path)
    per_part = placed.groupBy(_PID).agg(F.count(F.lit(1)).alias(_CNT))
    # one row per partition: bounded by the partition count, safe to broadcast
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(_PID, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF))
    position = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), 33)
    numbered = placed.join(F.broadcast(offsets), _PID, "inner")
    return numbered.select((F.col(_OFF) + position + 1).alias(name), *cols)


def surrogate_key(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Dense surrogate key 1..n, as ``ROW_NUMBER() OVER (ORDER BY …)``, distributed."""
    return number_rows(df, order, name)


def lead_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column,
                name: str) -> DataFrame:
    """``LEAD(value) OVER (PARTITION BY keys ORDER BY order)`` without a per-key task.

    Rows of one key are consecutive after the global numbering, so the next
    row of the key is the row numbered one higher, if it has the same key.
    """
    rn = "_lead_rn"
    base = df.withColumn("_lead_val", value)
    numbered = number_rows(base, [*[F.col(k).asc_nulls_last() for k in keys], *order], rn)
    nxt = numbered.select((F.col(rn) - 1).alias(rn), F.col("_lead_val").alias("_next_val"),
                          *[F.col(k).alias(f"_next_{i}") for i, k in enumerate(keys)])
    # a provably small side is broadcast; otherwise a sort-merge join on a unique integer
    joined = numbered.join(broadcast_if_small(nxt, rows_of=numbered), rn, "left")
    same_key = None
    for i, k in enumerate(keys):
        eq = F.col(k).eqNullSafe(F.col(f"_next_{i}"))
        same_key = eq if same_key is None else (same_key & eq)
    lead = F.when(same_key, F.col("_next_val"))
    return joined.select(*df.columns, lead.alias(name))
