"""Anti joins and dimension lookups.

Spark plans ``NOT IN (subquery)`` as a null-aware anti join only with a
broadcast right side and otherwise falls back to a nested-loop join.
:func:`not_in` keeps the SQL semantics for any size: one probe of the right
side's distinct keys decides between "no rows", "all rows" and a plain
shuffled ``left_anti`` join.
"""

from __future__ import annotations

import re
import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """Rows of ``left`` whose ``left_col NOT IN (SELECT right_col FROM right)``.

    SQL three-valued logic: a NULL in the subquery empties the result; an empty
    subquery keeps every row, NULLs included; otherwise NULL probes drop out.
    The distinct keys are computed once for the probe and once for the join,
    both from the same aggregate.
    """
    keys = right.select(F.col(right_col).alias("_k")).distinct()
    seen = keys.agg(F.count(F.lit(1)).alias("n"), F.count("_k").alias("known")).first()
    if seen["n"] == 0:
        return left
    if seen["known"] < seen["n"]:
        return left.limit(0)
    probe = left.filter(F.col(left_col).isNotNull())
    return probe.join(keys, probe[left_col] == F.col("_k"), "left_anti")


def not_exists(left: DataFrame, left_col: str, right: DataFrame, right_col: str) -> DataFrame:
    """Correlated ``NOT EXISTS (… WHERE r = l)``: NULL probes are kept.  Also
    ``LEFT JOIN … WHERE right.key IS NULL``.  The right keys are made distinct with a
    map-side combine, so a hot right key is one row in the join."""
    keys = right.select(F.col(right_col).alias("_k")).where("_k is not null").distinct()
    return left.join(keys, left[left_col] == F.col("_k"), "left_anti")


# Bytes per value of the fixed-width types; text and binary are measured.
_TYPE_BYTES = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4, "double": 8,
               "date": 4, "timestamp": 8, "timestamp_ntz": 8}
_MEASURED = ("string", "binary")


def fixed_bytes(df: DataFrame) -> int | None:
    """In-memory width of one row without its measured columns; None for nested types."""
    total = 16  # row header and null bits
    for f in df.schema.fields:
        name = f.dataType.typeName()
        if name == "decimal":
            total += 8 if f.dataType.precision <= 18 else 16
        elif name in _MEASURED:
            total += 16  # offset, length and padding
        elif name in _TYPE_BYTES:
            total += 8
        else:
            return None
    return total


def parse_bytes(text: str) -> int:
    """Spark size strings: ``10485760b``, ``32m``, ``1.5g``, ``-1``."""
    m = re.fullmatch(r"(-?\d+(?:\.\d+)?)\s*([kmgtp]?)(?:i?b)?", text.strip().lower())
    if not m:
        raise ValueError(f"not a size: {text!r}")
    scale = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}[m.group(2)]
    return int(float(m.group(1)) * scale)


def broadcast_threshold(df: DataFrame) -> int:
    return parse_bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m"))


_SIZES: "weakref.WeakKeyDictionary[DataFrame, dict[str, int]]" = weakref.WeakKeyDictionary()
_ROWS = ""


def measured(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Rows (key ``""``) and summed bytes of text columns of ``df``: one aggregate with
    partial sums, remembered per DataFrame object."""
    seen = _SIZES.setdefault(df, {})
    if _ROWS not in seen or any(c not in seen for c in columns):
        texts = [f.name for f in df.schema.fields if f.dataType.typeName() in _MEASURED]
        row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.octet_length(F.col(c))).alias(f"_b{i}") for i, c in enumerate(texts)]).first()
        seen[_ROWS] = row["_n"]
        seen.update({c: row[f"_b{i}"] or 0 for i, c in enumerate(texts)})
    return seen


def fits_broadcast(df: DataFrame, max_bytes: int | None = None, rows_of: DataFrame | None = None) -> bool:
    """Do rows × fixed width plus the summed bytes of the text columns fit the broadcast threshold?

    ``rows_of`` names the table the rows come from when ``df`` is a projection or a filtered part of
    it, so one aggregate, remembered with that table, serves them all."""
    limit = broadcast_threshold(df) if max_bytes is None else max_bytes
    width = fixed_bytes(df)
    if limit <= 0 or width is None:
        return False
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() in _MEASURED]
    source = rows_of if rows_of is not None and set(texts) <= set(rows_of.columns) else df
    size = measured(source, texts)
    return size[_ROWS] * width + sum(size[c] for c in texts) <= limit


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None, rows_of: DataFrame | None = None) -> DataFrame:
    """Broadcast hint only behind a measured bound (:func:`fits_broadcast`).  Meant
    for lookup sides that are cheap to read (stored dimensions, narrow maps of
    a scan); a larger side is returned unchanged for the sort-merge join, where
    AQE splits skewed keys."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes, rows_of) else df


HOT_KEY_ROWS = 1_000_000  # right-side rows of one key that one task should join


def left_join_spread(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` that survives a right key
    holding a large share of all rows.

    AQE splits a skewed partition only on the preserved side of an outer join.
    Here right keys with more than ``hot_rows`` rows ("hot") are spread: their
    right rows, with exact copies folded into one row and a count, go to
    ``ceil(n / hot_rows)`` salt buckets by row hash, the matching left rows are
    replicated once per bucket, and the pairs are joined on (key, salt); copies
    are expanded again in bounded chunks.  Every hot key has right rows, so the
    hot part is an inner join.  All other keys take the ordinary join.  The hot
    key table has at most ``|right| / hot_rows`` rows and is broadcast only
    behind the size check.  Column names of the two sides must not overlap.

    Fast paths: a right side that provably fits the broadcast threshold is
    broadcast (a hot key costs nothing there), and without hot keys the plain
    join runs.
    """
    from .ordering import _N, expand_copies, fold_copies

    on = F.col(left_key) == F.col(right_key)
    small = broadcast_if_small(right)
    if small is not right:
        return left.join(small, on, "left")
    rcols, lcols = right.columns, left.columns
    per_key = right.groupBy(F.col(right_key).alias("_hk")).agg(F.count(F.lit(1)).alias("_hn"))
    hot = (per_key.filter(F.col("_hn") > hot_rows)
           .select("_hk", F.ceil(F.col("_hn") / hot_rows).cast("int").alias("_hs")))
    if hot.limit(1).count() == 0:
        return left.join(right, on, "left")
    hot = broadcast_if_small(hot)
    rt = right.join(hot, F.col(right_key) == F.col("_hk"), "left")
    lt = left.join(hot, F.col(left_key) == F.col("_hk"), "left")

    cold = (lt.filter(F.col("_hs").isNull()).select(*lcols)
            .join(rt.filter(F.col("_hs").isNull()).select(*rcols), F.col(left_key) == F.col(right_key), "left"))

    r_hot = (fold_copies(rt.filter(F.col("_hs").isNotNull()).select(*rcols, "_hs"))
             .withColumn("_rsalt", F.pmod(F.xxhash64(*rcols), F.col("_hs"))).drop("_hs"))
    l_hot = (lt.filter(F.col("_hs").isNotNull())
             .withColumn("_lsalt", F.explode(F.sequence(F.lit(0), F.col("_hs") - 1))).select(*lcols, "_lsalt"))
    pairs = l_hot.join(r_hot, (F.col(left_key) == F.col(right_key)) & (F.col("_lsalt") == F.col("_rsalt")), "inner")
    hot_part = expand_copies(pairs.select(*lcols, *rcols, _N)).select(*lcols, *rcols)
    return cold.unionByName(hot_part)
