"""Sharding by jump consistent hashing, in SQL expressions only.

A row's shard depends on its key and the number of shards alone.  The jump
algorithm walks a 64-bit linear congruential sequence seeded with the key; each
value says at which shard count the key would next move.  Going from n to n + 1
shards moves a key only into shard n, an expected 1 / (n + 1) of all keys, and
no ring table is kept.

64-bit products are built from 16-bit limbs, since SQL arithmetic traps on
overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

# Fixed value of the published algorithm: the multiplier of its 64-bit generator.
_MULTIPLIER = 2862933555777941757
_LIMBS = [(_MULTIPLIER >> s) & 0xFFFF for s in (0, 16, 32, 48)]

# A walk over n shards makes H(n) < 45 jumps on average for any n below 2**63; more
# than 512 have a probability below 1e-300.
_MOST_JUMPS = 512


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(0xFFFF).cast("long"))


def _next_state(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) of ``key * multiplier + 1`` modulo 2**64, each half unsigned 32 bits."""
    k = [_low(lo), F.shiftright(lo, 16), _low(hi), F.shiftright(hi, 16)]
    r, carry = [], F.lit(1).cast("long")
    for i in range(4):
        total = carry
        for j in range(i + 1):
            total = total + k[j] * F.lit(_LIMBS[i - j]).cast("long")
        r.append(_low(total))
        carry = F.shiftright(total, 16)
    return F.shiftleft(r[3], 16).bitwiseOR(r[2]), F.shiftleft(r[1], 16).bitwiseOR(r[0])


def jump_shard(key: Column, shards: int) -> Column:
    """Struct ``(shard int, grown int)`` of a 64-bit integer ``key``: its shard among
    ``shards`` and among ``shards + 1``."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).alias("lo"),
        F.lit(-1).cast("long").alias("at"),
        F.lit(0).cast("long").alias("next"))

    def step(s: Column, _: Column) -> Column:
        hi, lo = _next_state(s["hi"], s["lo"])
        jump = F.floor((s["next"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1).cast("double")))
        moved = F.struct(hi.alias("hi"), lo.alias("lo"), s["next"].alias("at"), jump.cast("long").alias("next"))
        return F.when(s["next"] < shards, moved).otherwise(s)

    def finish(s: Column) -> Column:
        return F.struct(s["at"].cast("int").alias("shard"),
                        F.when(s["next"] == shards, F.lit(shards)).otherwise(s["at"]).cast("int").alias("grown"))

    turns = F.sequence(F.lit(1), F.lit(min(shards, _MOST_JUMPS)))
    return F.aggregate(turns, start, step, finish)


def number_slots(df: DataFrame, shard: str, slot: str) -> DataFrame:
    """Adds gapless positions 0, 1, … inside each value of ``shard``.

    Rows are written once with their partition and position, then numbered by
    (rows of the shard in earlier partitions) + (rank inside the partition), so
    no shard is ever gathered in one task, whatever share of the rows it holds.
    """
    row, part, before = "_slot_row", "_slot_part", "_slot_before"
    placed = written(df.withColumn(row, F.monotonically_increasing_id()), "slots")
    placed = placed.withColumn(part, F.shiftrightunsigned(F.col(row), 33))
    counts = placed.groupBy(part, shard).agg(F.count(F.lit(1)).alias("_slot_n"))
    earlier = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(part, shard, F.coalesce(F.sum("_slot_n").over(earlier), F.lit(0)).alias(before))
    inside = Window.partitionBy(part, shard).orderBy(row)
    ranked = placed.withColumn("_slot_rank", F.row_number().over(inside))
    return (ranked.join(counts, [part, shard])
            .withColumn(slot, (F.col(before) + F.col("_slot_rank") - 1).cast("long"))
            .select(*df.columns, slot))


def assign_shards(df: DataFrame, shards: int, key: str = "doc_id", shard: str = "shard",
                  grown: str = "grown_shard") -> DataFrame:
    """Appends ``shard`` and ``grown`` (the shard if there were one more) by the ``key`` column.

    Every row is kept.  Keys of any type are hashed to 64 bits first; a null key is a
    key like any other, equal keys share a shard.  Columns of the input that carry
    the names of the new ones are replaced.
    """
    names = [c for c in df.columns if c not in (shard, grown)]
    jumped = df.select("*", jump_shard(F.xxhash64(F.col(key)), shards).alias("_jump"))
    return jumped.select(*names, F.col("_jump.shard").alias(shard), F.col("_jump.grown").alias(grown))


def shard_report(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size: UTF-8 bytes of the text plus 16.  A null text counts as empty (size 16,
    checksum 0).  Law ``key``: doc_id and the shard count decide.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    rows = number_slots(assign_shards(rows, shards), "shard", "slot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
