"""SimHash near duplicates by BK-trees.

1. Fingerprints are made in text chunks; equal ones are one node from here on.
2. Two fingerprints within ``radius`` bits agree on at least one of ``radius + 1`` pieces of
   their bits (in a large corpus: on m of ``radius + m``).  The nodes that agree on such
   pieces are a shard, so work grows with the shards and not with the square of the corpus.
3. A shard is cut into parts of at most ``PART`` nodes.  Every part becomes a BK-tree: the
   children of a node are keyed by their Hamming distance to it.  A part's tree is broadcast
   to all parts of its shard, which are the blocks of its queries: by the shuffle, since a
   broadcast from the driver would collect the fingerprints of all documents there.  A query
   at distance d from a node follows only the edges d - radius .. d + radius (triangle
   inequality).
4. A task hands on one link for each node that it joined to another, not all pairs.
   Components over these links give the classes.

All trees of a task are built and searched together, level by level, as numpy arrays.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANK_WORD, Words, text_chunks, written
from .components import components

WORDS = 4
RADIUS = 4
SHARD = 1 << 13           # nodes of a shard aimed at
PART = 1 << 16            # nodes of one tree at most, about; a larger shard has several
FRONTIER = 1 << 16        # (query, tree node) pairs compared at once
HASHED = 1 << 18          # shingles hashed at once
BROADCAST_ROWS = 1 << 19  # large shards listed to every task at most; more are joined by a shuffle
SEED = 42

_PRINT = "doc_id long, print long"


def simhashes(raw: np.ndarray, off: np.ndarray, k: int = WORDS) -> np.ndarray:
    """A 64-bit SimHash of each text of a chunk, over its ``k``-word shingles with repeats.

    A text with fewer words has its whole word sequence as one shingle, one without words the
    fingerprint zero.
    """
    words = Words(raw, off, BLANK_WORD)
    n_words = np.diff(words.ptr)
    # words in a row with one blank after each: a shingle is a slice
    lens = np.diff(words.off)
    spaced = np.full(len(words.data) + words.n, 0x20, dtype=np.uint8)
    spaced[np.arange(len(words.data)) + np.repeat(np.arange(words.n), lens)] = words.data
    begin = words.off + np.arange(words.n + 1)
    count = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    first = np.repeat(words.ptr[:-1], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    last = first + np.repeat(np.minimum(n_words, k), count)
    data, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    start, stop = begin[first], begin[last] - 1
    h = np.empty(len(start), dtype=np.uint64)
    for lo in range(0, len(h), HASHED):
        h[lo:lo + HASHED] = [digest(data[a:b], SEED) for a, b in zip(start[lo:lo + HASHED].tolist(), stop[lo:lo + HASHED].tolist(), strict=True)]
    out = np.zeros(len(n_words), dtype=np.uint64)
    have = np.flatnonzero(count)
    if len(have):
        at = (np.cumsum(count) - count)[have]
        for bit in range(64):
            ones = np.add.reduceat((h >> np.uint64(bit) & np.uint64(1)).astype(np.int64), at)
            out[have] |= (2 * ones > count[have]).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, print) of every row; a null text has no words."""
    def run(batches):
        for rows, raw, off in text_chunks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(rows.schema.get_field_index("doc_id")).cast(pa.int64()), pa.array(simhashes(raw, off, k).view(np.int64))],
                                             names=["doc_id", "print"])

    return docs.select("doc_id", "text").mapInArrow(run, _PRINT)


class Trees:
    """BK-trees of several groups of distinct fingerprints, in arrays.

    Node i holds the print ``rows[i]``; ``key`` is its parent times 65 plus its distance to the
    parent (-1 for a root), and rises, so the children of a node over a range of edges stand
    in one run.  ``root`` has the root of each group, -1 where the group is empty.
    """

    def __init__(self, prints: np.ndarray, group: np.ndarray, groups: int):
        self.root = np.full(groups, -1, dtype=np.int64)
        row, key, made = np.arange(len(prints)), group.astype(np.int64), 0
        rows, keys = [], []
        while len(row):  # the first print of every open set becomes a node; the others split by their distance to it
            order = np.argsort(key, kind="stable")
            row, key = row[order], key[order]
            first = np.ones(len(row), dtype=bool)
            first[1:] = key[1:] != key[:-1]
            node = made + np.cumsum(first) - 1
            rows.append(row[first])
            if made:
                keys.append(key[first])
            else:
                self.root[key[first]] = node[first]
                keys.append(np.full(int(first.sum()), -1))
            made += len(rows[-1])
            parent, row = node[~first], row[~first]
            rows_of_nodes = rows[-1][parent - (made - len(rows[-1]))]
            key = parent * 65 + np.bitwise_count(prints[row] ^ prints[rows_of_nodes])
        self.rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.prints = prints[self.rows]

    def near(self, queries: np.ndarray, group: np.ndarray, radius: int):
        """Yields (query index, row index) arrays of all pairs within ``radius``."""
        has = np.flatnonzero(self.root[group] >= 0)
        todo = [(has, self.root[group[has]])]
        while todo:
            query, node = todo.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                todo += [(query[half:], node[half:]), (query[:half], node[:half])]
                continue
            d = np.bitwise_count(queries[query] ^ self.prints[node]).astype(np.int64)
            hit = d <= radius
            yield query[hit], self.rows[node[hit]]
            # prints under edge e are at distance e from the node: none is within the radius unless |d - e| <= radius
            lo = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0), "left")
            count = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), "right") - lo
            if count.any():
                at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                todo.append((np.repeat(query, count), np.repeat(lo, count) + at))


def _joined(up: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels ``up`` (the smallest index of each component) after a[i] is joined with b[i] for all i."""
    while True:
        x, y = up[a], up[b]
        open_ = x != y
        if not open_.any():
            return up
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (up != up[up]).any():
            up = up[up]


def _links(prints: np.ndarray, tree: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is near: inside a tree that has no queries of its own (side 1), else queries and tree."""
    trees, tree = np.unique(tree, return_inverse=True)
    order = np.lexsort((prints, tree))  # the same trees from the same rows in any order
    prints, tree, side = prints[order], tree[order], side[order]
    asked = np.zeros(len(trees), dtype=bool)
    asked[tree[side == 1]] = True
    member, query = np.flatnonzero(side == 0), np.flatnonzero((side == 1) | ~asked[tree])
    forest = Trees(prints[member], tree[member], len(trees))
    up = np.arange(len(prints))
    for q, found in forest.near(prints[query], tree[query], radius):
        up = _joined(up, query[q], member[found])
    moved = np.flatnonzero(up != np.arange(len(prints)))
    return prints[up[moved]], prints[moved]


def shard_masks(n: int, radius: int) -> list[int]:
    """Bit masks of the shards of ``n`` prints.

    Two prints within ``radius`` bits agree on ``m`` of ``radius + m`` pieces at least.  m is the
    least that makes a shard of evenly spread prints no larger than ``SHARD``.
    """
    m = 1
    while n >> (64 * m // (radius + m)) > SHARD:
        m += 1
    cuts = [64 * i // (radius + m) for i in range(radius + m + 1)]
    pieces = [(1 << b) - (1 << a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [sum(c) for c in combinations(pieces, m)]


def near_links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``print`` that connect all that are within ``radius`` bits."""
    spark = nodes.sparkSession
    n = nodes.count()
    masks = shard_masks(n, radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    shard = F.array(*[F.struct(F.lit(i).alias("piece"), F.col("print").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(signed)])
    member = nodes.select("print", F.explode(shard).alias("s")).select("print", "s.piece", "s.value")
    large = written(member.groupBy("piece", "value").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > PART)
                    .select("piece", "value", F.ceil(F.col("c") / PART).cast("int").alias("parts")), "large")
    hot = large.count()  # n * pieces / PART at most
    if hot:
        member = member.join(F.broadcast(large) if hot <= BROADCAST_ROWS else large, ["piece", "value"], "left")
    else:
        member = member.withColumn("parts", F.lit(None).cast("int"))
    member = member.withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("p", F.pmod(F.xxhash64("print"), F.col("parts")).cast("int"))
    # the tree of part i (side 0) meets itself and the queries (side 1) of every part j > i
    meet = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    p, parts = F.col("p"), F.col("parts")
    own = F.transform(F.sequence(p, parts - 1), lambda j: meet(p, j, 0))
    others = F.when(p > 0, F.transform(F.sequence(F.lit(0), p - 1), lambda i: meet(i, p, 1))).otherwise(F.array().cast("array<struct<i:int,j:int,side:int>>"))
    dealt = (member.withColumn("m", F.explode(F.concat(own, others)))
             .select("print", F.xxhash64("piece", "value", "m.i", "m.j").alias("tree"), F.col("m.side").alias("side")))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n * len(masks) // PART + 1)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            part = [batch.column(i).to_numpy() for i in range(3)]
            if not len(part[0]):
                continue
            if size >= PART and part[1][-1] != held[-1][1][-1]:  # whole trees so far, at least PART rows: search them
                cut = int(np.searchsorted(part[1], held[-1][1][-1], "right"))
                yield from found([*held, [c[:cut] for c in part]])
                held, size, part = [], 0, [c[cut:] for c in part]
            held.append(part)
            size += len(part[0])
        if held:
            yield from found(held)

    def found(parts):
        prints, tree, side = (np.concatenate(c) for c in zip(*parts, strict=True))
        a, b = _links(prints.view(np.uint64), tree, side, radius)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return dealt.repartition(tasks, "tree").sortWithinPartitions("tree").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Rows are linked when their fingerprints differ in at most ``radius`` bits; component_id is
    the smallest doc_id reachable.  Null and wordless texts have the fingerprint zero, which is
    linked like any other.  A null doc_id counts nowhere as the smallest: the row has its group's
    component_id, null if no member has an id.  Repeated rows stay repeated.  Other columns of
    ``docs`` are not read.
    """
    prints = written(fingerprints(docs, k), "prints")
    nodes = written(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "nodes")
    labels = components(written(near_links(nodes.select("print"), radius), "links"))
    named = nodes.join(labels, F.col("print") == F.col("node"), "left").select("print", "least", F.coalesce("comp", "print").alias("comp"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_print = named.join(least, "comp").select("print", "component_id")
    return prints.join(of_print, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
