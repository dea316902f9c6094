"""N-gram Jaccard join with several global token orders.

A text's set holds the hashes of its distinct word shingles.  Two sets with a Jaccard
similarity of ``t`` or more share a token among the first ``n - ceil(t * n) + 1`` of
either, in any global order of the tokens.  Several orders are used at once, all rarest
first (by classes of the document frequency) but with different hashes inside a
class: a candidate pair must share prefix tokens under every one of them.
Only what is left after intersecting these filters is verified.

Steps:

1. Sets are made in text chunks.  Equal sets are one node from here on, named by a
   64-bit hash of the set.  The documents are a plain table that enters no bucket.  Tokens
   leave as packed arrays, spread over buckets by hash; a token so common that it would
   fill a bucket (found by counting in the tasks) is spread over all buckets by its nodes.
2. Each bucket counts its tokens' frequencies over all nodes; tokens of a single node
   can be shared by nobody and end here.  The rest go back to their nodes.
3. A node whose rarest-first prefix consists of such tokens has no partner.  The others
   keep their shared tokens and their prefixes: the candidates table.
4. First links: in each group of a prefix token the most central node leads (the one whose
   tokens are the most common, as an original among its edited copies).  Every other
   node is verified against one leader.
5. All other pairs that pass the filters are verified too, unless both nodes are already
   in one component: a large group of near copies costs a link each, not all its pairs.
   Groups are cut into blocks, so that no task holds all pairs of a hot token.  A pair meets
   only where enough tokens are left, from that token on, in both.
6. Components over the links of both steps.

No pair is skipped that could join two components.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK_WORD, Words, fresh, mix64, release, text_chunks, written
from .components import components

WORDS = 5
SIMILARITY = Fraction(3, 4)
ORDERS = 3
BUCKET_BYTES = 8 << 20   # text bytes whose tokens make up one bucket, on average
RARITY_STEPS = 4         # frequency classes per doubling of a token's document frequency
BLOCK = 256              # members of a token group that meet in one task
HOT_SHARE = 16           # a token with this part of an average bucket's tokens is spread over all buckets,
HOT_LEAST = 1024         # if so many documents hold it at least

_DOCUMENT = "doc_id long, node long, n_shingles long, tx long, token long, c long"
_ROW = "bucket int, nodes binary, tokens binary, owner binary"
_SHARED = "bucket int, nodes binary, tokens binary, rarity binary"
_TABLE = "node long, n int, centre double, tokens binary, prefixes binary"


def shingle_sets(raw: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, pointers): the distinct ``k``-word shingles of every text, sorted by hash.

    A text with fewer words, but not none, has its whole word sequence as one shingle.
    """
    words = Words(raw, off, BLANK_WORD)
    h, n_words = words.hashes(), np.diff(words.ptr)
    doc = words.doc()
    last = len(h) - k + 1
    roll = np.zeros(max(last, 0), dtype=np.uint64)
    for i in range(k):
        roll = roll * np.uint64(0xD6E8FEB86659FD93) + mix64(h[i:i + len(roll)] + np.uint64(i + 1))
    whole = doc[:last] == doc[k - 1:] if last > 0 else np.zeros(0, dtype=bool)
    tokens, owner = [mix64(roll[whole])], [doc[:max(last, 0)][whole]]
    for m in range(1, k):
        short = np.flatnonzero(n_words == m)
        one = np.full(len(short), m, dtype=np.uint64)
        for i in range(m):
            one = one * np.uint64(0xD6E8FEB86659FD93) + mix64(h[words.ptr[short] + i] + np.uint64(i + 1))
        tokens.append(mix64(one))
        owner.append(short)
    tokens, owner = np.concatenate(tokens), np.concatenate(owner)
    order = np.argsort(tokens, kind="stable")
    order = order[np.argsort(owner[order].astype(np.int32), kind="stable")]
    tokens, owner = tokens[order], owner[order]
    keep = np.ones(len(tokens), dtype=bool)
    keep[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    return tokens[keep], np.searchsorted(owner[keep], np.arange(len(off)))


def set_names(tokens: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set (0 for the empty one)."""
    n = np.diff(ptr)
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(tokens ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)])
    return np.where(n > 0, mix64(run[ptr[1:]] - run[ptr[:-1]] + n.astype(np.uint64)), np.uint64(0)).view(np.int64)


def _cut(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, non-empty buckets, their bounds) for dealing rows out to buckets."""
    order = np.argsort(bucket, kind="stable")
    have, start = np.unique(bucket[order], return_index=True)
    return order, have, np.append(start, len(bucket))


def _once(names: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Boolean per text of a chunk: the first of its set, which is not empty."""
    _, one = np.unique(names, return_index=True)
    pick = np.zeros(len(sizes), dtype=bool)
    pick[one] = True
    return pick & (sizes > 0)


def _most_common(tokens: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Summed counts of at most ``most`` tokens, each too low by the total over ``most`` at most (Misra-Gries)."""
    tokens, at = np.unique(tokens, return_inverse=True)
    counts = np.bincount(at, weights=counts, minlength=len(tokens)).astype(np.int64)
    if len(tokens) > most:
        counts = counts - np.partition(counts, -most - 1)[-most - 1]
    return tokens[counts > 0], counts[counts > 0]


def _document_rows(docs: DataFrame, k: int, most: int) -> DataFrame:
    """A row per document; and, with ``c``, the common tokens of each task and how many of its sets hold them."""
    def run(batches):
        common, counts, total = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for rows, raw, off in text_chunks(batches):
            tokens, ptr = shingle_sets(raw, off, k)
            names, sizes = set_names(tokens, ptr), np.diff(ptr)
            none = pa.nulls(rows.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column(rows.schema.get_field_index("doc_id")).cast(pa.int64()), pa.array(names), pa.array(sizes.astype(np.int64)),
                                              rows.column(rows.schema.get_field_index("tx")), none, none], names=["doc_id", "node", "n_shingles", "tx", "token", "c"])
            tokens = tokens[np.repeat(_once(names, sizes), sizes)]
            total += len(tokens)
            common, counts = _most_common(np.concatenate([common, tokens]), np.concatenate([counts, np.ones(len(tokens), np.int64)]), most)
        often = counts > 1 + total // most
        none = pa.nulls(int(often.sum()), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(common[often].view(np.int64)), pa.array(counts[often])],
                                         names=["doc_id", "node", "n_shingles", "tx", "token", "c"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("tx")).mapInArrow(run, _DOCUMENT)


def _hot_tokens(rows: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, rarity) of the tokens that would fill a bucket: ``most`` at most, as their counts sum to all tokens at most."""
    total = rows.agg(F.sum("n_shingles")).collect()[0][0] or 0
    hot = rows.where("c is not null").groupBy("token").agg(F.sum("c").alias("c")).where(F.col("c") > max(HOT_LEAST, total // most)).toArrow()
    tokens, c = hot["token"].to_numpy().view(np.uint64), hot["c"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], _rarity(c[order])


def _rarity(df: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.rint(RARITY_STEPS * np.log2(df))).astype(np.uint8)


def _place(hot: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is it hot, its place in ``hot``) for each token."""
    if not len(hot):
        return np.zeros(len(tokens), dtype=bool), np.zeros(len(tokens), np.int64)
    slot = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
    return hot[slot] == tokens, slot


def _token_rows(docs: DataFrame, k: int, buckets: int, hot) -> DataFrame:
    def run(batches):
        for _, raw, off in text_chunks(batches):
            tokens, ptr = shingle_sets(raw, off, k)
            names, sizes = set_names(tokens, ptr), np.diff(ptr)
            # equal sets of a chunk go on once
            owner = np.repeat(np.arange(len(sizes)), sizes)
            keep = _once(names, sizes)[owner]
            tokens, owner = tokens[keep], owner[keep]
            spread, _ = _place(hot.value[0], tokens)
            dealt = np.where(spread, mix64(tokens ^ names.view(np.uint64)[owner]), tokens)
            order, have, bound = _cut((dealt >> np.uint64(40)).astype(np.int64) % buckets, buckets)
            out = {c: [] for c in ("bucket", "nodes", "tokens", "owner")}
            for b, x, y in zip(have.tolist(), bound[:-1], bound[1:], strict=True):
                part = order[x:y]
                who, local = np.unique(owner[part], return_inverse=True)
                for c, v in (("bucket", b), ("nodes", names[who].tobytes()), ("tokens", tokens[part].tobytes()), ("owner", local.astype(np.uint32).tobytes())):
                    out[c].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out["bucket"], pa.int32()), *[pa.array(out[c], pa.binary()) for c in list(out)[1:]]], names=list(out))

    return docs.select("text").mapInArrow(run, _ROW)


def _joined(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype)


def _frequencies(rows: DataFrame, buckets: int, hot) -> DataFrame:
    """Tokens that several nodes share, dealt out again by node.

    Of a hot token a bucket has only some nodes: its rarity comes from the counts of the tasks."""
    def run(table: pa.Table) -> pa.Table:
        tokens = _joined(table, "tokens", np.uint64)
        nodes = _joined(table, "nodes", np.int64)
        per = np.array([len(x) // 8 for x in table.column("nodes").to_pylist()])
        count = np.array([len(x) // 8 for x in table.column("tokens").to_pylist()])
        owner = _joined(table, "owner", np.uint32).astype(np.int64) + np.repeat(np.cumsum(per) - per, count)
        node = nodes[owner] if len(nodes) else np.zeros(0, np.int64)
        order = np.lexsort((node, tokens))
        tokens, node = tokens[order], node[order]
        keep = np.ones(len(tokens), dtype=bool)  # a node may come from several chunks
        keep[1:] = (tokens[1:] != tokens[:-1]) | (node[1:] != node[:-1])
        tokens, node = tokens[keep], node[keep]
        new = np.ones(len(tokens), dtype=bool)
        new[1:] = tokens[1:] != tokens[:-1]
        group = np.cumsum(new) - 1
        df = np.bincount(group)[group] if len(group) else group
        spread, _ = _place(hot.value[0], tokens)
        shared = (df > 1) | spread
        tokens, node, df = tokens[shared], node[shared], df[shared]
        spread, slot = _place(hot.value[0], tokens)
        rarity = _rarity(df)
        rarity[spread] = hot.value[1][slot[spread]]
        order, have, bound = _cut(node.astype(np.int64) % buckets & 0x7FFFFFFF, buckets)
        out = [(b, node[order[x:y]].tobytes(), tokens[order[x:y]].tobytes(), rarity[order[x:y]].tobytes())
               for b, x, y in zip(have.tolist(), bound[:-1], bound[1:], strict=True)]
        return pa.table([pa.array([r[i] for r in out], pa.int32() if i == 0 else pa.binary()) for i in range(4)],
                        names=["bucket", "nodes", "tokens", "rarity"])

    return rows.groupBy("bucket").applyInArrow(run, _SHARED)


def _prefix_size(n: np.ndarray, t: Fraction) -> np.ndarray:
    return n - -(-n * t.numerator // t.denominator) + 1


def _candidates(rows: DataFrame, sizes: DataFrame, t: Fraction) -> DataFrame:
    """Candidate nodes with their shared tokens and prefixes; ``sizes``: (bucket, node, n) of every node."""
    def run(table: pa.Table, known: pa.Table) -> pa.Table:
        node, tokens, rarity = _joined(table, "nodes", np.int64), _joined(table, "tokens", np.uint64), _joined(table, "rarity", np.uint8)
        out = []
        names, size = known["node"].to_numpy(), known["n"].to_numpy()
        by_name = np.argsort(names)
        order = np.lexsort((tokens, node))
        node, tokens, rarity = node[order], tokens[order], rarity[order].astype(np.int64)
        name, start = np.unique(node, return_index=True)
        bound = np.append(start, len(node))
        n = size[by_name[np.searchsorted(names, name, sorter=by_name)]] if len(name) else np.zeros(0, np.int64)
        shared = np.diff(bound)
        want = _prefix_size(n, t) - (n - shared)  # prefix tokens left after those nobody shares
        # the same tokens under every order: rarity first, then the order's own hash
        which = np.repeat(np.arange(len(name)), shared)
        ranked = [np.lexsort((mix64(tokens + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (2**64 - 1))), rarity, which)) for k in range(ORDERS)]
        total = np.concatenate([[0], np.cumsum(rarity)])
        for i in np.flatnonzero(want > 0).tolist():
            a, b = bound[i], bound[i + 1]
            prefixes = b"".join(tokens[r[a:a + want[i]]].tobytes() for r in ranked)
            out.append((int(name[i]), int(n[i]), float((total[b] - total[a]) / n[i]), tokens[a:b].tobytes(), prefixes))
        kinds = [pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.binary()]
        return pa.table([pa.array([r[i] for r in out], kinds[i]) for i in range(5)],
                        names=["node", "n", "centre", "tokens", "prefixes"])

    return rows.groupBy("bucket").cogroup(sizes.groupBy("bucket")).applyInArrow(run, _TABLE)


def _prefix_rows(nodes: DataFrame) -> DataFrame:
    """(key, ord, node, n, centre, m, at): a row per prefix token and order; the key holds both.

    ``m``: the node's shared tokens; ``at``: how many of them come before this one in the order.
    """
    def run(batches):
        for batch in batches:
            prefixes = batch.column(batch.schema.get_field_index("prefixes")).to_pylist()
            count = np.array([len(p) // (8 * ORDERS) for p in prefixes], dtype=np.int64)
            tokens = np.frombuffer(b"".join(prefixes), np.uint64)
            which = np.repeat(np.arange(len(count)), count * ORDERS)
            ord_ = np.concatenate([np.repeat(np.arange(ORDERS), c) for c in count.tolist()]) if len(count) else np.zeros(0, np.int64)
            at = np.concatenate([np.tile(np.arange(c), ORDERS) for c in count.tolist()]) if len(count) else np.zeros(0, np.int64)
            m = np.array([len(x) // 8 for x in batch.column(batch.schema.get_field_index("tokens")).to_pylist()], dtype=np.int32)
            key = mix64(tokens + (ord_.astype(np.uint64) << np.uint64(58))).view(np.int64)
            pick = pa.array(which)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ord_.astype(np.int32)), *[
                batch.column(batch.schema.get_field_index(c)).take(pick) for c in ("node", "n", "centre")], pa.array(m[which]), pa.array(at.astype(np.int32))],
                names=["key", "ord", "node", "n", "centre", "m", "at"])

    return nodes.select("node", "n", "centre", "tokens", "prefixes").mapInArrow(run, "key long, ord int, node long, n int, centre double, m int, at int")


def _can_reach(t: Fraction):
    """Can this be the first common token, in its order, of two similar enough sets?

    From their first common token on, the sets share at most as many tokens as the shorter
    rest of shared tokens holds.  A similar pair meets at that token under every order; its
    later common tokens need not bring it up again.
    """
    return F.expr(f"least(ma - ata, mb - atb) * {t.numerator + t.denominator} >= {t.numerator} * (na + nb)")


_ALL_ORDERS = (1 << ORDERS) - 1


def _verify(pairs: DataFrame, nodes: DataFrame, t: Fraction) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("tokens").alias(f"t{x}"))
    full = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for batch in batches:
            cols = {c: batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "na", "nb", "ta", "tb")}
            na, nb = cols["na"].to_numpy(), cols["nb"].to_numpy()
            both = np.array([len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True))
                             for x, y in zip(cols["ta"], cols["tb"], strict=True)], dtype=np.int64)
            ok = pa.array(both * t.denominator >= (na.astype(np.int64) + nb - both) * t.numerator)
            yield pa.RecordBatch.from_arrays([cols["a"].filter(ok), cols["b"].filter(ok)], names=["a", "b"])

    return full.mapInArrow(run, "a long, b long")


def _leader_pairs(rows: DataFrame, t: Fraction) -> DataFrame:
    """One pair for each node: the leader it shares the most prefix tokens with, under all orders."""
    lead = rows.groupBy("key").agg(F.max(F.struct("centre", "node", "n", "m", "at")).alias("lead"), F.count(F.lit(1)).alias("c")).where("c > 1")
    met = (rows.join(lead, "key").select(F.col("lead.node").alias("a"), F.col("lead.n").alias("na"), F.col("lead.m").alias("ma"), F.col("lead.at").alias("ata"),
                                          F.col("node").alias("b"), F.col("n").alias("nb"), F.col("m").alias("mb"), F.col("at").alias("atb"), "ord")
           .where((F.col("a") != F.col("b")) & _can_reach(t)))
    met = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.bit_or(F.expr("shiftleft(1, ord)")).alias("seen")).where(F.col("seen") == _ALL_ORDERS)
    return met.groupBy("b").agg(F.max(F.struct("c", "a")).alias("m")).select(F.col("m.a").alias("a"), "b")


def _other_pairs(rows: DataFrame, labels: DataFrame, t: Fraction) -> DataFrame:
    """Pairs of nodes of different components that share prefix tokens under all orders."""
    named = rows.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    groups = (named.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("c"))
              .where("x <> y").select("key", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")))
    open_ = named.join(groups, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a group's blocks meet pairwise: (i, j) with i <= j
    left = open_.withColumn("j", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1))).select(
        "key", F.col("block").alias("i"), "j", F.col("node").alias("a"), F.col("n").alias("na"), F.col("comp").alias("ca"), F.col("m").alias("ma"), F.col("at").alias("ata"), "ord")
    right = open_.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("block")))).select(
        "key", "i", F.col("block").alias("j"), F.col("node").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"), F.col("m").alias("mb"), F.col("at").alias("atb"))
    met = left.join(right, ["key", "i", "j"]).where((F.col("ca") != F.col("cb")) & ((F.col("i") < F.col("j")) | (F.col("a") < F.col("b")))
                                                    & _can_reach(t))
    return (met.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .agg(F.bit_or(F.expr("shiftleft(1, ord)")).alias("seen")).where(F.col("seen") == _ALL_ORDERS).select("a", "b"))


def join_table(docs: DataFrame, k: int = WORDS, t: Fraction = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """The written tables of documents and of candidate nodes (steps 1 to 3)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES + 1)
    most = HOT_SHARE * buckets
    rows = written(_document_rows(docs, k, most), "documents")
    hot = spark.sparkContext.broadcast(_hot_tokens(rows, most))  # bounded by HOT_SHARE tokens a bucket
    listed = rows.where("c is null").drop("token", "c")
    sizes = listed.where("n_shingles > 0").groupBy("node").agg(F.first("n_shingles").alias("n"))
    sizes = sizes.select((F.pmod("node", F.lit(buckets)).bitwiseAND(0x7FFFFFFF)).cast("int").alias("bucket"), "node", "n")
    table = written(_candidates(_frequencies(_token_rows(docs, k, buckets, hot), buckets, hot), sizes, t), "sets")
    release(spark)
    return listed, table


def similar_links(table: DataFrame, t: Fraction = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(links, labels): verified links between nodes, enough to connect every component, and its components."""
    rows = written(_prefix_rows(table), "prefixes")
    links = written(_verify(_leader_pairs(rows, t), table, t), "leads")
    labels = components(links)
    links = links.unionByName(written(_verify(_other_pairs(rows, labels, t), table, t), "others"))
    return links, components(links)


def similarity_join(docs: DataFrame, k: int = WORDS, t: Fraction = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(members, links): the whole join, every link between different sets verified.

    members has one row per row of ``docs``: doc_id, node (the name of its set; null for an empty
    one), n_shingles, n_links (rows it is linked with: those of its own set and those of
    linked sets).  links has one row per pair of linked sets: a, b.  Equal sets are one node, so copies
    are not expanded; a group of n different texts that are all alike has n * (n - 1) / 2 links.
    Where the groups alone are wanted, :func:`near_duplicates` verifies fewer pairs.
    """
    rows, table = join_table(docs, k, t)
    prefixes = written(_prefix_rows(table), "prefixes")
    alone = table.select("node", F.col("node").alias("comp")).where(F.lit(False))  # no pair is settled beforehand
    links = written(_verify(_other_pairs(prefixes, alone, t), table, t), "links")
    copies = rows.where("n_shingles > 0").groupBy("node").agg(F.count(F.lit(1)).alias("copies"))
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = ends.join(copies, F.col("b") == F.col("node")).groupBy("a").agg(F.sum("copies").alias("linked"))
    total = copies.join(linked, F.col("node") == F.col("a"), "left").select("node", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    members = rows.withColumn("node", F.when(F.col("n_shingles") > 0, F.col("node"))).join(total, "node", "left")
    return members.select("doc_id", "node", "n_shingles", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")), links


def _groups(docs: DataFrame, k: int, t: Fraction) -> DataFrame:
    """(doc_id, tx, node, n_shingles, comp, component_id) of every row; comp is null for empty sets."""
    rows, table = join_table(docs, k, t)
    _, labels = similar_links(table, t)
    least = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = least.join(labels, "node", "left").select("node", "least", F.coalesce("comp", "node").alias("comp"))
    group = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_node = named.join(group, "comp").select("node", "comp", "component_id")
    return rows.withColumn("node", F.when(F.col("n_shingles") > 0, F.col("node"))).join(of_node, "node", "left")


def near_duplicates(docs: DataFrame, k: int = WORDS, t: Fraction = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Documents are linked when the Jaccard similarity of their shingle sets is at least
    ``t``; component_id is the smallest doc_id reachable.  Without words or text the set is
    empty and the row is linked with nothing.  A null doc_id has the component_id of its
    group, null if no member has an id.
    """
    return _groups(docs, k, t).select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, k: int = WORDS, t: Fraction = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the smallest doc_id (an id before
    none; of equal ids the smallest text hash, of equal texts one row by a hash of all
    columns).  Rows without words, that is of the six ASCII blanks alone, are all kept.  Columns
    may have any names."""
    rank = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "tx")
    cols = docs.columns
    kept_id, kept_tx, tx, nth = fresh(cols, "kept_id", "kept_tx", "text_hash", "nth")
    chosen = (_groups(docs, k, t).where("n_shingles > 0").groupBy("comp").agg(F.min(rank).alias("m"))
              .select(F.col("m.doc_id").alias(kept_id), F.col("m.tx").alias(kept_tx)))
    wordless = F.coalesce("text", F.lit("")).rlike(r"\A[\x20\x09-\x0D]*\z")
    worded = docs.where(~wordless).withColumn(tx, F.xxhash64("text"))
    first = Window.partitionBy("doc_id", tx).orderBy(F.xxhash64(*cols))
    worded = worded.withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1)
    kept = worded.join(chosen, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(tx) == F.col(kept_tx)), "left_semi")
    return kept.select(*cols).unionByName(docs.where(wordless))
