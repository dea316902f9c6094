"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions; each decision (the bits so far) has a tree of contexts,
the last 0 to ``DEPTH`` bytes.  A node's counts give a Krichevsky-Trofimov estimate, and
context-tree weighting mixes the estimates of all depths, each node weighting its own
against what its children explain better.  The code length of a text is the sum over
its bytes and a closing end mark (0xFF, never a byte of text), lower-cased.

The tree is whole: every (context, byte) of the training corpus is in it, and it is never
held in one place.

1. Every distinct (context, byte) is counted in the tasks, then summed in one shuffle.
2. The subtrees below the contexts of ``ROOT`` bytes are dealt to shards of about
   ``SHARD_ENTRIES`` pairs.  Each shard weighs its nodes from the leaves up and reports
   sums by the parents of its roots.  KT block probabilities depend on counts alone, so
   the order of the corpus does not matter.
3. The contexts of fewer than ``ROOT`` bytes (256 * 255 nodes a byte of depth, however
   large the corpus) are weighed on the driver and sent to all tasks.
4. Texts are written in blocks of ``BLOCK_BYTES``.  A block asks each shard for the code
   lengths of its distinct (context, byte) pairs; the shard answers in the order asked.
5. Blocks meet their answers in a shuffle by block, and each text sums its bytes.

Requests, answers and blocks pass the tasks one row at a time behind a sort, so a task
holds one shard or one block (a block is one text where a text is longer).  A subtree is
never split: the distinct pairs below one context of ``ROOT`` bytes are what a task must hold.

Words are counted in the same pass for the base score, and looked up exactly: the most
frequent ``HEAD_WORDS`` in the tasks, the others by a join.

Null text: scored as the empty one, its end mark alone.  Null doc_id: counts as held out or
not by the crc32 of the empty text.  Repeated rows: each is counted and each gets its own
row.  Empty tables: no rows.  Nothing learned: 8 bits a byte.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANK_WORD, CHUNK_BYTES, LOWER, Words, release, return_memory, text_chunks, written
from .toxicity import held_out

DEPTH = 5
ROOT = 2                    # contexts of so many bytes are the roots of the subtrees dealt to shards
SHARD_ENTRIES = 1 << 16     # (context, byte) pairs of a shard, on average
BLOCK_BYTES = 4 << 20       # text bytes of a block (one text at least)
BLOCK_ROWS = 1 << 16
HEAD_WORDS = 1 << 17
_START, _END = 0xFE, 0xFF   # bytes that no UTF-8 text holds
_HALF = 1 << 20             # distinct keys that a task gathers before it sends them on


def _mask(n_bytes: int, bits: int = 0) -> int:
    return (1 << (8 * n_bytes + bits)) - 1


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def byte_keys(raw: np.ndarray, off: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(keys, pointers): for each byte and the end mark of each text its ``depth`` bytes before and itself.

    The key is big-endian: the oldest byte on top, the coded byte lowest.
    """
    n = len(off) - 1
    gap = depth + 1                                  # start marks before, one end mark after
    buf = np.full(len(raw) + n * gap, _START, dtype=np.uint8)
    shift = np.arange(n) * gap
    lens = np.diff(off)
    at = np.arange(len(raw)) + np.repeat(shift + depth, lens)
    buf[at] = LOWER[raw]
    buf[off[1:] + shift + depth] = _END
    key, have = buf.astype(np.uint64), 1
    while have < gap and n:                          # bytes side by side: 1, 2, 4, ...
        step = min(have, gap - have)
        low = key[step:] if step == have else key[step:] & np.uint64(_mask(step))
        key = key[:-step] << np.uint64(8 * step)
        key |= low
        have += step
    keep = np.ones(len(key), dtype=bool)             # windows that end on a start mark code nothing
    if n > 1:
        keep[np.repeat(off[1:-1] + np.arange(1, n) * gap, depth) - np.tile(np.arange(1, depth + 1), n - 1)] = False
    return key[keep], off + np.arange(n + 1)


def _paired(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Keys of 48 bits and their counts, one number each that sorts by key; a count of more than 16 bits takes several."""
    most = _mask(2)
    times = -(-counts // most)
    if len(times) and times.max() > 1:
        ends = np.cumsum(times) - 1
        split = np.full(ends[-1] + 1, most, dtype=np.int64)
        split[ends] = counts - (times - 1) * most
        keys, counts = np.repeat(keys, times), split
    both = keys << np.uint64(16)
    both |= counts.astype(np.uint64)
    return both


def _summed(pairs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, in order, and their counts; takes the pairs out of the list."""
    both = np.concatenate(pairs)
    pairs.clear()
    both.sort()
    counts = both.astype(np.uint16)
    both >>= np.uint64(16)
    new = np.ones(len(both), dtype=bool)
    np.not_equal(both[1:], both[:-1], out=new[1:])
    both = both[new]
    return both, np.add.reduceat(counts, np.flatnonzero(new), dtype=np.int64)


def count_corpus(docs: DataFrame) -> DataFrame:
    """(kind, key, n), written: kind 0 has byte keys (8 bytes), kind 1 words, kind 2 the number of texts."""
    def run(batches):
        pairs: list[np.ndarray] = []
        words: list[pa.Table] = []
        seen = 0

        def send_keys(k, c):
            for a in range(0, len(k), 1 << 16):
                part = k[a:a + (1 << 16)].astype(">u8")
                packed = pa.Array.from_buffers(pa.binary(8), len(part), [None, pa.py_buffer(part.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(part), np.int32)), packed, pa.array(c[a:a + (1 << 16)])], names=["kind", "key", "n"])

        def send_words():
            t = pa.concat_tables(words).group_by("key").aggregate([("n", "sum")])
            for b in t.to_batches(1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(b.num_rows, np.int32)), b.column(b.schema.get_field_index("key")).cast(pa.binary()),
                                                  b.column(b.schema.get_field_index("n_sum"))], names=["kind", "key", "n"])

        for rows, raw, off in text_chunks(batches):
            pairs.append(_paired(*np.unique(byte_keys(raw, off)[0], return_counts=True)))
            if sum(map(len, pairs)) > 2 * _HALF:  # not with every chunk: sorting is what costs
                k, c = _summed(pairs)
                if len(k) > _HALF:  # they no longer shrink: send them
                    yield from send_keys(k, c)
                    return_memory()
                else:
                    pairs.append(_paired(k, c))
                del k, c
            v = Words(raw, off, BLANK_WORD).array().value_counts()
            words.append(pa.table({"key": v.field(0), "n": v.field(1)}))
            if sum(t.num_rows for t in words) > _HALF // 2:
                yield from send_words()
                words = []
            seen += rows.num_rows
        if pairs:
            yield from send_keys(*_summed(pairs))
        if words:
            yield from send_words()
        words = []
        return_memory()
        yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([b""], pa.binary()), pa.array([seen])], names=["kind", "key", "n"])

    # the tasks have summed theirs: dealt first, so that Spark doesn't hold a task's keys once more to sum them again
    rows = docs.select("text").mapInArrow(run, "kind int, key binary, n long").repartition("kind", "key")
    table = written(rows.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    release(docs.sparkSession)
    return table


def _threshold(sizes: dict[int, int], most: int) -> int:
    """Smallest power p such that at most ``most`` entries lie in the classes from p on (class: floor of log2)."""
    power, total = 0, sum(sizes.values())
    while total > most:
        total -= sizes.get(power, 0)
        power += 1
    return power


_TABLE = 1 << 16


def _log_rising(start: float) -> np.ndarray:
    """log of start * (start + 1) * ... with 0 .. _TABLE - 1 factors."""
    return np.concatenate([[0.0], np.cumsum(np.log(start + np.arange(_TABLE - 1)))])


_HALVES, _WHOLES = _log_rising(0.5), _log_rising(1.0)


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the KT block probability of so many zeros and ones."""
    both = zeros + ones
    out = np.empty(len(both))
    small = both < _TABLE
    z, o = zeros[small].astype(np.int64), ones[small].astype(np.int64)
    out[small] = _HALVES[z] + _HALVES[o] - _WHOLES[z + o]
    z, o = zeros[~small].astype(float), ones[~small].astype(float)
    out[~small] = _lgamma(z + 0.5) + _lgamma(o + 0.5) - _lgamma(z + o + 1.0) - np.log(np.pi)
    return out


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma by Stirling's series after shifting small arguments up."""
    x = np.asarray(x, dtype=float)
    out = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        now = y < 8
        out[now] -= np.log(y[now])
        y[now] += 1
    z = 1.0 / (y * y)
    out += (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1.0 / 12 - z * (1.0 / 360 - z * (1.0 / 1260 - z / 1680))) / y
    return out


class Level:
    """The nodes of one depth for one bit position: name (context, then the bits so far) and counts.

    ``offset`` and ``slope`` give the root's prediction from the prediction one level deeper.
    """

    def __init__(self, nodes: np.ndarray, ones: np.ndarray, both: np.ndarray):
        self.nodes, self.ones, self.both = nodes, ones, both
        self.kt = (ones + 0.5) / (both + 1.0)

    def weigh(self, explained: np.ndarray | None) -> np.ndarray:
        """log of the weighted probability of each node, given the sum of its children's (None: a leaf)."""
        own = _log_kt(self.both - self.ones, self.ones)
        if explained is None:
            self.share = np.ones(len(own))
            return own
        self.share = 1.0 / (1.0 + np.exp(-np.clip(own - explained, -60, 60)))
        return np.logaddexp(own, explained) - np.log(2)

    def descend(self, offset: np.ndarray | float, slope: np.ndarray | float) -> None:
        self.offset, self.slope = offset + slope * self.share * self.kt, slope * (1 - self.share)
        del self.ones, self.both, self.kt, self.share  # no longer needed

    def find(self, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of the names."""
        slot = np.searchsorted(self.nodes, want)
        slot[slot == len(self.nodes)] = 0
        return slot, self.nodes[slot] == want if len(self.nodes) else np.zeros(len(want), bool)


def _grouped(names: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct names, in order, and the sums of the values (names in order already)."""
    if not len(names):
        return (names, *values)
    first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    return (names[first], *[np.add.reduceat(v, first) for v in values])


class Subtrees:
    """The subtrees of one shard, from depth ``root`` to ``depth``, weighed from the leaves up."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, root: int = ROOT, depth: int = DEPTH):
        order = np.argsort(keys)
        self.keys, counts = keys[order].astype(np.int64), counts[order].astype(np.int64)
        self.root, self.depth = root, depth
        pairs = {depth: (self.keys, counts)}
        for d in range(depth - 1, root - 1, -1):
            k, n = pairs[d + 1]
            k = k & _mask(d + 1)
            order = np.argsort(k, kind="stable")
            pairs[d] = _grouped(k[order], n[order])
        self.levels: list[dict[int, Level]] = []
        self.sums: list[tuple[np.ndarray, ...]] = []  # by bit: parent of the roots, log weighted, ones, both
        for b in range(8):
            level = {d: Level(*_grouped(k >> (8 - b), n * (k >> (7 - b) & 1), n)) for d, (k, n) in pairs.items()}
            explained = None
            for d in range(depth, root, -1):
                up = np.searchsorted(level[d - 1].nodes, level[d].nodes & _mask(d - 1, b))
                explained = np.bincount(up, weights=level[d].weigh(explained), minlength=len(level[d - 1].nodes))
            weighted = level[root].weigh(explained)
            above = level[root].nodes & _mask(root - 1, b)
            order = np.argsort(above, kind="stable")
            self.sums.append(_grouped(above[order], weighted[order], level[root].ones[order], level[root].both[order]))
            self.levels.append(level)

    def descend(self, top: list[dict[int, Level]]) -> Subtrees:
        """Predictions of all nodes, from the weighed contexts above the roots."""
        self.bits = np.zeros(len(self.keys))
        for b, level in enumerate(self.levels):
            level.update(top[b])
            for d in range(self.root, self.depth + 1):
                up, _ = level[d - 1].find(level[d].nodes & _mask(d - 1, b))
                level[d].descend(level[d - 1].offset[up], level[d - 1].slope[up])
            if len(self.keys):
                name = self.keys >> (8 - b)
                where = np.cumsum(np.concatenate([[0], name[1:] != name[:-1]]))
                p = level[self.depth].offset[where]
                self.bits -= np.log2(np.where(self.keys >> (7 - b) & 1 == 1, p, 1 - p))
        return self

    def code_lengths(self, keys: np.ndarray) -> np.ndarray:
        """Bits of each (context, byte) key: every decision is predicted by the deepest node that has met it."""
        keys = keys.astype(np.int64)
        bits = np.zeros(len(keys))
        met = np.zeros(len(keys), dtype=bool)
        if len(self.keys):
            slot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            met = self.keys[slot] == keys
            bits[met] = self.bits[slot[met]]
        new = np.flatnonzero(~met)
        for b, level in enumerate(self.levels):
            p = np.full(len(new), 0.5)
            todo = np.arange(len(new))
            for d in range(self.depth, -1, -1):
                slot, ok = level[d].find((keys[new[todo]] & _mask(d + 1)) >> (8 - b))
                at = slot[ok]
                p[todo[ok]] = level[d].offset[at] + 0.5 * level[d].slope[at]
                todo = todo[~ok]
            bits[new] -= np.log2(np.where(keys[new] >> (7 - b) & 1 == 1, p, 1 - p))
        return bits


def weigh_top(sums: list[tuple[np.ndarray, ...]], root: int = ROOT) -> list[dict[int, Level]]:
    """The contexts above the roots, by bit and depth, from the sums by the roots' parents (in order of the parents)."""
    top = []
    for b, (nodes, explained, ones, both) in enumerate(sums):
        level = {}
        for d in range(root - 1, -1, -1):
            level[d] = Level(nodes, ones, both)
            weighted = level[d].weigh(explained)
            if d:
                above = nodes & _mask(d - 1, b)
                order = np.argsort(above, kind="stable")
                nodes, explained, ones, both = _grouped(above[order], weighted[order], ones[order], both[order])
        level[0].descend(0.0, 1.0)
        for d in range(1, root):
            up, _ = level[d - 1].find(level[d].nodes & _mask(d - 1, b))
            level[d].descend(level[d - 1].offset[up], level[d - 1].slope[up])
        top.append(level)
    return top


def _shard_table(shards: int) -> np.ndarray:
    """Shard of each context of ``ROOT`` bytes, by its crc32."""
    table = np.array([zlib.crc32(c.to_bytes(ROOT, "big")) % shards for c in range(1 << (8 * ROOT))])
    return table.astype(np.uint16 if shards <= 1 << 16 else np.int64)


def _binary_keys(column: pa.ChunkedArray) -> np.ndarray:
    """Keys of 8 big-endian bytes each as integers."""
    col = column.combine_chunks().cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], dtype=">i8", count=len(col), offset=int(off[0])).astype(np.int64)


def weighed_shards(counts: DataFrame) -> tuple[DataFrame, int, list[dict[int, Level]]]:
    """(one row a shard with its packed pairs, number of shards, the contexts above the roots)."""
    pairs = counts.where("kind = 0").select("key", "n")
    shards = max(1, -(-pairs.count() // SHARD_ENTRIES))
    dealt = pairs.withColumn("shard", F.pmod(F.crc32(F.substring("key", 8 - ROOT, ROOT)), F.lit(shards)).cast("int"))

    def run(table):
        keys, n = _binary_keys(table["key"]), table["n"].to_numpy()
        trees = Subtrees(keys, n)
        cols = {c: [] for c in ("bit", "node", "explained", "ones", "both")}
        for b, part in enumerate(trees.sums):
            for c, v in zip(("node", "explained", "ones", "both"), part, strict=True):
                cols[c].append(v)
            cols["bit"].append(np.full(len(part[0]), b, dtype=np.int32))
        out = {c: np.concatenate(v) for c, v in cols.items()}
        size = len(out["bit"]) + 1
        packed = [keys.astype("<i8").tobytes(), n.astype("<i8").tobytes()]
        return pa.table({"shard": pa.array(np.full(size, table["shard"][0].as_py(), dtype=np.int32)),
                         **{c: pa.array(np.append(v, -1).astype(v.dtype)) for c, v in out.items()},
                         "keys": pa.array([None] * (size - 1) + packed[:1], pa.binary()),
                         "counts": pa.array([None] * (size - 1) + packed[1:], pa.binary())})

    rows = written(dealt.repartition(2 * shards, "shard").groupBy("shard").applyInArrow(
        run, "shard int, bit int, node long, explained double, ones long, both long, keys binary, counts binary"), "subtrees")
    # one row for each bit position and context of ROOT - 1 bytes: bounded by the alphabet
    sums = rows.where("bit >= 0").groupBy("bit", "node").agg(*[F.sum(c).alias(c) for c in ("explained", "ones", "both")]).orderBy("bit", "node").toArrow()
    cols = [sums[c].to_numpy() for c in ("bit", "node", "explained", "ones", "both")]
    top = weigh_top([tuple(c[cols[0] == b] for c in cols[1:]) for b in range(8)])
    return rows.where("bit < 0").select("shard", "keys", "counts"), shards, top


def _text_blocks(docs: DataFrame) -> DataFrame:
    """(block, ids, ends, body), written: the rows in blocks of text, compressed (they are shuffled once)."""
    def run(batches):
        part, serial = TaskContext.get().partitionId(), 0
        ids, bodies, lens = [], [], []

        def block():
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 33) + serial]), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())),
                pa.array([np.cumsum(np.concatenate(lens))], pa.list_(pa.int64())), pa.array([pa.compress(b"".join(bodies), "zstd", asbytes=True)], pa.binary())],
                names=["block", "ids", "ends", "body"])

        for rows, raw, off in text_chunks(batches):
            if bodies and (sum(map(len, bodies)) + len(raw) > BLOCK_BYTES or sum(map(len, ids)) + rows.num_rows > BLOCK_ROWS):
                yield block()
                serial += 1
                ids, bodies, lens = [], [], []
            ids.append(rows.column(rows.schema.get_field_index("doc_id")).cast(pa.int64()))
            bodies.append(raw.tobytes())
            lens.append(np.diff(off))
        if bodies:
            yield block()

    return written(docs.select("doc_id", "text").mapInArrow(run, "block long, ids array<long>, ends array<long>, body binary"), "blocks")


def _block_chunks(ends: pa.Scalar, body: pa.Scalar):
    """(first row, bytes, offsets) of the chunks of a block."""
    off = np.concatenate([[0], ends.values.to_numpy()])
    raw = np.frombuffer(pa.decompress(body.as_buffer(), int(off[-1]), "zstd") if off[-1] else b"", dtype=np.uint8)
    lo = 0
    while lo < len(off) - 1:
        hi = max(int(np.searchsorted(off, off[lo] + CHUNK_BYTES, "right")) - 1, lo + 1)
        yield lo, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def _slices(keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(distinct keys, place in the slice, which distinct key is there) of slices of 2^16 keys.

    A key has 48 bits, so it is sorted together with its place as one number."""
    out = []
    for a in range(0, len(keys), 1 << 16):
        both = keys[a:a + (1 << 16)] << np.uint64(16)
        both |= np.arange(len(both), dtype=np.uint64)
        both.sort()
        key = both >> np.uint64(16)
        new = np.ones(len(key), dtype=bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        out.append((key[new].astype(np.int64), both.astype(np.uint16), (np.cumsum(new) - 1).astype(np.uint16)))
    return out


def _asked(found: list[np.ndarray], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys of a block, the order in which they are asked, the shard of each, in that order)."""
    keys = _distinct(np.concatenate(found))
    shard = table[keys >> 8 & _mask(ROOT)]
    order = np.argsort(shard, kind="stable")
    return keys, order, shard[order]


def _packed(keys: np.ndarray) -> bytes:
    """Rising keys as differences, byte planes one after the other: nearly all high planes are zeros and compress."""
    steps = np.diff(keys, prepend=0).astype("<i8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


def _answers(blocks: DataFrame, models: DataFrame, shards: int, top: list[dict[int, Level]]) -> DataFrame:
    """(block, shard, bits): code lengths (float32) of the keys that a block asks of a shard."""
    above = blocks.sparkSession.sparkContext.broadcast(pickle.dumps(top))  # bounded by the alphabet

    def ask(batches):
        table = _shard_table(shards)
        for batch in batches:
            for i in range(batch.num_rows):
                block, ends, body = (batch.column(c)[i] for c in range(3))
                keys, order, shard = _asked([_distinct(byte_keys(raw, off)[0]).astype(np.int64) for _, raw, off in _block_chunks(ends, body)], table)
                first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(shard[first].astype(np.int32)), pa.array(np.full(len(first), block.as_py())),
                    pa.array([_packed(k) for k in np.split(keys[order], first[1:])], pa.binary())], names=["shard", "block", "keys"])
                return_memory()

    def answer(batches):
        contexts = pickle.loads(above.value)
        at, trees = -1, None
        for batch in batches:
            for shard, block, keys, counts in zip(*[batch[c] for c in ("shard", "block", "keys", "counts")], strict=True):
                if shard.as_py() != at:  # the shard's model comes first, where it has one
                    trees = None
                    return_memory()
                    at, none = shard.as_py(), np.zeros(0, np.int64)
                    model = (none, none) if counts.as_py() is None else [np.frombuffer(c.as_buffer(), dtype="<i8") for c in (keys, counts)]
                    trees = Subtrees(*model).descend(contexts)
                if block.as_py() is not None:
                    bits = trees.code_lengths(_unpacked(keys.as_py())).astype(np.float32)
                    yield pa.RecordBatch.from_arrays([pa.array([block.as_py()]), pa.array([at], pa.int32()), pa.array([bits.tobytes()], pa.binary())],
                                                     names=["block", "shard", "bits"])
        return_memory()

    asked = blocks.select("block", "ends", "body").mapInArrow(ask, "shard int, block long, keys binary")
    rows = models.select("shard", F.lit(None).cast("long").alias("block"), "keys", "counts").unionByName(
        asked.withColumn("counts", F.lit(None).cast("binary")))
    return rows.repartition(2 * shards, "shard").sortWithinPartitions("shard", F.asc_nulls_first("block")).mapInArrow(answer, "block long, shard int, bits binary")


def _score_rows(blocks: DataFrame, answers: DataFrame, shards: int, head: pa.Table) -> DataFrame:
    """Per row: code length, tokens, and its words: those in ``head`` summed, the others listed."""
    names, values = head["key"].combine_chunks().cast(pa.large_binary()), head["log"].to_numpy()
    schema = "rid string, doc_id long, bits double, n_bytes long, n_tokens long, head_known long, head_log double, tail array<binary>"

    def score(block, ids, ends, body, parts, table):
        chunks = []
        for lo, raw, off in _block_chunks(ends, body):
            mine, ptr = byte_keys(raw, off)
            chunks.append((lo, raw, off, ptr, _slices(mine)))
        keys, order, _ = _asked([distinct for *_, slices in chunks for distinct, _, _ in slices], table)
        cost = np.empty(len(keys))
        cost[order] = np.concatenate([np.frombuffer(p, dtype=np.float32) for p in parts])
        while chunks:
            lo, raw, off, ptr, slices = chunks.pop(0)
            n = len(off) - 1
            bits = np.empty(ptr[-1])
            for i, (distinct, place, which) in enumerate(slices):
                bits[i << 16:][place] = cost[np.searchsorted(keys, distinct)][which]
            run_bits = np.concatenate([[0.0], np.cumsum(bits)])
            del bits, slices
            words = Words(raw, off, BLANK_WORD)
            which, found = words.distinct()
            place = pc.index_in(found, value_set=names)
            known = place.is_valid().to_numpy(zero_copy_only=False)[which] if words.n else np.zeros(0, bool)
            log = values[place.fill_null(0).to_numpy(zero_copy_only=False)][which] if words.n and len(values) else np.zeros(words.n)
            run_log = np.concatenate([[0.0], np.cumsum(np.where(known, log, 0.0))])
            run_known = np.concatenate([[0], np.cumsum(known)])
            rare = np.flatnonzero(~known)
            tail = pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, words.ptr).astype(np.int32)),
                                            found.take(pa.array(which[rare])).cast(pa.binary()) if len(rare) else pa.array([], pa.binary()))
            yield pa.RecordBatch.from_arrays([
                pa.array([f"{block}.{i}" for i in range(lo, lo + n)]), ids.values.slice(lo, n),
                pa.array(run_bits[ptr[1:]] - run_bits[ptr[:-1]]), pa.array(np.diff(ptr)), pa.array(np.diff(words.ptr).astype(np.int64) + 1),
                pa.array(run_known[words.ptr[1:]] - run_known[words.ptr[:-1]]), pa.array(run_log[words.ptr[1:]] - run_log[words.ptr[:-1]]), tail],
                names=["rid", "doc_id", "bits", "n_bytes", "n_tokens", "head_known", "head_log", "tail"])

    def run(batches):
        parts, table = [], _shard_table(shards)
        for batch in batches:
            for block, shard, bits, ids, ends, body in zip(*[batch[c] for c in ("block", "shard", "bits", "ids", "ends", "body")], strict=True):
                if shard.as_py() is not None:  # a block's answers come before its texts
                    parts.append(bits.as_py())
                else:
                    yield from score(block.as_py(), ids, ends, body, parts, table)
                    parts = []
                    return_memory()

    spread = max(blocks.sparkSession.sparkContext.defaultParallelism, blocks.count() // 4)
    empty = {"shard": "int", "bits": "binary", "ids": "array<long>", "ends": "array<long>", "body": "binary"}
    rows = answers.unionByName(blocks, allowMissingColumns=True).select("block", *[F.col(c).cast(t) for c, t in empty.items()])
    return rows.repartition(spread, "block").sortWithinPartitions("block", F.asc_nulls_last("shard")).mapInArrow(run, schema)


def scoring_report(docs: DataFrame, head_words: int = HEAD_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from rows whose crc32 of the doc_id modulo 10 is not 0.  A null text is scored as
    the empty one: its end mark alone.
    """
    counts = count_corpus(docs.where(~held_out("doc_id", 10, 0)))
    words = counts.where("kind = 1").select("key", "n")
    total = counts.where("kind > 0").agg(F.sum("n").alias("n"), F.sum(F.expr("case when n > 0 then 1 else 0 end")).alias("v"),
                                         F.sum(F.expr("case when kind = 2 then n else 0 end")).alias("ends")).collect()[0]
    n, v, ends = total["n"] or 0, total["v"] or 0, total["ends"] or 0
    floor = np.log10(0.1 * (v + 1) + n) if not n else np.log10(n + 0.1 * (v + 1))
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["p"]: r["c"] for r in words.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}
    head = words.where(F.col("n") >= 1 << _threshold(sizes, head_words)).toArrow()  # head_words at most
    head = head.append_column("log", pa.array(np.log10(head["n"].to_numpy().astype(float) + 0.1) - floor if head.num_rows else np.zeros(0)))
    models, shards, top = weighed_shards(counts)
    blocks = _text_blocks(docs)
    answers = written(_answers(blocks, models, shards, top), "answers")
    release(docs.sparkSession)  # the requests
    rows = written(_score_rows(blocks, answers, shards, head), "scored")
    release(docs.sparkSession)  # the texts
    tail = rows.select("rid", F.explode("tail").alias("key")).groupBy("rid", "key").agg(F.count(F.lit(1)).alias("uses"))
    seen = tail.join(words, "key", "left").groupBy("rid").agg(
        F.sum(F.when(F.col("n") > 0, F.col("uses")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("uses") * (F.log10(F.coalesce("n", F.lit(0)) + 0.1) - F.lit(float(floor)))).alias("tail_log"))
    end_log = float(np.log10(ends + 0.1) - floor)
    return rows.drop("tail").join(seen, "rid", "left").select(
        "doc_id", held_out("doc_id", 10, 0).alias("held_out"), "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("head_log") + F.coalesce("tail_log", F.lit(0.0)) + F.lit(end_log)).alias("base_score"),
        (-F.col("bits") * F.lit(float(np.log10(2.0)))).alias("score"),
        (F.col("bits") / F.col("n_bytes")).alias("bits_per_byte"))
