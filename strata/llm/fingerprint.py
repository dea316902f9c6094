"""Document fingerprints by content-defined chunking.

A gear hash runs over the bytes; a chunk ends where its top bits vanish.  Boundaries are
normalised: up to the normal size a stricter mask holds, beyond it a looser one, so
sizes gather around the normal.  Since a boundary depends on the 16 bytes before it
alone, an insertion moves boundaries only nearby.  A fingerprint is the set of the
chunks' digests, each with the chunk's length; likeness is containment: the length of
the common chunks over that of the smaller set.

Next documents are met by one range shuffle of the texts by doc_id: inside a range the
next row is at hand, and the last row of each range meets the first of the following
one in a small second pass.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BYTE_MIX, add_text_columns, mix64, powers, ranges, text_chunks, written

LEAST, NORMAL, MOST = 16, 32, 128   # chunk sizes in bytes; the gear hash looks back 16 bytes
STRICT_BITS, LOOSE_BITS = 6, 4
_DIGEST = np.uint64((1 << 40) - 1)

_FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def chunk_ends(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text of each chunk, end of each chunk), in order of text and position."""
    h = (BYTE_MIX[raw] >> np.uint64(17)).astype(np.uint32)
    for k in (1, 2, 4, 8):  # after these steps h holds the last 16 bytes, the k-th before shifted by k
        h[k:] += h[:-k] << np.uint32(k)
    loose = np.flatnonzero(h < np.uint32(1 << (32 - LOOSE_BITS))) + 1
    strict = np.flatnonzero(h < np.uint32(1 << (32 - STRICT_BITS))) + 1
    at, stop = off[:-1].astype(np.int64), off[1:].astype(np.int64)
    text = np.flatnonzero(at < stop)
    at, stop = at[text], stop[text]
    far = np.int64(len(raw) + 2 * MOST)
    strict, loose = np.append(strict, far), np.append(loose, far)
    texts, ends = [], []
    while len(at):  # one chunk of every text at a time
        first = strict[np.searchsorted(strict, at + LEAST)]
        second = loose[np.searchsorted(loose, at + NORMAL + 1)]
        end = np.where(first <= at + NORMAL, first, np.minimum(second, at + MOST))
        end = np.minimum(end, stop)
        texts.append(text)
        ends.append(end)
        go = end < stop
        at, stop, text = end[go], stop[go], text[go]
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    texts, ends = np.concatenate(texts), np.concatenate(ends)
    order = np.argsort(ends, kind="stable")
    return texts[order], ends[order]


def chunk_keys(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sorted distinct ``text << 48 | digest << 8 | length`` of all chunks (at most 65,536 texts)."""
    text, end = chunk_ends(raw, off)
    if not len(text):
        return np.zeros(0, np.uint64)
    start = np.concatenate([[0], end[:-1]])
    start = np.maximum(start, off[text])
    size = end - start
    pos = np.arange(len(raw)) - np.repeat(start, size)
    digest = mix64(np.add.reduceat(BYTE_MIX[raw] * powers(MOST + 1)[pos], start) + size.astype(np.uint64)) & _DIGEST
    return np.unique(text.astype(np.uint64) << np.uint64(48) | digest << np.uint64(8) | size.astype(np.uint64))


def _weights(keys: np.ndarray, n: int) -> np.ndarray:
    return np.bincount((keys >> np.uint64(48)).astype(np.int64), weights=(keys & np.uint64(255)).astype(float), minlength=n)


def containment(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Per text: common length over the smaller length; two empty sets are alike (1), an empty and another not (0)."""
    wa, wb = _weights(a, n), _weights(b, n)
    low = np.minimum(wa, wb)
    common = _weights(np.intersect1d(a, b, assume_unique=True), n)
    return np.where(low > 0, common / np.maximum(low, 1), np.where(wa == wb, 1.0, 0.0))


def _strings(keys: np.ndarray, n: int) -> list[str]:
    """Per text its chunks as 12 hex digits each (digest, length), ascending."""
    cut = np.searchsorted(keys, np.arange(n + 1).astype(np.uint64) << np.uint64(48))
    packed = keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return [packed[a:b].tobytes().hex() for a, b in zip(cut[:-1], cut[1:], strict=True)]


def fingerprints(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Appends ``fingerprint`` (string) to the rows; a null text counts as empty."""
    return add_text_columns(docs, lambda raw, off, rows: [_strings(chunk_keys(raw, off), len(off) - 1)], [("fingerprint", "string")], keep=keep)


def _compare(ids: pa.Array, raw: np.ndarray, off: np.ndarray) -> pa.RecordBatch:
    """Rows 0 .. n - 2 of n consecutive texts against the text that follows each."""
    n = len(off) - 2
    head = (raw & 0xC0) != 0x80
    chars = np.flatnonzero(head)
    c = np.searchsorted(chars, off)                      # code points before each text
    n_chars = np.diff(c)
    start = np.append(chars, len(raw))
    half = n_chars[:n] // 2
    own = start[np.minimum(c[1:n + 1] - half, len(chars))]
    own = np.where(half > 0, own, off[1:n + 1])          # own text up to here
    take = np.minimum(half, n_chars[1:n + 1])
    nxt = np.where(take < n_chars[1:n + 1], start[np.minimum(c[1:n + 1] + take, len(chars))], off[2:n + 2])
    begin = np.stack([off[:n], off[1:n + 1]], axis=1).ravel()
    size = np.stack([own - off[:n], nxt - off[1:n + 1]], axis=1).ravel()
    edited = raw[ranges(begin, size)]
    eoff = np.concatenate([[0], np.cumsum(size.reshape(-1, 2).sum(axis=1))]).astype(np.int64)
    keys, ekeys = chunk_keys(raw, off), chunk_keys(edited, eoff)
    shift = np.uint64(1 << 48)
    here = keys[: np.searchsorted(keys, np.uint64(n) << np.uint64(48))]
    after = keys[np.searchsorted(keys, shift):] - shift
    return pa.RecordBatch.from_arrays([
        ids.slice(0, n), pa.array(n_chars[:n]), pa.array([hashlib.sha256(edited[a:b].tobytes()).hexdigest() for a, b in zip(eoff[:-1], eoff[1:], strict=True)]),
        pa.array(_strings(here, n), pa.string()), pa.array(_strings(ekeys, n), pa.string()),
        pa.array(containment(here, ekeys, n)), pa.array(containment(here, after, n))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


_MOST_ROWS = 1 << 14        # texts compared at once
PARTITION_BYTES = 64 << 20  # text bytes of a range, at most on average
_SAMPLED = 16               # sampled keys for each range


def _next_rows(ordered: DataFrame) -> DataFrame:
    """Compare each row of a part with its next; the last row of each part is left out."""
    def run(batches):
        held = None  # part, id and bytes of the last row seen
        for rows, raw, off in text_chunks(batches):
            ids = rows.column(rows.schema.get_field_index("doc_id"))
            part = rows.column(rows.schema.get_field_index("part")).to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist() + [rows.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                for lo in range(a, b, _MOST_ROWS):
                    hi = min(b, lo + _MOST_ROWS)
                    r, o, i = raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], ids.slice(lo, hi - lo)
                    if held is not None and held[0] == part[lo]:
                        r = np.concatenate([held[2], r])
                        o = np.concatenate([[0], o + len(held[2])])
                        i = pa.concat_arrays([held[1], i])
                    if len(o) > 2:
                        yield _compare(i, r, o)
                    held = part[lo], pa.array(i.slice(len(i) - 1, 1).to_pylist(), i.type), r[o[-2]:].copy()

    return ordered.mapInArrow(run, _FIELDS)


def _parts(rows: DataFrame, parts: int) -> DataFrame:
    """Adds ``part``: the range of (doc_id, tie) that a row falls into, by bounds from a sample of
    about ``_SAMPLED`` keys a part."""
    n = rows.count()
    share = min(1.0, _SAMPLED * parts / max(1, n))
    keys = rows.select("id", "tie").where(F.pmod("tie", F.lit(1 << 30)) < int(share * (1 << 30))).toArrow().sort_by([("id", "ascending"), ("tie", "ascending")])
    step = max(1, keys.num_rows // parts)
    bound_id, bound_tie = keys["id"].to_numpy()[step::step], keys["tie"].to_numpy()[step::step]

    @F.pandas_udf("int")
    def part_of(ids: pd.Series, ties: pd.Series) -> pd.Series:
        ids, ties = ids.to_numpy(), ties.to_numpy()
        lo, hi = np.searchsorted(bound_id, ids, "left"), np.searchsorted(bound_id, ids, "right")
        for k in np.unique(lo[hi > lo]).tolist():  # ids that bounds share: the tie decides
            same = np.flatnonzero((lo == k) & (hi > lo))
            lo[same] += np.searchsorted(bound_tie[k:hi[same[0]]], ties[same], "right")
        return pd.Series(lo.astype(np.int32))

    return rows.withColumn("part", part_of("id", "tie"))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the next row by doc_id (nulls first; rows of one id in a fixed
    arbitrary order), after the last the first; a single row is its own next.  Null is the empty
    text; texts may be of any length; other columns of ``docs`` are not read.  The order among rows
    of one id follows the order in which ``docs`` yields them, so pass a stored table: it is read
    more than once.

    Texts are shuffled once, into ranges of (doc_id, tie).  The last row of a range meets the
    first of the next one apart, from a table with one row per range.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PARTITION_BYTES + 1)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
                       F.xxhash64(text, F.monotonically_increasing_id()).alias("tie"), text.alias("text"))
    rows = _parts(rows, parts)
    inner = _next_rows(rows.repartition("part").sortWithinPartitions("part", "id", "tie").select("doc_id", "part", "text"))
    place = F.struct("id", "tie", "doc_id")
    # two texts for each range, written once; only the ranges' numbers go through one task
    edges = written(rows.groupBy("part").agg(F.min_by("text", place).alias("first"), F.max_by("text", place).alias("last"),
                                             F.max(place)["doc_id"].alias("doc_id")), "edges")
    ranks = edges.select("part", F.row_number().over(Window.orderBy("part")).alias("rank"))
    n = edges.count()
    after = ranks.select(F.when(F.col("rank") == 1, F.lit(n)).otherwise(F.col("rank") - 1).alias("rank"), F.col("part").alias("next_part"))
    pairs = ranks.join(after, "rank").select("part", "next_part")

    def close(batches):
        for batch in batches:
            for i, a, b in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                a, b = a.encode(), b.encode()
                yield _compare(pa.array([i, None], pa.int64()), np.frombuffer(a + b, np.uint8), np.array([0, len(a), len(a) + len(b)]))

    following = edges.select(F.col("part").alias("next_part"), F.col("first").alias("next"))
    last = edges.join(pairs, "part").join(following, "next_part").select("doc_id", "last", "next").mapInArrow(close, _FIELDS)
    return inner.unionByName(last)
