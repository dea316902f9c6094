"""Exact substring deduplication: a depth-limited radix sort of suffixes.

Suffixes are only told apart through their first ``threshold`` bytes, so the groups
that a most-significant-digit radix sort ends with are exactly the repeated windows.
The passes are Spark groupings, each over what the pass before left in a group with
others:

1. first digit: an anchor gram of ``GRAM`` bytes.  Instead of at the window's start it
   is read where the window's grams have their smallest hash, leftmost of ties.  Equal
   windows read the same digit at the same place, and neighbouring windows share
   theirs, so one anchor row stands for a run of about 27 windows.  A plain first pass
   would shuffle a row for every byte of the corpus.
2. second digit: the whole stretch of text that the anchor's run of windows covers.
   Runs with equal stretches are equal window by window; all but the earliest go.
3. last digit, only for anchors that still meet several different stretches: their
   windows one by one, as (gram, place in the run, window).

Whatever a window meets, the earliest of its group (smallest doc_id, then position)
stays and the others' bytes are covered.  Digits are compared as 64-bit hashes; two
windows are called equal when gram and stretch, or gram, place and window hash agree
(128 bits).  Exact copies of a text are one row of the sort.

No group is gathered: digits are counted and their minimum taken with map-side
combining, and rows join that minimum on the digits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import expand_copies
from .common import BYTE_MIX, fresh, mix64, powers, ranges, release, text_chunks, written

THRESHOLD = 100
GRAM = 48
SEGMENT_BYTES = 1 << 18  # text bytes hashed at once, a hundred times as many in memory; longer texts go in pieces
_INVERSE = pow(0x9E3779B97F4A7C15, -1, 1 << 64)

_inverse_powers = np.ones(1, dtype=np.uint64)


def _inverse(n: int) -> np.ndarray:
    """Inverse powers of the hash base modulo 2**64."""
    global _inverse_powers
    if len(_inverse_powers) < n:
        steps = np.full(n, np.uint64(_INVERSE))
        steps[0] = 1
        _inverse_powers = np.multiply.accumulate(steps)
    return _inverse_powers[:n]


class Hashes:
    """Hashes of substrings of a byte buffer by prefix sums."""

    def __init__(self, raw: np.ndarray):
        self.sum = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(BYTE_MIX[raw] * powers(len(raw) + 1)[:len(raw)], dtype=np.uint64, out=self.sum[1:])
        self.inverse = _inverse(len(raw) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sum[end] - self.sum[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def _window_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` consecutive values."""
    span, low = 1, values
    while span * 2 <= size:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = size - span
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def anchors(raw: np.ndarray, off: np.ndarray, threshold: int, gram: int):
    """Runs of windows with a common anchor: (text, first window, last window, anchor, gram hash, stretch hash).

    Positions are in the chunk; windows never cross texts.
    """
    h = Hashes(raw)
    empty = np.zeros(0, np.int64)
    if len(raw) < threshold:
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), h
    at = np.arange(len(raw) - gram + 1)
    grams = h.of(at, at + gram)
    # the smallest hash wins, the leftmost of equal ones: low bits hold the position
    bits = max(1, int(len(raw)).bit_length())
    keyed = (grams >> np.uint64(bits)) << np.uint64(bits) | at.astype(np.uint64)
    low = _window_minimum(keyed, threshold - gram + 1)
    anchor = (low & np.uint64((1 << bits) - 1)).astype(np.int64)
    lens = np.diff(off)
    n_win = np.maximum(lens - threshold + 1, 0)
    window = ranges(off[:-1], n_win)
    text = np.repeat(np.arange(len(lens)), n_win)
    anchor = anchor[window]
    if not len(window):
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), h
    new = np.ones(len(window), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    lo, hi, a = window[first], window[last], anchor[first]
    return text[first], lo, hi, a, grams[a], h.of(lo, hi + threshold), h


def _pieces(raw: np.ndarray, off: np.ndarray, threshold: int, size: int):
    """The chunk as it is, or, for one very long text, overlapping pieces: (raw, off, shift)."""
    if len(off) > 2 or len(raw) <= 2 * size:
        yield raw, off, 0
        return
    for a in range(0, len(raw), size):  # windows that start in [a, a + size)
        b = min(len(raw), a + size + threshold - 1)
        yield raw[a:b], np.array([0, b - a]), a


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.astype(np.uint64).view(np.int64))


def units(docs: DataFrame) -> DataFrame:
    """Equal rows folded: (id, tx, row, copies), hash-partitioned by (id, tx).

    ``id`` is the doc_id (null: the smallest long, so it sorts first) and ``tx`` a hash of the
    whole row, which orders and tells apart rows with one doc_id.  Folding combines on the
    map side, so copies of one row never gather.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(key.alias("id"), F.xxhash64(*docs.columns).alias("tx"), F.struct(*docs.columns).alias("row"))
    return rows.groupBy("id", "tx").agg(F.first("row").alias("row"), F.count(F.lit(1)).alias("copies"))


def _names(docs: DataFrame) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.select(key.alias("id"), F.xxhash64(*docs.columns).alias("tx"), "text")


_RUN = "id long, tx long, lo long, n int, lead int, g long"


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _anchor_rows(docs: DataFrame, threshold: int, gram: int) -> DataFrame:
    """First two digits of every run of windows, combined inside each chunk.

    Of equal runs of a chunk only the earliest goes on; the others are covered, and leave
    as rows with ``lead`` = -1 whose g spreads them over the tasks.  The same run of a
    repeated row (equal id, tx and lo) is the same place, not another copy: it goes on once.
    """
    def run(batches):
        for rows, raw, off in text_chunks(batches, limit=SEGMENT_BYTES):
            ids, tx = _column(rows, "id"), _column(rows, "tx")
            for r, o, shift in _pieces(raw, off, threshold, SEGMENT_BYTES):
                text, lo, hi, a, g, s, _ = anchors(r, o, threshold, gram)
                n, lead = (hi - lo).astype(np.int32), (a - lo).astype(np.int32)
                lo = lo - o[text] + shift
                order = np.lexsort((lo, tx[text], ids[text], s, g))
                alike = lambda *cols: np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in cols])
                again, twice = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
                again[1:] = alike(g, s)
                twice[1:] = alike(g, s, ids[text], tx[text], lo)
                lead[order[again]] = -1
                one = np.sort(order[~twice])
                text, lo, n, lead, g, s = text[one], lo[one], n[one], lead[one], g[one], s[one]
                spread = np.where(lead < 0, mix64(ids[text].view(np.uint64) + lo.view(np.uint64)), g)
                yield pa.RecordBatch.from_arrays([
                    _signed(spread), _signed(s), pa.array(ids[text]), pa.array(tx[text]), pa.array(lo), pa.array(n), pa.array(lead)],
                    names=["g", "s", "id", "tx", "lo", "n", "lead"])

    return _names(docs).mapInArrow(run, "g long, s long, id long, tx long, lo long, n int, lead int")


def _sort_runs(rows: DataFrame) -> DataFrame:
    """Decide runs by their first two digits; rows come sorted by (g, s, id, tx, lo).

    Out come covered runs (``lead`` = -1) and, where one gram meets several stretches, the
    earliest run of each stretch (``lead`` >= 0), whose windows the third pass looks at.
    """
    def run(batches):
        key = None       # (g, s, id, tx, lo) of the earliest run of the last stretch
        held = None      # the first run of the last gram, while it has met one stretch only
        for batch in batches:
            if not batch.num_rows:
                continue
            g, s, i, t, lo = (_column(batch, c) for c in ("g", "s", "id", "tx", "lo"))
            lead = _column(batch, "lead")
            done = lead < 0
            live = np.flatnonzero(~done)
            out = [batch.filter(pa.array(done)).select(["id", "tx", "lo", "n", "lead", "g"])] if done.any() else []
            if len(live):
                b = batch.take(pa.array(live)).select(["id", "tx", "lo", "n", "lead", "g"])
                g, s, i, t, lo = g[live], s[live], i[live], t[live], lo[live]
                new_g, new_s = np.ones(len(g), dtype=bool), np.ones(len(g), dtype=bool)
                new_g[1:] = g[1:] != g[:-1]
                new_s[1:] = new_g[1:] | (s[1:] != s[:-1])
                if key is not None:
                    new_g[0] = g[0] != key[0]
                    new_s[0] = new_g[0] or s[0] != key[1]
                first = np.maximum.accumulate(np.where(new_s, np.arange(len(g)), -1))
                old = key or (0, 0, 0, 0, 0)
                same = [np.where(first >= 0, x[first], y) == x for x, y in ((i, old[2]), (t, old[3]), (lo, old[4]))]
                covered = ~new_s & ~(same[0] & same[1] & same[2])
                if covered.any():
                    c = b.filter(pa.array(covered))
                    out.append(c.set_column(4, "lead", pa.array(np.full(c.num_rows, -1, np.int32))))
                # grams with several stretches
                group = np.cumsum(new_g)               # 0: goes on from the batch before
                stretches = np.bincount(group, weights=new_s, minlength=group[-1] + 1)
                if held is not None and group[0] == 0 and stretches[0] > 0:
                    out.append(held)
                    held = None
                if key is not None and group[0] == 0:
                    stretches[0] += 1
                many = new_s & (stretches[group] > 1)
                if many.any():
                    out.append(b.filter(pa.array(many)))
                if group[-1] > 0 or held is None:
                    tail = np.flatnonzero(new_s & (group == group[-1]))
                    if group[-1] > 0:
                        held = b.slice(int(tail[0]), 1) if stretches[group[-1]] == 1 else None
                f = int(first[-1])
                key = (g[-1], s[-1], i[f], t[f], lo[f]) if f >= 0 else key
            yield from out

    ordered = rows.repartition("g").sortWithinPartitions("g", "s", "id", "tx", "lo")
    return ordered.mapInArrow(run, _RUN)


def _window_rows(texts: DataFrame, threshold: int) -> DataFrame:
    """The windows of each text's listed runs: (h, w, id, tx, at); h and w hold 128 bits of digits."""
    def run(batches):
        for rows, raw, off in text_chunks(batches, limit=SEGMENT_BYTES):
            lists = rows.column(rows.schema.get_field_index("runs"))
            flat = lists.flatten()
            g, lo, n, lead = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            ids, tx = _column(rows, "id"), _column(rows, "tx")
            h = Hashes(raw)
            for a in range(0, len(g), 1 << 14):  # bounded output batches
                part = slice(a, a + (1 << 14))
                count = n[part].astype(np.int64) + 1
                run_of = np.repeat(np.arange(len(count)), count)
                at = ranges(lo[part], count)
                place = at - (lo[part] + lead[part])[run_of]
                who = text[part][run_of]
                start = off[who] + at
                digits = mix64(g[part].view(np.uint64)[run_of] + mix64(place.view(np.uint64)))
                yield pa.RecordBatch.from_arrays([_signed(digits), _signed(h.of(start, start + threshold)), pa.array(ids[who]),
                                                  pa.array(tx[who]), pa.array(at)], names=["h", "w", "id", "tx", "at"])

    return texts.mapInArrow(run, "h long, w long, id long, tx long, at long")


def _sort_windows(rows: DataFrame) -> DataFrame:
    """Covered windows (id, tx, lo, n = 0): all but the earliest of equal (h, w)."""
    def run(batches):
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, w, i, t, at = (_column(batch, c) for c in ("h", "w", "id", "tx", "at"))
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
            if key is not None:
                new[0] = (h[0], w[0]) != key[:2]
            first = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))
            old = key or (0, 0, 0, 0, 0)
            same = [np.where(first >= 0, x[first], y) == x for x, y in ((i, old[2]), (t, old[3]), (at, old[4]))]
            covered = ~new & ~(same[0] & same[1] & same[2])
            f = int(first[-1])
            if f >= 0:
                key = (h[-1], w[-1], i[f], t[f], at[f])
            if covered.any():
                yield pa.RecordBatch.from_arrays([pa.array(i[covered]), pa.array(t[covered]), pa.array(at[covered]),
                                                  pa.array(np.zeros(int(covered.sum()), np.int32))], names=["id", "tx", "lo", "n"])

    ordered = rows.repartition("h", "w").sortWithinPartitions("h", "w", "id", "tx", "at")
    return ordered.mapInArrow(run, "id long, tx long, lo long, n int")


def covered_units(docs: DataFrame, threshold: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """Units of ``docs`` with the runs of covered windows of each: (id, tx, row, copies, cover).

    ``cover``: array of (lo, n): the n + 1 windows from byte lo on are covered.
    """
    if not 0 < gram <= threshold <= 255:
        raise ValueError("0 < gram <= threshold <= 255")
    runs = written(_sort_runs(_anchor_rows(docs, threshold, gram)), "runs")
    release(docs.sparkSession)
    unsure = (runs.where("lead >= 0").groupBy("id", "tx")
              .agg(F.collect_list(F.struct("g", "lo", "n", "lead")).alias("runs")))
    windows = written(_sort_windows(_window_rows(_names(docs).join(unsure, ["id", "tx"]), threshold)), "windows")
    release(docs.sparkSession)
    cover = (runs.where("lead < 0").select("id", "tx", "lo", "n").unionByName(windows)
             .groupBy("id", "tx").agg(F.collect_set(F.struct("lo", "n")).alias("cover")))  # a repeated row's runs once
    return units(docs).join(cover, ["id", "tx"], "left")


def _covered(rows: pa.RecordBatch, off: np.ndarray, size: int, threshold: int, column: str = "cover") -> np.ndarray:
    """Boolean per byte of the chunk: does a covered window hold it?"""
    lists = rows.column(rows.schema.get_field_index(column))
    lists = lists.fill_null([]) if lists.null_count else lists
    flat = lists.flatten()
    text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    lo = flat.field(0).to_numpy(zero_copy_only=False) + off[text]
    hi = lo + flat.field(1).to_numpy(zero_copy_only=False) + threshold
    step = np.zeros(size + 1, dtype=np.int64)
    np.add.at(step, lo, 1)
    np.add.at(step, hi, -1)
    return np.cumsum(step)[:-1] > 0


def repeats_report(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte is removed when a string of ``threshold`` bytes that covers it also starts
    earlier (smaller doc_id; null doc_ids first; or further left in the same text).
    Of equal rows the first counts as the earliest.  Null is the empty text.
    """
    found = covered_units(docs.select("doc_id", "text"), threshold)
    source = found.select("id", "tx", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), "copies", "cover")

    def run(batches):
        for rows, raw, off in text_chunks(batches, limit=SEGMENT_BYTES):
            gone = _covered(rows, off, len(raw), threshold)
            total = np.concatenate([[0], np.cumsum(gone)])
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            starts = off[:-1][np.diff(off) > 0]
            edge[starts] = gone[starts]
            spans = np.concatenate([[0], np.cumsum(edge)])
            digest = [hashlib.sha256(raw[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(off[:-1], off[1:], strict=True)]
            whole = [hashlib.sha256(raw[a:b].tobytes() if b - a < threshold else b"").hexdigest() for a, b in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                rows.column(rows.schema.get_field_index("doc_id")), rows.column(rows.schema.get_field_index("copies")),
                pa.array(np.diff(off)), pa.array(total[off[1:]] - total[off[:-1]]), pa.array(spans[off[1:]] - spans[off[:-1]]),
                pa.array(digest), pa.array(whole)],
                names=["doc_id", "copies", "n_bytes", "n_removed", "n_spans", "kept_sha256", "copy_sha256"])

    one = written(source.mapInArrow(run, "doc_id long, copies long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, copy_sha256 string"), "repeats")
    every = expand_copies(one, "copies", "_copy")
    again = (F.col("_copy") > 1) & (F.col("n_bytes") >= threshold)  # a further copy is covered whole
    return every.select("doc_id", "n_bytes", F.when(again, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
                        F.when(again, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
                        F.when(F.col("_copy") > 1, F.col("copy_sha256")).otherwise(F.col("kept_sha256")).alias("kept_sha256"))


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; every row stays.

    A character goes when all its bytes are covered.  ``n_chars``, where there is such a
    column, is counted anew; a null text stays null.  Columns may have any names.
    """
    found = covered_units(docs, threshold)
    cols = docs.columns
    copies, cover, copy = fresh(cols, "_copies", "_cover", "_copy")
    source = found.select(*[F.col("row")[c].alias(c) for c in cols], F.col("copies").alias(copies), F.col("cover").alias(cover))

    def run(batches):
        for rows, raw, off in text_chunks(batches, limit=SEGMENT_BYTES):
            gone = _covered(rows, off, len(raw), threshold, cover)
            head = (raw & 0xC0) != 0x80
            chars = np.flatnonzero(head)
            if len(chars):
                keep_char = np.add.reduceat((~gone).astype(np.int64), chars) > 0
                gone = ~np.repeat(keep_char, np.diff(np.append(chars, len(raw))))
            null = rows.column(rows.schema.get_field_index("text")).is_null().to_pylist()
            left = [None if z else raw[a:b][~gone[a:b]].tobytes().decode() for a, b, z in zip(off[:-1], off[1:], null, strict=True)]
            out = [pa.array(left, pa.string()) if c == "text" else rows.column(rows.schema.get_field_index(c)) for c in [*cols, copies]]
            yield pa.RecordBatch.from_arrays(out, names=[*cols, copies])

    shape = source.drop(cover).schema
    one = written(source.mapInArrow(run, shape), "kept")
    again = (F.col(copy) > 1) & (F.octet_length("text") >= threshold)
    every = expand_copies(one, copies, copy).withColumn("text", F.when(again, F.lit("")).otherwise(F.col("text")))
    if "n_chars" in cols:
        kind = docs.schema["n_chars"].dataType
        every = every.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))
    return every.select(*cols)
