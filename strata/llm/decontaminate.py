"""Benchmark decontamination over a distributed positional inverted index.

1. ``build_index`` turns the documents into index segments, one per few megabytes
   of text, and writes them to the shared folder: a segment has its terms, their
   postings (word positions, ascending, documents kept apart by a gap) and its
   documents.  Every term is stored, so one index answers any test set.  Segments are
   made and read without a shuffle.
2. Corpus frequencies of a block's terms are summed over all segments.
3. Test items are cut into windows.  Each window's terms are ordered from the
   rarest: the rarest term's postings, shifted by its offset in the window, are the
   candidates, and every further term's shifted list is intersected with them.
   What is left are the exact phrase matches.
4. ``proximity`` matches: every term of the window lies within ``slop`` words of an
   occurrence of the window's rarest term.

Test items are a stated query set; they are taken in blocks of a bounded number of
words (one item at least).  A block is sent to every segment, its matches are written,
and it is freed before the next is fetched: the driver holds one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORD, Words, fresh, ranges, scratch, text_chunks, written

WINDOW = 10
WINDOW_GAP = 1 << 10  # positions between two documents; windows and slop are shorter
SEGMENT_BYTES = 2 << 20
BLOCK_WORDS = 100_000  # words of test items in one broadcast block

SEGMENT_SCHEMA = "segment long, doc_id array<long>, n_words array<long>, terms array<binary>, counts array<int>, postings binary"


class Queries:
    """Windows of a block of test items over the block's distinct terms."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        texts = pa.table({"text": pa.array([t for _, t in items], pa.string())}).to_batches()
        terms: dict[bytes, int] = {}
        owner, seqs = [], []
        at = 0
        for rows, raw, off in text_chunks(iter(texts)):
            words = Words(raw, off, ALNUM_WORD)
            ids, names = words.distinct()
            local = np.array([terms.setdefault(b, len(terms)) for b in names.to_pylist()], dtype=np.int64)
            ids = local[ids] if words.n else np.zeros(0, np.int64)
            for i in range(rows.num_rows):
                owner.append(items[at + i][0])
                seqs.append(ids[words.ptr[i]:words.ptr[i + 1]])
            at += rows.num_rows
        self.terms = list(terms)
        self.item_ids = sorted(set(owner))
        index = {k: i for i, k in enumerate(self.item_ids)}
        item, start, length, flat = [], [], [], []
        base = 0
        for k, s in zip(owner, seqs, strict=True):
            size = min(len(s), window)
            n = len(s) - size + 1 if size else 0
            item.append(np.full(n, index[k]))
            start.append(base + np.arange(n))
            length.append(np.full(n, size))
            flat.append(s)
            base += len(s)
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        self.item, self.start, self.length, self.flat = join(item), join(start), join(length), join(flat)
        self.window = window

    def rank(self, frequency: dict[bytes, int]) -> Queries:
        """Fix the order in which each window's terms are met: rarest in the corpus first.

        A window with a term that the corpus lacks cannot occur and is left out."""
        freq = np.array([frequency.get(t, 0) for t in self.terms], dtype=np.int64)
        # offsets of the window padded with its first one
        step = np.arange(self.window)
        off = np.where(step < self.length[:, None], step, 0) if len(self.start) else np.zeros((0, self.window), np.int64)
        term = self.flat[self.start[:, None] + off] if len(self.start) else off
        f = freq[term] if len(self.terms) else term
        live = (f > 0).all(axis=1)
        self.item, self.length, off, term, f = self.item[live], self.length[live], off[live], term[live], f[live]
        order = np.argsort(f, axis=1, kind="stable")
        self.off = np.take_along_axis(off, order, axis=1).astype(np.int32)
        self.term = np.take_along_axis(term, order, axis=1).astype(np.int32)
        del self.start, self.flat
        return self


def _packed(pos: np.ndarray) -> bytes:
    """Postings as differences, byte planes one after the other: the high planes are nearly all equal and compress."""
    return np.diff(pos.astype("<i4"), prepend=np.int32(0)).astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i4").ravel(), dtype=np.int64)


def build_index(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write the index segments of ``docs`` (doc_id, text) and return the written table.

    A null text has no words.  A text longer than ``segment_bytes`` is a segment of its own.
    """
    def run(batches):
        part = TaskContext.get().partitionId()
        serial = 0
        for rows, raw, off in text_chunks(batches, limit=segment_bytes):
            words = Words(raw, off, ALNUM_WORD)
            n_words = np.diff(words.ptr)
            ids, names = words.distinct()
            pos = np.arange(words.n) + np.repeat(np.arange(rows.num_rows) * WINDOW_GAP, n_words)
            order = np.argsort(ids.astype(np.int32), kind="stable")
            ids, pos = ids[order], pos[order]
            have, counts = np.unique(ids, return_counts=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([part << 32 | serial], pa.int64()),
                pa.array([rows.column(rows.schema.get_field_index("doc_id")).to_pylist()], pa.list_(pa.int64())),
                pa.array([n_words], pa.list_(pa.int64())),
                pa.ListArray.from_arrays(pa.array([0, len(have)], pa.int32()), names.take(pa.array(have)).cast(pa.binary()) if words.n else pa.array([], pa.binary())),
                pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([_packed(pos)], pa.binary()),
            ], names=["segment", "doc_id", "n_words", "terms", "counts", "postings"])
            serial += 1

    return written(docs.select("doc_id", "text").mapInArrow(run, SEGMENT_SCHEMA), "index")


class Segment:
    """Postings of one segment for the terms of a query block."""

    def __init__(self, row: dict, asked: pa.Array):
        self.n_words = row["n_words"].values.to_numpy()
        self.doc_start = np.cumsum(self.n_words) - self.n_words + np.arange(len(self.n_words)) * WINDOW_GAP
        counts = row["counts"].values.to_numpy().astype(np.int64)
        local = pc.index_in(row["terms"].values, value_set=asked).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        pos = _unpacked(row["postings"].as_py())
        begin = np.cumsum(counts) - counts
        keep = np.flatnonzero(local >= 0)
        keep = keep[np.argsort(local[keep])]
        take = ranges(begin[keep], counts[keep])
        self.count = np.zeros(len(asked), np.int64)
        self.count[local[keep]] = counts[keep]
        self.begin = np.cumsum(self.count) - self.count
        self.pos = pos[take]
        self.key = np.repeat(np.arange(len(asked)), self.count) << 40 | self.pos  # ascending

    def candidates(self, q: Queries) -> tuple[np.ndarray, np.ndarray]:
        """(window, position) of each posting of each window's rarest term."""
        rare = q.term[:, 0]
        live = np.flatnonzero((self.count[q.term] > 0).all(axis=1))
        window = np.repeat(live, self.count[rare[live]])
        return window, self.pos[ranges(self.begin[rare[live]], self.count[rare[live]])]

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_start, pos, "right") - 1

    def phrases(self, q: Queries) -> tuple[np.ndarray, np.ndarray]:
        """(window, start position) of every exact occurrence."""
        window, pos = self.candidates(q)
        start = pos - q.off[window, 0]
        for k in range(1, q.term.shape[1]):
            if not len(window):
                break
            want = q.term[window, k].astype(np.int64) << 40 | np.maximum(start + q.off[window, k], 0)
            at = np.searchsorted(self.key, want)
            hit = (at < len(self.key)) & (self.key[np.minimum(at, len(self.key) - 1)] == want) & (start >= 0)
            window, start = window[hit], start[hit]
        return window, start

    def near(self, q: Queries, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, position of its rarest term) with all its terms within ``slop`` words."""
        window, pos = self.candidates(q)
        for k in range(1, q.term.shape[1]):
            if not len(window):
                break
            term = q.term[window, k].astype(np.int64) << 40
            at = np.searchsorted(self.key, term | np.maximum(pos - slop, 0))
            hit = (at < len(self.key)) & (self.key[np.minimum(at, len(self.key) - 1)] <= (term | (pos + slop)))
            window, pos = window[hit], pos[hit]
        return window, pos


def term_frequencies(index: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """Corpus frequency of the given terms; as many rows as the query block has terms."""
    spark = index.sparkSession
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("p")).select(F.col("p.terms").alias("term"), F.col("p.counts").alias("n"))
    wanted = spark.createDataFrame([(bytearray(t),) for t in terms], "term binary")
    found = pairs.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))
    return {bytes(r["term"]): r["n"] for r in found.collect()}


def query_blocks(items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Queries]:
    """The test items in blocks of about ``block_words`` words; rows with a null id or text
    are left out, equal ids count as one item."""
    items = items.where("item_id is not null and text is not null").select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    blocks = size // (2 * block_words) + 1  # a word has two bytes at least, its blank included
    spread = items.withColumn("_b", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for b in range(blocks):
        rows = sorted((r["item_id"], r["text"]) for r in spread.where(F.col("_b") == b).collect())
        yield Queries(rows, window)


def matches(index: DataFrame, queries: Queries, slop: int | None = None) -> DataFrame:
    """Runs of matches: segment, doc (index in the segment), doc_id, item_id, first word, end word, kind.

    ``kind`` is ``phrase`` (exact windows, adjacent ones joined) or, when ``slop`` is
    given, ``near``.
    """
    asked = pa.array(queries.terms, pa.binary())
    item_ids = np.array(queries.item_ids, dtype=np.int64)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i] for c in batch.schema.names}
                seg = Segment(row, asked)
                out = []
                if len(queries.item):
                    window, start = seg.phrases(queries)
                    out.append(("phrase", _runs(queries.item[window], start, start + queries.length[window])))
                    if slop is not None:
                        window, pos = seg.near(queries, slop)
                        out.append(("near", _runs(queries.item[window], np.maximum(pos - slop, 0), pos + slop + 1)))
                for kind, (item, lo, hi) in out:
                    doc = seg.doc_of(lo if kind == "phrase" else (lo + hi - 1) // 2)
                    base = seg.doc_start[doc]
                    lo, hi = np.maximum(lo - base, 0), np.minimum(hi - base, seg.n_words[doc])
                    ids = row["doc_id"].values
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(item), row["segment"].as_py())), pa.array(doc.astype(np.int32)),
                        ids.take(pa.array(doc)), pa.array(item_ids[item]),
                        pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array([kind] * len(item), pa.string()),
                    ], names=["segment", "doc", "doc_id", "item_id", "first", "end", "kind"])

    return index.mapInArrow(run, "segment long, doc int, doc_id long, item_id long, first int, end int, kind string")


def _runs(item: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join overlapping and adjacent intervals of one item (documents lie a gap apart)."""
    if not len(item):
        return item, lo, hi
    order = np.lexsort((lo, item))
    item, lo, hi = item[order], lo[order], hi[order]
    new = np.ones(len(item), dtype=bool)
    new[1:] = (item[1:] != item[:-1]) | (lo[1:] > np.maximum.accumulate(hi + (item << 40))[:-1] - (item[:-1] << 40))
    first = np.flatnonzero(new)
    return item[first], lo[first], np.maximum.reduceat(hi, first)


def find_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(index, match runs) of all test items over all documents."""
    if window >= WINDOW_GAP or (slop or 0) >= WINDOW_GAP // 2:
        raise ValueError("window and slop must be shorter than the gap between documents")
    index = build_index(docs)
    return index, search(index, items, window, slop)


def search(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int | None = None) -> DataFrame:
    """Match runs of all test items in a stored index: one block of items at a time, its matches written."""
    spark = index.sparkSession
    path, found = scratch(spark, "matches"), None
    batched = "spark.sql.parquet.enableNestedColumnVectorizedReader"
    before = spark.conf.get(batched)
    spark.conf.set(batched, "false")  # a segment is a row of a megabyte: one at a time, not thousands as one batch
    try:
        for q in query_blocks(items, window):
            found = matches(index, q.rank(term_frequencies(index, q.terms)), slop)
            found.write.mode("append").parquet(path)
    finally:
        spark.conf.set(batched, before)
    return spark.read.schema(found.schema).parquet(path)


def contamination_report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Repeated doc_ids and texts keep one row each; null and empty texts have no words.
    """
    index, found = find_matches(docs, items, window)
    all_docs = index.select("segment", F.posexplode(F.arrays_zip("doc_id", "n_words")).alias("doc", "d")) \
        .select("segment", "doc", F.col("d.doc_id").alias("doc_id"), F.col("d.n_words").alias("n_words"))
    # the union of intervals: walk them by start, adding what lies beyond the furthest end so far
    spans = F.array_sort(F.collect_set(F.struct("first", "end")))
    covered = F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["to"], s["first"]))).alias("n"), F.greatest(a["to"], s["end"]).alias("to")))["n"]
    names = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    per_doc = found.groupBy("segment", "doc").agg(covered.cast("long").alias("n_hit"), names.alias("names"))
    return (all_docs.join(per_doc, ["segment", "doc"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("names", ","), F.lit("")), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated")))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows whose text holds a window of a test item (a null text is clean).

    Rows are judged by their text alone: repeated rows share their fate.  Columns may have any names.
    """
    name = F.xxhash64("text")
    report = contamination_report(docs.where("text is not null").select(name.alias("doc_id"), "text"), items, window)
    dirty, = fresh(docs.columns, "dirty_text")
    hits = report.where("contaminated").select(F.col("doc_id").alias(dirty)).distinct()
    return docs.join(hits, name == F.col(dirty), "left_anti")
