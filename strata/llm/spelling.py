"""Spelling variants: Bloom-guided neighbourhoods of the vocabulary.

1. Words are counted in text chunks and summed by Spark: the vocabulary, written once.
2. The words of each length go into blocked Bloom filters, built by OR-ing block bits.  A length
   with many words has several filters, told apart by the hash.  Filters are broadcast in
   waves of ``WAVE_BYTES`` at most, however large the vocabulary is.
3. For each word the edits that lead to a shorter word or to a later letter are probed: all
   deletions, and replacements by larger letters.  So each near pair is met once, from one side;
   an insertion is a deletion from the other.  Hashes of edits follow from the word's own
   (polynomial) hash, no string is made.
4. Only positives are shuffled, as hashes, to a join with the vocabulary; the words that
   meet are compared, which removes what the filters let through.

Letters are the 90 of ``a-z`` and U+00C0 to U+00FF; inside tasks a word is its Latin-1 bytes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_MIX, LOWER, Words, mix64, powers, text_chunks, written

LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
SLIP = 199                # a run whose hash this divides loses a letter
BITS_PER_WORD = 16
LANES = 4                 # 64-bit lanes of a filter block; two bits are set in each
FILTER_BLOCKS = 1 << 16   # blocks of one filter at most: 2 MB
WAVE_BYTES = 16 << 20     # filters broadcast at once
PROBES = 1 << 18          # word letters whose edits are made at once
TASK_LETTERS = 1 << 19    # word letters of a task that probes
MOST_ROUNDS = 64          # forms grow five times in count with each step: chains are shorter

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[97:123] = True
_LETTERS[0xC0:] = True
ALPHABET = np.flatnonzero(_LETTERS)
_STEP = int(powers(2)[1])
_BACK = np.uint64(pow(_STEP, -1, 1 << 64))


def latin(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) with U+00C0 to U+00FF as one byte, ASCII letters in lower case, all other bytes zero."""
    lead = raw == 0xC3   # in UTF-8 only the first byte of U+00C0 .. U+00FF
    out = LOWER[raw]
    out[~_LETTERS[out] | (raw >= 0x80)] = 0
    at = np.flatnonzero(lead[:-1]) if len(raw) else np.zeros(0, np.int64)
    out[at] = 0xC0 | (raw[at + 1] & 0x3F)
    keep = np.ones(len(raw), dtype=bool)
    keep[at + 1] = False
    before = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], before[off]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the runs of letters after slips, with their occurrences; a word may have several rows.

    A run loses the letter ``h % length`` where ``h``, the CRC-32 of ``<doc_id>:<run>``, is a multiple of
    ``SLIP``.  A null doc_id prints as nothing.
    """
    def run(batches):
        for rows, raw, off in text_chunks(batches):
            words = Words(*latin(raw, off), _LETTERS, lower=False)
            if not words.n:
                continue
            which, known = words.distinct()
            known = [w.decode("latin-1") for w in known.to_pylist()]
            utf8 = [w.encode() for w in known]
            seeds = [zlib.crc32(b"%s:" % (b"" if d is None else b"%d" % d)) for d in rows.column(rows.schema.get_field_index("doc_id")).to_pylist()]
            pair, count = np.unique(words.doc() * len(known) + which, return_counts=True)
            doc, which = pair // len(known), pair % len(known)
            crc, seed = zlib.crc32, np.array(seeds, dtype=np.uint64)[doc].tolist()
            h = np.array([crc(utf8[w], s) for w, s in zip(which.tolist(), seed, strict=True)], dtype=np.uint64)
            slip = h % SLIP == 0
            n = np.bincount(which[~slip], weights=count[~slip], minlength=len(known)).astype(np.int64)
            out = {known[w]: int(n[w]) for w in np.flatnonzero(n).tolist()}
            for w, x, c in zip(which[slip].tolist(), h[slip].tolist(), count[slip].tolist(), strict=True):
                at = x % len(known[w])
                short = known[w][:at] + known[w][at + 1:]
                out[short] = out.get(short, 0) + c
            long = [(w, c) for w, c in out.items() if len(w) >= LEAST_LETTERS]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in long], pa.string()), pa.array([c for _, c in long], pa.int64())], names=["word", "n"])

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long")


def _hash(sums: np.ndarray, length) -> np.ndarray:
    return mix64(sums + np.asarray(length).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words in Latin-1."""
    size = np.array([len(w) for w in words], dtype=np.int64)
    if not len(size):
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b"".join(words), np.uint8)
    start = np.cumsum(size) - size
    pos = np.arange(len(data)) - np.repeat(start, size)
    return _hash(np.add.reduceat(BYTE_MIX[data] * powers(int(size.max()))[pos], start), size)


def _hashed(counts: DataFrame) -> DataFrame:
    """(word, n, length, h)."""
    def run(batches):
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(w) for w in words], pa.int32()), pa.array(word_hashes(words).view(np.int64))],
                                             names=["word", "n", "length", "h"])

    return counts.select("word", "n").mapInArrow(run, "word string, n long, length int, h long")


def _bits(h: np.ndarray, lane: int) -> np.ndarray:
    """The two bits of a hash in one lane of its block."""
    x = mix64(h + np.uint64(0xA0761D6478BD642F * (lane + 1) & (2**64 - 1)))
    return np.uint64(1) << (x & np.uint64(63)) | np.uint64(1) << (x >> np.uint64(6) & np.uint64(63))


def filter_plan(sizes: dict[int, int]) -> list[dict[int, tuple[int, int, list[int]]]]:
    """Waves of filters: length -> (filters of the length, blocks of each, those in this wave).

    ``sizes``: number of words by length.
    """
    waves, room = [{}], WAVE_BYTES
    for length in sorted(sizes):
        blocks = -(-sizes[length] * BITS_PER_WORD // (64 * LANES))
        parts = -(-blocks // FILTER_BLOCKS)
        blocks = -(-blocks // parts)
        for part in range(parts):
            if room < 8 * LANES * blocks and waves[-1]:
                waves.append({})
                room = WAVE_BYTES
            waves[-1].setdefault(length, (parts, blocks, []))[2].append(part)
            room -= 8 * LANES * blocks
    return waves


def _address(h: np.ndarray, parts: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(filter, block) of each hash among the filters of its length."""
    return (h >> np.uint64(32)) % np.uint64(parts), (h & np.uint64(0xFFFFFFFF)) % np.uint64(blocks)


def _filters(vocabulary: DataFrame, wave: dict) -> dict[int, tuple[int, int, dict[int, np.ndarray]]]:
    """length -> (parts, blocks, part -> bits of (block, lane)), OR-ed together by Spark."""
    def run(batches):
        for batch in batches:
            length, h = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for size in np.unique(length).tolist():
                if size in wave:
                    own = h[length == size]
                    part, block = _address(own, *wave[size][:2])
                    mine = np.isin(part, np.array(wave[size][2], dtype=np.uint64))
                    own, part, block = own[mine], part[mine], block[mine]
                    for lane in range(LANES):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), size, np.int32)), pa.array(part.astype(np.int32)),
                                                          pa.array((block * LANES + lane).astype(np.int32)), pa.array(_bits(own, lane).view(np.int64))],
                                                         names=["length", "part", "at", "bits"])

    found = (vocabulary.select("length", "h").mapInArrow(run, "length int, part int, at int, bits long")
             .groupBy("length", "part", "at").agg(F.bit_or("bits").alias("bits")).toArrow())
    length, part, at = (found[c].to_numpy() for c in ("length", "part", "at"))
    bits = found["bits"].to_numpy().view(np.uint64)
    out = {}
    for size, (parts, blocks, own) in wave.items():
        tables = {}
        for p in own:
            tables[p] = np.zeros(blocks * LANES, dtype=np.uint64)
            mine = (length == size) & (part == p)
            tables[p][at[mine]] = bits[mine]
        out[size] = (parts, blocks, tables)
    return out


def _positive(h: np.ndarray, filters) -> np.ndarray:
    """Which hashes the filters of their length (of this wave) may hold."""
    parts, blocks, tables = filters
    part, block = _address(h, parts, blocks)
    found = np.zeros(len(h), dtype=bool)
    for p, table in tables.items():
        maybe = np.flatnonzero(part == p) if parts > 1 else np.arange(len(h))
        for lane in range(LANES):
            bits = _bits(h[maybe], lane)
            maybe = maybe[table[block[maybe].astype(np.int64) * LANES + lane] & bits == bits]
        found[maybe] = True
    return found


def edit_hashes(words: np.ndarray):
    """Yields (hash, word index, length) arrays of the edits of words of one length, (m, length) Latin-1 bytes:
    distinct deletions, then replacements by each larger letter."""
    m, size = words.shape
    power = powers(size)
    value = BYTE_MIX[words] * power
    total = value.sum(axis=1, dtype=np.uint64)
    before = np.cumsum(value, axis=1, dtype=np.uint64)
    shorter = before - value + (total[:, None] - before) * _BACK
    lone = np.ones((m, size), dtype=bool)
    lone[:, 1:] = words[:, 1:] != words[:, :-1]   # any letter of a run of equal ones leaves the same word
    if size > LEAST_LETTERS:
        yield _hash(shorter[lone], size - 1), np.nonzero(lone)[0], size - 1
    rest = total[:, None] - value
    for letter in ALPHABET.tolist():
        below = words < letter
        if below.any():
            yield _hash((rest + BYTE_MIX[letter] * power)[below], size), np.nonzero(below)[0], size


def _candidates(vocabulary: DataFrame, filters) -> DataFrame:
    """(h, length, source, source_length): edits that the broadcast filters may hold, as hashes."""
    def run(batches):
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            own = batch.column(1).to_numpy()
            length = np.array([len(w) for w in words])
            for size in np.unique(length).tolist():
                if size not in filters.value and size - 1 not in filters.value:
                    continue
                same = np.flatnonzero(length == size)
                for lo in range(0, len(same), max(1, PROBES // size)):
                    some = same[lo:lo + max(1, PROBES // size)]
                    table = np.frombuffer(b"".join(words[i] for i in some.tolist()), np.uint8).reshape(len(some), size)
                    for h, at, target in edit_hashes(table):
                        if target in filters.value:
                            hit = np.flatnonzero(_positive(h, filters.value[target]))
                            yield pa.RecordBatch.from_arrays([pa.array(h[hit].view(np.int64)), pa.array(np.full(len(hit), target, np.int32)),
                                                              pa.array(own[some[at[hit]]]), pa.array(np.full(len(hit), size, np.int32))],
                                                             names=["h", "length", "source", "source_length"])

    return vocabulary.select("word", "h").mapInArrow(run, "h long, length int, source long, source_length int")


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(a, na, b, nb): each pair of words of ``vocabulary`` (word, n, length, h) that are one edit apart, once."""
    spark = vocabulary.sparkSession
    sizes = {r.length: r["count"] for r in vocabulary.groupBy("length").count().collect()}  # a row for each length
    letters = sum(length * n for length, n in sizes.items())
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), letters // TASK_LETTERS + 1)
    found = None
    for wave in filter_plan(sizes) if sizes else []:
        filters = spark.sparkContext.broadcast(_filters(vocabulary, wave))  # WAVE_BYTES at most
        part = written(_candidates(vocabulary.select("word", "h").repartition(tasks, "h"), filters), "edits")
        found = part if found is None else found.unionByName(part)
        filters.destroy()
    if found is None:
        return spark.createDataFrame([], "a string, na long, b string, nb long")
    target = vocabulary.select("h", "length", F.col("word").alias("b"), F.col("n").alias("nb"))
    origin = vocabulary.select(F.col("h").alias("source"), F.col("length").alias("source_length"), F.col("word").alias("a"), F.col("n").alias("na"))
    met = found.join(target, ["h", "length"]).join(origin, ["source", "source_length"])
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "na", "b", "nb").distinct()


def _follow(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that the forms (word, form) lead to, by doubling steps."""
    roots = written(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(MOST_ROUNDS):
        after = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        new = written(roots.join(after, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        roots = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return roots
    raise RuntimeError("forms did not settle")


def spelling_report(docs: DataFrame) -> DataFrame:
    """A row per word: word, form, root, n, n_near, form_n.

    Words are runs of letters (after slips) with ``LEAST_LETTERS`` letters and ``LEAST_COUNT``
    occurrences at least.  A word's form is its near word of largest count (of equal ones the smallest),
    if that is ``RATIO`` times its own at least.  Null and empty texts have no words; repeated rows
    count as often as they come; no documents, or none with such words, give no rows.  Words may be
    very long.  Other columns of ``docs`` are not read.
    """
    counts = word_counts(docs).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    vocabulary = written(_hashed(written(counts, "counts")), "vocabulary")
    pairs = written(near_pairs(vocabulary), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m")))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    known = vocabulary.select("word", "n").join(near, "word", "left")
    given = -F.col("best.less") >= RATIO * F.col("n")
    table = written(known.select("word", F.when(given, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                 F.when(given, -F.col("best.less")).alias("form_n")), "forms")
    roots = _follow(table.where("form is not null"))
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
