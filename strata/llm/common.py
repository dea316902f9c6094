"""Helpers shared by the operators: Arrow text chunks, byte-level tokens, hashes, scratch tables.

Text work runs in ``mapInArrow`` tasks as numpy over the UTF-8 bytes of a few
megabytes of text at a time, so a task's memory is bounded by the chunk (or by
one text, where a single text is longer) and not by the partition.
"""

from __future__ import annotations

import ctypes
import gc
import re
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType

from ..session import shared_dir

CHUNK_BYTES = 1 << 20  # text bytes handled at once inside a task
ARROW_BYTES = 2 << 20  # bytes of rows handed to a task at once (one row at least)

# Upper-case ASCII to lower case, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# [^\x20\x09-\x0D]+ : everything but the six ASCII blanks.
BLANK_WORD = np.ones(256, dtype=bool)
BLANK_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ : digits, lower-case ASCII letters, all non-ASCII bytes.
ALNUM_WORD = np.zeros(256, dtype=bool)
ALNUM_WORD[0x30:0x3A] = True
ALNUM_WORD[0x61:0x7B] = True
ALNUM_WORD[0x80:] = True

_rng = np.random.default_rng(20240607)
BYTE_MIX = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1 << 12, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """``_BASE ** 0 .. n-1`` modulo 2**64 (grown on demand, kept per process)."""
    global _POWERS
    if len(_POWERS) < n or _POWERS[-1] == 1:
        steps = np.full(max(n, len(_POWERS)), _BASE, dtype=np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS[:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def text_chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into row slices of at most ``limit`` text bytes (one row at least).

    Yields ``(slice, bytes, offsets)``; a null text has no bytes.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()).fill_null("")
        off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
        data = col.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(col):
            hi = int(np.searchsorted(off, off[lo] + limit, "right")) - 1
            hi = min(max(hi, lo + 1), len(col))
            yield batch.slice(lo, hi - lo), raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            lo = hi
    return_memory()


def return_memory() -> None:
    """Hand freed memory back to the system: task processes live on from job to job."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def bound_batches(spark: SparkSession) -> None:
    """Text reaches the tasks in Arrow batches of ``ARROW_BYTES`` at most, not of so many rows however long."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = re.fullmatch(r"(-?\d+)([kmgt]?)b?", spark.conf.get(name).lower())
    now = int(size[1]) << 10 * " kmgt".index(size[2] or " ") if size else 0
    if not 0 < now <= ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))


def fresh(taken: list[str], *names: str) -> list[str]:
    """The names, with underscores added where a column has them already (upper and lower case alike)."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


class Words:
    """Words of a chunk: compacted bytes, word offsets into them, word pointer per text."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, is_word: np.ndarray, lower: bool = True):
        b = LOWER[raw] if lower else raw
        w = is_word[b]
        first = w.copy()
        first[1:] &= ~w[:-1]
        begins = off[:-1][off[:-1] < off[1:]]
        first[begins] = w[begins]
        self.at = np.flatnonzero(first)              # byte position of each word in the chunk
        self.data = b[w]                             # bytes of all words, nothing between them
        self.off = np.empty(len(self.at) + 1, dtype=np.int64)
        self.off[:-1] = np.flatnonzero(first[w])
        self.off[-1] = len(self.data)
        self.ptr = np.searchsorted(self.at, off)     # words of text i: ptr[i]:ptr[i + 1]
        self.n = len(self.at)

    def doc(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def array(self) -> pa.Array:
        """The words as one Arrow array over the compacted bytes (no copies per word)."""
        return pa.Array.from_buffers(pa.large_binary(), self.n, [None, pa.py_buffer(self.off), pa.py_buffer(np.ascontiguousarray(self.data))])

    def distinct(self) -> tuple[np.ndarray, pa.Array]:
        """(index of each word into the distinct words, the distinct words)."""
        d = self.array().dictionary_encode()
        return d.indices.to_numpy(zero_copy_only=False), d.dictionary

    def hashes(self) -> np.ndarray:
        """64-bit polynomial hash of each word."""
        if not self.n:
            return np.zeros(0, np.uint64)
        lens = np.diff(self.off)
        pos = np.arange(len(self.data)) - np.repeat(self.off[:-1], lens)
        v = BYTE_MIX[self.data] * powers(int(lens.max()))[pos]
        return mix64(np.add.reduceat(v, self.off[:-1]) + lens.astype(np.uint64))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``starts[i] .. starts[i] + counts[i] - 1``."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written intermediate under ``spark.checkpoint.dir``."""
    return shared_dir(spark, f"strata-llm-{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage and keeps
    one version of the rows for every later read, also after an executor is lost."""
    spark = df.sparkSession
    bound_batches(spark)
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now: its cleaner does so once the
    driver has collected their plans, which takes two rounds and else waits for a full heap."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def add_text_columns(df: DataFrame, compute, fields: list[tuple[str, str]], text: str = "text",
                     keep: list[str] | None = None, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Append columns computed from the text, chunk by chunk, in one ``mapInArrow`` pass.

    ``compute(raw, off, rows)`` gets the bytes, offsets and the Arrow slice of a chunk and
    returns one Arrow-convertible array per field.  ``keep`` names the input columns to
    return (default all).  Input columns named like a new field are replaced.
    """
    bound_batches(df.sparkSession)
    names = [n for n, _ in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    source = df.select(*dict.fromkeys([*kept, text]))
    shape = source.select(*kept).schema
    for n, t in fields:
        shape = shape.add(n, DataType.fromDDL(t))

    def run(batches):
        for rows, raw, off in text_chunks(batches, text, chunk):
            new = compute(raw, off, rows)
            arrays = [rows.column(rows.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*arrays, *[a if isinstance(a, pa.Array) else pa.array(a) for a in new]],
                                             names=[*kept, *names])

    return source.mapInArrow(run, shape)
