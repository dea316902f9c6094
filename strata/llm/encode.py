"""SentencePiece encoding and decoding by suffix-array matching.

A batch's text is cut into segments that no piece crosses (a run of blanks and the
word after it; characters outside the vocabulary stand alone) and the distinct
segments are indexed by one suffix array, sorted as deep as the longest piece.  Each
piece of the vocabulary is found by binary search as a range of that array: its
occurrences.  The occurrences are the edges of a lattice; sorted by position they
are relaxed from left to right.

The vocabulary is of the BPE kind, whose encoding of a prefix is unique: of the
edges that end at a position, exactly one can follow the last token of the encoding
up to its start.  Two tokens can be neighbours if merging their joint text gives
back the two; such verdicts are kept in a bounded table.  The ids are those of the
public library.  Vocabularies are loaded, never trained.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import add_text_columns, ranges, text_chunks
from .pieces import PIECE_MODEL, SPACE_MARK, load_pieces

_SEP = 0xFF       # never a byte of UTF-8 text
_BLANK = 0x20
CACHE_BITS = 20   # neighbour verdicts kept per task process
BATCH_BYTES = 512 << 10


class Pieces:
    """A BPE piece vocabulary prepared for matching; blanks stand for the space mark."""

    def __init__(self, names: list[bytes], scores: list[float], kinds: list[str]):
        self.text = [n.replace(SPACE_MARK, b" ") for n in names]
        self.scores = scores
        self.byte_id = np.zeros(256, dtype=np.int32)
        self.unknown = kinds.index("unknown") if "unknown" in kinds else 0
        self.byte_id[:] = self.unknown
        for i, k in enumerate(kinds):
            if k == "byte":
                self.byte_id[self.text[i][0]] = i
        normal = [i for i, k in enumerate(kinds) if k == "normal"]
        self.id_of = {self.text[i]: i for i in normal}
        normal.sort(key=lambda i: self.text[i])
        self.ids = np.array(normal, dtype=np.int64)
        self.length = np.array([len(self.text[i]) for i in normal], dtype=np.int64)
        self.levels = int((self.length.max() + 7) // 8)
        # big-endian words of eight bytes, low end (zeros) and high end (ones) of the unused bytes
        low = np.zeros((len(normal), self.levels * 8), dtype=np.uint8)
        high = np.full((len(normal), self.levels * 8), 0xFF, dtype=np.uint8)
        for r, i in enumerate(normal):
            b = np.frombuffer(self.text[i], np.uint8)
            low[r, :len(b)] = high[r, :len(b)] = b
        self.low = low.view(">u8").astype(np.uint64)
        self.high = high.view(">u8").astype(np.uint64)
        self.n = len(names)
        # ASCII bytes that are no piece: they stand alone
        self.alone = np.zeros(256, dtype=bool)
        for b in range(0x80):
            self.alone[b] = bytes([b]) not in self.id_of
        # what each id stands for when decoding
        shown = [b"" if k == "control" else ("⁇ ".encode() if k == "unknown" else self.text[i]) for i, k in enumerate(kinds)]
        self.out = np.frombuffer(b"".join(shown), np.uint8)
        self.out_len = np.array([len(s) for s in shown], dtype=np.int64)
        self.out_at = np.cumsum(self.out_len) - self.out_len

    @classmethod
    def load(cls, path: str = PIECE_MODEL) -> Pieces:
        return cls(*load_pieces(path))

    def merge(self, text: bytes) -> list[int]:
        """Encoding of a short text by merges: the best scored neighbours first, the leftmost of ties."""
        parts = [c.encode() for c in text.decode()]
        find, scores = self.id_of.get, self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = find(parts[i] + parts[i + 1])
                if k is not None and (best is None or scores[k] > best):
                    best, at = scores[k], i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [find(p, -1) for p in parts]


class Neighbours:
    """Bounded table of verdicts: may token ``b`` follow token ``a`` (or start, for ``a`` = n)?"""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.key = np.full(1 << CACHE_BITS, -1, dtype=np.int64)
        self.yes = np.zeros(1 << CACHE_BITS, dtype=bool)

    def allowed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a.astype(np.int64) * (self.pieces.n + 2) + b
        slot = ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        verdict = self.yes[slot]
        miss = np.flatnonzero(self.key[slot] != pair)
        if len(miss):
            _, first, back = np.unique(pair[miss], return_index=True, return_inverse=True)
            p, n = self.pieces, self.pieces.n
            fresh = np.empty(len(first), dtype=bool)
            for i, (x, y) in enumerate(zip(a[miss[first]].tolist(), b[miss[first]].tolist(), strict=True)):
                # n: the start or a character outside the vocabulary, which merges with nothing
                fresh[i] = p.merge(p.text[y]) == [y] if x >= n else p.merge(p.text[x] + p.text[y]) == [x, y]
            verdict[miss] = fresh[back]
            self.key[slot[miss]] = pair[miss]
            self.yes[slot[miss]] = verdict[miss]
        return verdict


def _kept(pieces: Pieces) -> Neighbours:
    """The verdict table of this task process, shared by its tasks."""
    holder = sys.modules.setdefault("_strata_encode_cache", types.ModuleType("_strata_encode_cache"))
    name = f"t{hash((pieces.n, tuple(pieces.text[:: max(1, pieces.n // 64)])))}"
    if not hasattr(holder, name):
        setattr(holder, name, Neighbours(pieces))
    return getattr(holder, name)


def suffix_array(data: np.ndarray, left: np.ndarray, levels: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of ``data`` sorted by their next ``8 * levels`` bytes, and the words compared.

    ``left``: bytes to the next separator.  A tie goes one level deeper only while the
    separator has not been met.
    """
    padded = np.concatenate([data, np.full(8 * levels + 8, _SEP, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(data) + 8 * levels, dtype=np.uint64)
    for k in range(8):
        word = word << np.uint64(8) | padded[k:k + len(word)]
    words = [word[8 * v:8 * v + len(data)] for v in range(levels)]
    order = np.argsort(words[0], kind="stable")
    for v in range(1, levels):
        tie = np.zeros(len(order), dtype=bool)
        same = np.ones(max(0, len(order) - 1), dtype=bool)
        for u in range(v):
            w = words[u][order]
            same &= w[1:] == w[:-1]
        tie[1:] |= same
        tie[:-1] |= same
        tie &= left[order] >= 8 * v  # the separator may be the next byte
        slots = np.flatnonzero(tie)
        if not len(slots):
            break
        group = np.cumsum(np.concatenate([[True], ~same]))[slots]
        order[slots] = order[slots][np.lexsort((words[v][order[slots]], group))]
    return order, words


def occurrences(order: np.ndarray, words: list[np.ndarray], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(position, piece row) of every occurrence of every piece, by binary search."""
    first = words[0][order]
    lo = np.searchsorted(first, pieces.low[:, 0], "left")
    hi = np.searchsorted(first, pieces.high[:, 0], "right")
    for r in np.flatnonzero((pieces.length > 8) & (hi > lo)).tolist():
        a, b = int(lo[r]), int(hi[r])
        for v in range(1, int(pieces.length[r] + 7) // 8):
            w = words[v][order[a:b]]
            a, b = a + int(np.searchsorted(w, pieces.low[r, v], "left")), a + int(np.searchsorted(w, pieces.high[r, v], "right"))
            if a >= b:
                break
        lo[r], hi[r] = a, max(a, b)
    n = hi - lo
    return order[ranges(lo, n)], np.repeat(np.arange(len(n)), n)


def encode_segments(data: np.ndarray, off: np.ndarray, pieces: Pieces, neighbours: Neighbours) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of each segment ``data[off[i]:off[i + 1]]``, as (ids, pointers)."""
    lens = np.diff(off)
    n_seg = len(lens)
    # each segment is followed by a separator; its bytes and the separator are the lattice's nodes
    buf = np.full(len(data) + n_seg, _SEP, dtype=np.uint8)
    begin = off[:-1] + np.arange(n_seg)
    buf[ranges(begin, lens)] = data
    seg = np.repeat(np.arange(n_seg), lens + 1)
    offset = np.arange(len(buf)) - begin[seg]
    left = lens[seg] - offset
    order, words = suffix_array(buf, left, pieces.levels)
    start, row = occurrences(order, words, pieces)
    length, token = pieces.length[row], pieces.ids[row]
    # characters outside the vocabulary
    chars = np.flatnonzero(((buf & 0xC0) != 0x80) & (buf != _SEP))
    nxt = np.append(chars[1:], len(buf))
    size = np.minimum(nxt - chars, left[chars])
    known = np.zeros(len(buf), dtype=bool)
    whole = np.zeros(len(buf), dtype=np.int64)
    whole[chars] = size
    known[start[length == whole[start]]] = True
    odd = ~known[chars]
    start = np.concatenate([start, chars[odd]])
    length = np.concatenate([length, size[odd]])
    token = np.concatenate([token, np.full(int(odd.sum()), pieces.n)])
    # relax by position: all edges to a position of every segment at once, one length after the other
    end = start + length
    by = np.lexsort((length, offset[end]))
    start, length, token, end = start[by], length[by], token[by], end[by]
    rank = offset[end] << 8 | length
    cuts = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1], [True]])) if len(rank) else np.zeros(1, np.int64)
    last = np.full(len(buf), -1, dtype=np.int64)
    came = np.full(len(buf), -1, dtype=np.int64)
    last[begin] = pieces.n + 1  # nothing before
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        s, e, t = start[a:b], end[a:b], token[a:b]
        open_ = (last[s] >= 0) & (last[e] < 0)
        s, e, t = s[open_], e[open_], t[open_]
        if not len(s):
            continue
        fits = t == pieces.n
        ask = np.flatnonzero(~fits)
        if len(ask):
            fits[ask] = neighbours.allowed(np.minimum(last[s[ask]], pieces.n), t[ask])
        last[e[fits]] = t[fits]
        came[e[fits]] = s[fits]
    # walk back from the segments' ends
    at, which = begin + lens, np.arange(n_seg)
    trail_seg, trail_tok, trail_at, trail_len = [], [], [], []
    while True:
        going = at > begin[which]
        at, which = at[going], which[going]
        if not len(at):
            break
        trail_seg.append(which)
        trail_tok.append(last[at])
        trail_at.append(came[at])
        trail_len.append(at - came[at])
        at = came[at]
    if not trail_seg:
        return np.zeros(0, np.int32), np.zeros(n_seg + 1, np.int64)
    s, t, p, z = (np.concatenate(x) for x in (trail_seg, trail_tok, trail_at, trail_len))
    by = np.argsort(p, kind="stable")
    s, t, p, z = s[by], t[by], p[by], z[by]
    odd = t == pieces.n
    n = np.where(odd, z, 1)
    ids = np.repeat(t, n).astype(np.int32)
    from_byte = np.repeat(odd, n)
    ids[from_byte] = pieces.byte_id[buf[ranges(p[odd], z[odd])]]
    return ids, np.concatenate([[0], np.cumsum(np.bincount(s, weights=n, minlength=n_seg).astype(np.int64))])


def encode_chunk(raw: np.ndarray, off: np.ndarray, pieces: Pieces, neighbours: Neighbours) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of every text of a chunk, as (ids, pointers)."""
    mark = np.frombuffer(SPACE_MARK, np.uint8)
    if len(raw) > 2:  # the space mark itself reads as a blank
        hit = np.flatnonzero((raw[:-2] == mark[0]) & (raw[1:-1] == mark[1]) & (raw[2:] == mark[2]))
        if len(hit):
            keep = np.ones(len(raw), dtype=bool)
            keep[hit + 1] = keep[hit + 2] = False
            raw = raw.copy()
            raw[hit] = _BLANK
            moved = np.concatenate([[0], np.cumsum(keep)])
            raw, off = raw[keep], moved[off]
    # a blank before every text that is not empty
    some = np.diff(off) > 0
    shift = np.concatenate([[0], np.cumsum(some)])
    new_off = off + shift
    buf = np.full(len(raw) + int(some.sum()), _BLANK, dtype=np.uint8)
    buf[ranges(new_off[:-1] + some, np.diff(off))] = raw
    n = len(off) - 1
    if not len(buf):
        return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
    blank, alone = buf == _BLANK, pieces.alone[buf]
    first = alone.copy()
    first[1:] |= (blank[1:] & ~blank[:-1]) | alone[:-1]
    first[new_off[:-1][some]] = True
    cut = np.flatnonzero(first)
    seg_off = np.append(cut, len(buf)).astype(np.int64)
    segs = pa.Array.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(seg_off), pa.py_buffer(buf)]).dictionary_encode()
    which, names = segs.indices.to_numpy(zero_copy_only=False), segs.dictionary
    ends = np.frombuffer(names.buffers()[1], np.int64)[: len(names) + 1]
    data = np.frombuffer(names.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    ids, ptr = encode_segments(data, ends - ends[0], pieces, neighbours)
    counts = np.diff(ptr)[which]
    tokens = ids[ranges(ptr[which], counts)]
    run = np.concatenate([[0], np.cumsum(counts)])
    return tokens, run[np.searchsorted(cut, new_off)]


def decode_chunk(ids: np.ndarray, ptr: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts that ids stand for, as (bytes, offsets); the blank put before a text is taken off."""
    n = pieces.out_len[ids]
    data = pieces.out[ranges(pieces.out_at[ids], n)]
    off = np.concatenate([[0], np.cumsum(n)])[ptr]
    lead = np.zeros(len(off) - 1, dtype=bool)
    some = np.flatnonzero(np.diff(off) > 0)
    lead[some] = data[off[some]] == _BLANK
    keep = np.ones(len(data), dtype=bool)
    keep[off[:-1][lead]] = False
    return data[keep], off - np.concatenate([[0], np.cumsum(lead)])


def encode(docs: DataFrame, path: str = PIECE_MODEL, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Appends ``ids`` (array<int>), ``n_tokens`` (int) and ``round_trip`` (boolean: the ids decode to the text).

    Null and empty texts have no ids; a null text keeps null ids and a null round_trip.
    A space mark (U+2581) in a text reads as a blank, so such a text does not round-trip.
    """
    vocabulary = Pieces.load(path)  # a few MB, sent with the task

    def compute(raw, off, rows):
        ids, ptr = encode_chunk(raw, off, vocabulary, _kept(vocabulary))
        back, boff = decode_chunk(ids, ptr, vocabulary)
        null = rows.column(rows.schema.get_field_index(text)).is_null().to_numpy(zero_copy_only=False)
        same = np.diff(boff) == np.diff(off)
        if same.all():
            differs = np.concatenate([[0], np.cumsum(back != raw)])
            same &= differs[off[1:]] == differs[off[:-1]]
        else:
            same &= [bytes(back[a:b]) == bytes(raw[c:d]) for a, b, c, d in zip(boff[:-1], boff[1:], off[:-1], off[1:], strict=True)]
        lists = pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(ids), mask=pa.array(null)) if null.any() \
            else pa.ListArray.from_arrays(pa.array(ptr.astype(np.int32)), pa.array(ids))
        return [lists, np.diff(ptr).astype(np.int32), pa.array(same, mask=null)]

    return add_text_columns(docs, compute, [("ids", "array<int>"), ("n_tokens", "int"), ("round_trip", "boolean")],
                            text, keep, BATCH_BYTES)


def decode(rows: DataFrame, path: str = PIECE_MODEL, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Appends the text that an ``array<int>`` column stands for (null for null; ids outside the vocabulary are unknown)."""
    pieces = Pieces.load(path)
    kept = [c for c in rows.columns if c != out]
    source = rows.select(*dict.fromkeys([*kept, ids]))
    shape = source.select(*kept).schema.add(out, "string")

    def run(batches):
        for batch in batches:
            texts = []
            for one in batch.column(batch.schema.get_field_index(ids)).to_pylist():
                if one is None:
                    texts.append(None)
                    continue
                row = np.array([x if x is not None and 0 <= x < pieces.n else pieces.unknown for x in one], dtype=np.int64)
                data, _ = decode_chunk(row, np.array([0, len(row)]), pieces)
                texts.append(data.tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in kept], pa.array(texts, pa.string())],
                                             names=[*kept, out])

    return source.mapInArrow(run, shape)
