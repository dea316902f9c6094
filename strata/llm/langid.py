"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of one fixed public vocabulary
(plus the 256 single bytes, so that any text can be cut).  A word's likelihood is
the sum over all its segmentations into pieces, found by the forward algorithm, however
long the word is; a text's is the product over its words.  The language with the largest posterior wins.

Piece probabilities are fitted by expectation maximisation over the words of a
bounded sample of training texts: about ``sample_bytes`` of text per language,
picked by a hash of the row.  Scoring is one pass over all texts without a shuffle;
the forward algorithm runs once per distinct word of a chunk.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORD, Words, add_text_columns, ranges, text_chunks
from .pieces import PIECE_MODEL, SPACE_MARK, load_pieces
from .toxicity import held_out

UNDETERMINED = "und"
SAMPLE_BYTES = 2 << 20
STEP = 32        # bytes of a word after which its sums are brought back to size, the longest piece's at least
_MARK = 1        # the byte that stands before a word


class Trie:
    """Pieces as a trie in flat arrays: sorted keys ``node << 8 | byte`` and their children."""

    def __init__(self, pieces: list[bytes]):
        node, size = {}, 1
        piece_of: dict[int, int] = {}
        for i, p in enumerate(pieces):
            at = 0
            for b in p:
                key = at << 8 | b
                if key not in node:
                    node[key] = size
                    size += 1
                at = node[key]
            piece_of[at] = i
        keys = np.array(sorted(node), dtype=np.int64)
        self.keys = keys.astype(np.int32)
        self.child = np.array([node[k] for k in keys.tolist()], dtype=np.int32)
        self.piece = np.full(size, -1, dtype=np.int32)
        self.piece[list(piece_of)] = list(piece_of.values())
        self.depth = max((len(p) for p in pieces), default=1)

    def edges(self, data: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece) of all pieces in ``data``; ``room``: bytes left to the part's end."""
        at = np.arange(len(data))
        node = np.zeros(len(data), dtype=np.int64)
        starts, lengths, found = [], [], []
        for k in range(self.depth):
            key = (node << 8 | data[at + k]).astype(np.int32)
            slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[slot] == key
            at, node = at[ok], self.child[slot[ok]].astype(np.int64)
            piece = self.piece[node]
            has = piece >= 0
            starts.append(at[has])
            lengths.append(np.full(int(has.sum()), k + 1))
            found.append(piece[has])
            more = room[at] > k + 1
            at, node = at[more], node[more]
            if not len(at):
                break
        return np.concatenate(starts), np.concatenate(lengths), np.concatenate(found)


class Lattice:
    """All segmentations of a list of words of any length, each with the mark before it.

    The sums are taken offset by offset for all words at once.  Every ``STEP`` bytes the open
    sums of a word are divided by their largest, whose logarithm is kept, so a long word (any
    run of letters without a blank) neither underflows nor is cut.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, trie: Trie):
        lens = np.diff(off)
        n = len(lens)
        self.size, self.depth, self.step = lens + 1, trie.depth, max(STEP, trie.depth)
        buf = np.full(len(data) + n, _MARK, dtype=np.uint8)
        buf[ranges(off[:-1] + np.arange(n) + 1, lens)] = data
        begin = np.cumsum(self.size) - self.size
        word = np.repeat(np.arange(n), self.size)
        offset = np.arange(len(buf)) - begin[word]
        start, length, piece = trie.edges(buf, self.size[word] - offset)
        self.longest = int(self.size.max()) if n else 0
        order = np.argsort(offset[start].astype(np.min_scalar_type(self.longest)), kind="stable")
        start, self.length, self.piece = start[order], length[order], piece[order]
        self.word, self.offset = word[start], offset[start]
        self.start = start + self.word                     # one node more than bytes in each word
        self.end = self.start + self.length
        self.cut = np.searchsorted(self.offset, np.arange(self.longest + 1))
        self.first = begin + np.arange(n)
        self.last = self.first + self.size
        self.nodes = len(buf) + n
        # blocks of self.step bytes of the words that have several
        blocks = np.where(self.size > self.step, -(-self.size // self.step) + 1, 0)
        self.base = np.cumsum(blocks) - blocks
        self.blocks = int(blocks.sum())
        self.long = np.flatnonzero(blocks)

    def _rescale(self, sums: np.ndarray, o: int, logs: np.ndarray) -> None:
        """Divide the sums of the nodes from offset ``o`` on that edges across it reach by their largest."""
        w = self.long[self.size[self.long] > o]
        at = np.minimum(self.first[w][:, None] + o + np.arange(self.depth), self.last[w][:, None])
        most = sums[at].max(axis=1)
        most[most == 0] = 1.0
        sums[at] = sums[at] / most[:, None]
        logs[self.base[w] + o // self.step] = np.log(most)

    def forward(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sum over segmentations up to each node, logarithms divided out by block); ``p`` is (pieces, languages)."""
        alpha, logs = np.zeros((self.nodes, p.shape[1])), np.zeros((self.blocks, p.shape[1]))
        alpha[self.first] = 1.0
        for o, (a, b) in enumerate(zip(self.cut[:-1].tolist(), self.cut[1:].tolist(), strict=True)):
            if o and o % self.step == 0:
                self._rescale(alpha, o, logs)
            if a < b:  # edges from one offset: their ends are distinct nodes
                alpha[self.end[a:b]] += alpha[self.start[a:b]] * p[self.piece[a:b]]
        return alpha, logs

    def log_words(self, p: np.ndarray) -> np.ndarray:
        """(words, languages) log likelihood."""
        alpha, logs = self.forward(p)
        out = np.log(alpha[self.last])
        if len(self.long):
            out[self.long] += np.add.reduceat(logs, self.base[self.long])
        return out

    def expected(self, p: np.ndarray, weight: np.ndarray, n_pieces: int) -> np.ndarray:
        """Expected uses of each piece (one language: ``p`` is (pieces, 1))."""
        alpha, logs = self.forward(p)
        beta, back = np.zeros_like(alpha), np.zeros_like(logs)
        beta[self.last] = 1.0
        for o in range(self.longest - 1, -1, -1):
            a, b = self.cut[o], self.cut[o + 1]
            if a < b:
                np.add.at(beta, self.start[a:b], beta[self.end[a:b]] * p[self.piece[a:b]])
            if o and o % self.step == 0:
                self._rescale(beta, o, back)
        with np.errstate(divide="ignore"):
            use = np.log(alpha[self.start, 0]) + np.log(p[self.piece, 0]) + np.log(beta[self.end, 0]) - np.log(alpha[self.last, 0])[self.word]
        if len(self.long):
            # a node's sum was divided at all block bounds up to it; seen from the end, at all from it on,
            # its own block's bound included if an edge could still cross that
            before = np.cumsum(logs[:, 0])
            after = np.cumsum(back[::-1, 0])[::-1]
            total = np.add.reduceat(logs[:, 0], self.base[self.long])
            stop = np.append(self.base[self.long][1:], self.blocks)
            rank = np.zeros(len(self.size), dtype=np.int64)
            rank[self.long] = np.arange(len(self.long))
            e = np.flatnonzero(self.size[self.word] > self.step)
            r, base = rank[self.word[e]], self.base[self.word[e]]
            done = before[base + self.offset[e] // self.step] - (before[base] - logs[base, 0])
            to = self.offset[e] + self.length[e]
            block = to // self.step + (to % self.step >= self.depth)
            left = np.append(after, 0.0)[base + block] - np.append(after, 0.0)[stop[r]]
            use[e] += done + left - total[r]
        return np.bincount(self.piece, weights=np.exp(use) * weight[self.word], minlength=n_pieces)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    prior: np.ndarray       # log share of the training texts
    p: np.ndarray           # (pieces, languages)
    trie: Trie


def vocabulary(path: str = PIECE_MODEL) -> list[bytes]:
    """Pieces without inner or repeated blanks, their leading blank as the word mark, and all single bytes."""
    names, _, kinds = load_pieces(path)
    own = {bytes([_MARK]) + n[len(SPACE_MARK):] if n.startswith(SPACE_MARK) else n
           for n, k in zip(names, kinds, strict=True) if k == "normal"}
    own = {n for n in own if SPACE_MARK not in n} | {bytes([b]) for b in range(256)}
    return sorted(own)


def train(docs: DataFrame, path: str = PIECE_MODEL, sample_bytes: int = SAMPLE_BYTES, rounds: int = 4) -> LanguageModel:
    """Fit on (doc_id, text, lang) rows; rows with a null in either are left out."""
    pieces = vocabulary(path)
    trie = Trie(pieces)
    rows = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).collect()
    sizes = sorted(sizes, key=lambda r: r["lang"])
    if not sizes:
        return LanguageModel([], np.zeros(0), np.zeros((len(pieces), 0)), trie)
    scale = 1 << 30
    share = F.lit(0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], F.lit(int(scale * min(1.0, sample_bytes / max(1, r["b"]))))).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(scale)) < share)  # about sample_bytes a language

    def count(batches):
        for chunk, raw, off in text_chunks(batches):
            words = Words(raw, off, ALNUM_WORD)
            lang = chunk.column(chunk.schema.get_field_index("lang")).to_pylist()
            ids, names = words.distinct()
            kinds = sorted(set(lang))
            of = np.array([kinds.index(x) for x in lang])[words.doc()]
            both, n = np.unique(of.astype(np.int64) << 40 | ids, return_counts=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([kinds[k] for k in (both >> 40).tolist()], pa.string()),
                names.take(pa.array(both & ((1 << 40) - 1))).cast(pa.binary()), pa.array(n)], names=["lang", "word", "n"])

    counts = sample.mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    p = np.zeros((len(pieces), len(sizes)))
    for k, r in enumerate(sizes):
        own = table.filter(pc.equal(table["lang"], r["lang"])).sort_by("word")
        p[:, k] = _fit(own["word"].to_pylist(), own["n"].to_numpy().astype(float), trie, len(pieces), rounds)
    prior = np.log(np.array([r["n"] for r in sizes], dtype=float) / sum(r["n"] for r in sizes))
    return LanguageModel([r["lang"] for r in sizes], prior, p, trie)


def _fit(words: list[bytes], n: np.ndarray, trie: Trie, n_pieces: int, rounds: int, smooth: float = 0.05) -> np.ndarray:
    p = np.full((n_pieces, 1), 1.0 / n_pieces)
    if not words:
        return p[:, 0]
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    off = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    lattice = Lattice(data, off, trie)
    for _ in range(rounds):
        use = lattice.expected(p, n, n_pieces) + smooth
        p = (use / use.sum())[:, None]
    return p[:, 0]


def predict(docs: DataFrame, model: LanguageModel, keep: list[str] | None = None) -> DataFrame:
    """Appends ``lang_pred`` and ``score`` (posterior of the predicted language).

    ``und`` with score 0 where the text is null or has no letter, or nothing was
    learned.  Ties go to the language that sorts first.
    """

    def compute(raw, off, rows):
        text = rows.column(rows.schema.get_field_index("text"))
        letter = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        n = len(off) - 1
        if not model.languages:
            return [pa.array([UNDETERMINED] * n, pa.string()), np.zeros(n)]
        words = Words(raw, off, ALNUM_WORD)
        ids, names = words.distinct()
        total = np.tile(model.prior, (n, 1))
        if words.n:
            data = np.frombuffer(names.buffers()[2], np.uint8)
            ends = np.frombuffer(names.buffers()[1], np.int64)[: len(names) + 1]
            logs = Lattice(data[ends[0]:ends[-1]], ends - ends[0], model.trie).log_words(model.p)
            for k in range(len(model.languages)):
                run = np.concatenate([[0.0], np.cumsum(logs[ids, k])])
                total[:, k] += run[words.ptr[1:]] - run[words.ptr[:-1]]
        best = total.argmax(axis=1)
        post = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        names_of = np.array(model.languages, dtype=object)[best]
        names_of[~letter] = UNDETERMINED
        return [pa.array(names_of, pa.string()), np.where(letter, post, 0.0)]

    return add_text_columns(docs, compute, [("lang_pred", "string"), ("score", "double")], keep=keep)


def language_report(docs: DataFrame, path: str = PIECE_MODEL) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns only from rows that are not held out (crc32 of the doc_id modulo 4 is not 2).
    """
    model = train(docs.where(~held_out("doc_id", 4, 2)), path)
    return (predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
            .select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score"))
