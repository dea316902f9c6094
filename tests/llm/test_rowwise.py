"""Sharding, toxicity, language identification, encoding, fingerprints and scoring."""

import hashlib
import math
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import ctw, encode, fingerprint, langid, sharding, toxicity
from tests.llm.tables import SCHEMA, corpus, frame

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def jump(key: int, n: int) -> int:
    """The published algorithm on unbounded integers."""
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_matches_the_algorithm(spark):
    keys = [0, 1, -1, 7, -(1 << 63), (1 << 63) - 1, *range(1000, 1200)]
    for n in (1, 2, 40, 1000):
        got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_shard(F.col("k"), n).alias("s")).collect()
        for r in got:
            assert (r.s.shard, r.s.grown) == (jump(r.k % (1 << 64), n), jump(r.k % (1 << 64), n + 1))


def test_shard_report(docs, rows, empty):
    got = sharding.shard_report(docs, 7).collect()
    assert len(got) == len(rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        if r.doc_id is not None:
            h = xxhash.xxh64_intdigest((r.doc_id % (1 << 64)).to_bytes(8, "little"), seed=42)
            assert (r.shard, r.grown_shard) == (jump(h, 7), jump(h, 8))
        assert r.grown_shard in (r.shard, 7)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    assert sorted((r.size, r.text_crc32) for r in got) == want
    assert sharding.shard_report(empty).count() == 0
    clash = sharding.assign_shards(docs.withColumn("shard", F.lit("x")), 5)
    assert clash.columns == [*docs.columns, "shard", "grown_shard"] and clash.count() == len(rows)


def test_sharding_is_native(docs):
    plan = sharding.assign_shards(docs, 40)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.toxicity_report(docs, labels)
    assert got.count() == docs.count()
    held = got.join(labels, "doc_id").where("held_out").select(F.avg((F.col("predicted") == F.col("toxic")).cast("double"))).collect()[0][0]
    assert held > 0.9
    assert got.where("score < 0 or score > 1 or score is null or predicted <> cast(score >= 0.5 as int)").count() == 0


def test_toxicity_does_not_see_held_out_labels(spark):
    # more rows of a class than the sample takes, so that counts of labels decide shares and weights
    text = F.when(F.col("id") % 3 == 0, F.concat(F.lit("you vile thing"), F.col("id") % 40)).otherwise(F.concat(F.lit("fine words here "), F.col("id") % 40))
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), text.alias("text")).cache()
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    held = toxicity.held_out("doc_id", 5, 0)
    flipped = labels.select("doc_id", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"))
    ones = labels.select("doc_id", F.when(held, F.lit(0)).otherwise(F.col("toxic")).alias("toxic"))
    assert labels.where(~held).groupBy("toxic").count().agg(F.min("count")).first()[0] > 2500
    scores = [{r.doc_id: r.score for r in toxicity.toxicity_report(docs, x).collect()} for x in (labels, flipped, ones)]
    assert scores[0] == scores[1] == scores[2] and len(set(scores[0].values())) > 2


def test_noisy_or_and_its_gradient():
    """One step of the fit against plain sums and a numeric derivative."""
    bags = [(1, np.array([1, 2, 2, 3]), np.array([0, 0, 1, 1])), (0, np.array([2, 4]), np.array([0, 1])), (1, np.array([1]), np.array([0])), (0, np.array([4]), np.array([0]))]

    def loss(w, bias, neg):
        total = 0.0
        for y, ids, sent in bags:
            calm = 1.0
            for s in set(sent.tolist()):
                z = sum(w.get(f, 0.0) for f in set(ids[sent == s].tolist())) + bias
                calm *= 1 - 1 / (1 + np.exp(-z))
            total -= np.log(1 - calm) if y else neg * np.log(calm)
        return total / len(bags)

    step = 1e-6
    model = toxicity.fit(bags, rounds=1, rate=1e-3, decay=0.0, evidence=-1.0, bias=-1.0, neg_weight=3.0)
    for f in (1, 2, 3, 4):  # the first step of Adam moves each weight by the rate, against its derivative
        g = (loss({f: step}, -1.0, 3.0) - loss({f: -step}, -1.0, 3.0)) / (2 * step)
        assert model.weights[f] == pytest.approx(-1e-3 * np.sign(g), rel=1e-3)
    z = np.array([-2.0, 0.5, 3.0, -1.0])
    want = [1 - np.prod(1 - 1 / (1 + np.exp(-z[a:b]))) for a, b in ((0, 3), (3, 3), (3, 4))]
    assert np.allclose(toxicity._noisy_or(z, np.array([0, 3, 3, 4])), want)


def test_toxicity_edges_and_spans(spark, docs, rows, empty):
    bad = [(i, f"fine words here. you {'vile' if i % 2 else 'kind'} thing{i}. more of it") for i in range(200)]
    train_docs = spark.createDataFrame(bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (5, None), (3, 1)], "doc_id long, toxic int")
    model = toxicity.train(train_docs, labels)
    one = toxicity.score(spark.createDataFrame([(1, "Fine words. so VILE! yes"), (2, None), (3, ""), (4, "...")], "doc_id long, text string"), model, spans=True)
    got = {r.doc_id: r for r in one.collect()}
    assert got[1].predicted == 1 and [(s.start, s.end) for s in got[1].offending] == [(12, 19)]
    assert [(got[i].score, got[i].n_sentences) for i in (2, 3, 4)] == [(0.0, 0)] * 3
    all_rows = toxicity.score(docs.withColumn("score", F.lit("old")), model)
    assert all_rows.count() == len(rows) and dict(all_rows.dtypes)["score"] == "double"
    assert toxicity.toxicity_report(empty, labels).count() == 0
    none = toxicity.toxicity_report(docs, labels.limit(0))
    assert none.where("predicted <> 0").count() == 0 and none.count() == len(rows)


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.select(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).collect()[0][0] > 0.98


def test_forward_sums_all_segmentations():
    trie = langid.Trie([b"\x01", b"\x01a", b"a", b"b", b"ab", b"\x01ab", b"ba"])
    p = np.array([[0.1], [0.2], [0.15], [0.05], [0.3], [0.12], [0.08]])
    index = {x: i for i, x in enumerate([b"\x01", b"\x01a", b"a", b"b", b"ab", b"\x01ab", b"ba"])}

    def total(s):
        return 1.0 if not s else sum(p[i, 0] * total(s[len(x):]) for x, i in index.items() if s.startswith(x))

    words = [b"ab", b"abab", b"bba"]
    off = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    lattice = langid.Lattice(np.frombuffer(b"".join(words), np.uint8), off, trie)
    got = np.exp(lattice.log_words(p))[:, 0]
    assert np.allclose(got, [total(b"\x01" + w) for w in words])


@pytest.fixture(scope="module")
def public_pieces():
    pieces = langid.vocabulary()
    return pieces, langid.Trie(pieces), {x: i for i, x in enumerate(pieces)}


LONG_WORDS = ["ab" * 100, "日本語の文章は空白なしに続いていく" * 12, "中", "x" * 63, "y" * 64, "z" * 65, "https" * 13 + "é" * 90, "ok", "q" * 5000]


def by_position(word, index, p, depth):
    """Log of the sum over all segmentations before and after each position, in plain logarithms."""
    s = b"\x01" + word
    f, b = [-np.inf] * (len(s) + 1), [-np.inf] * (len(s) + 1)
    f[0] = b[len(s)] = 0.0
    edges = [(i, j, index[s[i:j]]) for i in range(len(s)) for j in range(i + 1, min(len(s), i + depth) + 1) if s[i:j] in index]
    for i, j, k in edges:
        f[j] = np.logaddexp(f[j], f[i] + np.log(p[k]))
    for i, j, k in reversed(edges):
        b[i] = np.logaddexp(b[i], b[j] + np.log(p[k]))
    return f, b, edges


def test_long_words_sum_all_segmentations(public_pieces):
    pieces, trie, index = public_pieces
    words = [w.encode() for w in LONG_WORDS]
    off = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    lattice = langid.Lattice(np.frombuffer(b"".join(words), np.uint8), off, trie)
    p = np.random.default_rng(1).random((len(pieces), 2)) ** 4 + 1e-7
    p /= p.sum(axis=0)
    got = lattice.log_words(p)
    use = lattice.expected(p[:, :1], np.arange(1.0, len(words) + 1), len(pieces))
    want = np.zeros(len(pieces))
    for i, w in enumerate(words):
        for k in (0, 1):
            f, b, edges = by_position(w, index, p[:, k], trie.depth)
            assert got[i, k] == pytest.approx(f[-1], rel=1e-12)
            if k == 0:
                for s, e, piece in edges:
                    want[piece] += (i + 1) * np.exp(f[s] + np.log(p[piece, 0]) + b[e] - f[-1])
    assert np.allclose(use, want, rtol=1e-9, atol=1e-12)


def test_a_long_word_by_uniform_pieces(public_pieces):
    """The sum over 200 bytes is larger than the product of the sums over its 32-byte parts."""
    pieces, trie, _ = public_pieces
    keep = langid.Trie([b"\x01ab", b"ab", b"aba", *[bytes([b]) for b in range(256)]])
    p = np.full((259, 1), 1 / 259)
    word = np.frombuffer(b"ab" * 100, np.uint8)
    whole = langid.Lattice(word, np.array([0, 200]), keep).log_words(p)[0, 0]
    f, _, _ = by_position(b"ab" * 100, {x: i for i, x in enumerate([b"\x01ab", b"ab", b"aba", *[bytes([b]) for b in range(256)]])}, p[:, 0], 3)
    assert whole == pytest.approx(f[-1], rel=1e-12)


def test_language_edges(spark, docs, rows, empty):
    model = langid.train(docs)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !?"), (4, "🙂"), (5, "abc")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(odd, model).collect()}
    assert [got[i] for i in (1, 2, 3, 4)] == [("und", 0.0)] * 4 and got[5] == ("en", 1.0)
    assert langid.predict(docs.withColumn("lang_pred", F.lit(1)), model).count() == len(rows)
    nothing = langid.language_report(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.select("lang_pred").distinct().collect()} == {"und"}
    assert langid.language_report(empty).count() == 0


def test_encoding_equals_the_library(spark, docs, rows):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=encode.PIECE_MODEL)
    got = encode.encode(docs.withColumn("ids", F.lit(0))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == (None if r.text is None else model.encode(r.text))
        assert r.round_trip is (None if r.text is None else True)
    back = encode.decode(encode.encode(docs)).where("not (decoded <=> text)").count()
    assert back == 0


def test_encoding_odd_texts(spark, empty):
    import random

    import sentencepiece
    rng = random.Random(1)
    texts = [" ", "     a", "a  b   c    ", "\n\n\tx", "aaaaaaaaaaaaaaaa", " " * 40 + "word" + " " * 37, "\x00\x01a", "é́ñ naïve", "the theth thethe"]
    texts += ["".join(rng.choice("ab the  inéß\n1.") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    model = sentencepiece.SentencePieceProcessor(model_file=encode.PIECE_MODEL)
    got = encode.encode(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert all(r.ids == model.encode(r.text) and r.round_trip for r in got)
    mark = encode.encode(spark.createDataFrame([("x▁y",)], "text string")).collect()[0]
    assert mark.ids == model.encode("x▁y") and mark.round_trip is False
    assert encode.encode(empty).count() == 0


def test_fingerprint_report(spark, docs, rows, empty):
    known = [r for r in rows if r[0] is not None]
    order = sorted(known)
    first = sorted((r[1] for r in rows if r[0] is None), key=lambda t: 0)
    got = [r for r in fingerprint.fingerprint_report(docs).collect()]
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    for (i, t, *_), (_, nxt, *_) in zip(order[:-1], order[1:], strict=True):
        t, nxt = t or "", nxt or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        assert (by[i].n_chars, by[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= by[i].near_edited <= 1 and 0 <= by[i].near_next <= 1
    same = {}
    for i, t, *_ in known:
        assert same.setdefault(t or "", by[i].fingerprint) == by[i].fingerprint
    assert len(first) == 2 and fingerprint.fingerprint_report(empty).count() == 0
    alone = fingerprint.fingerprint_report(spark.createDataFrame([(1, "just one text")], "doc_id long, text string")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def plain_chunks(data: bytes) -> dict[tuple[int, int], int]:
    """(digest, length) of the chunks of a text, by walking it byte by byte."""
    gear = [(int(x) >> 17) & 0xFFFFFFFF for x in fingerprint.BYTE_MIX]
    out, at = {}, 0
    while at < len(data):
        end = at + 1
        while end < len(data) and end - at < fingerprint.MOST:
            size = end - at
            if size >= fingerprint.LEAST:
                h = sum(gear[data[end - 1 - k]] << k for k in range(16)) & 0xFFFFFFFF
                if h < 1 << (32 - (fingerprint.STRICT_BITS if size <= fingerprint.NORMAL else fingerprint.LOOSE_BITS)):
                    break
            end += 1
        base, total = 0x9E3779B97F4A7C15, end - at
        for j, b in enumerate(data[at:end]):
            total += int(fingerprint.BYTE_MIX[b]) * pow(base, j, 1 << 64)
        digest = int(fingerprint.mix64(np.array([total % (1 << 64)], dtype=np.uint64))[0]) & ((1 << 40) - 1)
        out[digest, end - at] = end - at
        at = end
    return out


def plain_likeness(a: dict, b: dict) -> float:
    low = min(sum(a.values()), sum(b.values()))
    return sum(a[k] for k in a.keys() & b.keys()) / low if low else float(sum(a.values()) == sum(b.values()))


@pytest.mark.parametrize("size", [64 << 20, 700])
def test_fingerprints_against_a_plain_walk(spark, rows, monkeypatch, size):
    """Chunks, both likenesses, the last row (its next is the first) and rows without an id."""
    monkeypatch.setattr(fingerprint, "PARTITION_BYTES", size)
    known = sorted((r[0], r[1] or "") for r in rows if r[0] is not None and (r[1] is None or len(r[1]) < 5000))
    got = {r.doc_id: r for r in fingerprint.fingerprint_report(frame(spark, [(i, t, None, None, 0) for i, t in known])).collect()}
    assert len(got) == len(known)
    for (i, t), (_, nxt) in zip(known, known[1:] + known[:1], strict=True):
        half = len(t) // 2
        own, edited, other = (plain_chunks(x.encode()) for x in (t, t[:len(t) - half] + nxt[:half], nxt))
        show = lambda c: "".join(sorted(f"{d:010x}{n:02x}" for d, n in c))
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (show(own), show(edited)), i
        assert got[i].near_edited == pytest.approx(plain_likeness(own, edited)) and got[i].near_next == pytest.approx(plain_likeness(own, other))
    none = [(None, "same words here " * 9, None, None, 0), (None, None, None, None, 0), (None, "other words there " * 9, None, None, 0)]
    alone = fingerprint.fingerprint_report(frame(spark, none)).collect()
    assert sorted(r.n_chars for r in alone) == [0, 144, 162] and all(r.doc_id is None for r in alone)
    want = {plain_likeness(plain_chunks((a[1] or "").encode()), plain_chunks((b[1] or "").encode())) for a in none for b in none if a is not b}
    assert {r.near_next for r in alone} <= want


def test_chunks_resist_shifts():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 20_000).astype(np.uint8)
    moved = np.concatenate([text[:5000], np.frombuffer(b"inserted", np.uint8), text[5000:]])
    a, b = (fingerprint.chunk_keys(x, np.array([0, len(x)])) for x in (text, moved))
    assert fingerprint.containment(a, b, 1)[0] > 0.98
    _, ends = fingerprint.chunk_ends(text, np.array([0, len(text)]))
    sizes = np.diff(np.concatenate([[0], ends]))
    assert ends[-1] == len(text) and sizes.max() <= fingerprint.MOST and sizes[:-1].min() >= fingerprint.LEAST


def _kt(a, b):
    p = 1.0
    for i in range(int(a)):
        p *= (i + 0.5) / (i + 1)
    for i in range(int(b)):
        p *= (i + 0.5) / (a + i + 1)
    return p


def test_context_tree_weighting_is_exact():
    """Depth 2: the next bit's probability is P_w(all data and the bit) / P_w(all data)."""
    rng = np.random.default_rng(5)
    data = rng.choice([97, 98, 99], 60, p=[0.6, 0.3, 0.1])
    text = data.astype(np.uint8)
    keys, ptr = ctw.byte_keys(text, np.array([0, len(text)]), 2)
    assert ptr.tolist() == [0, len(text) + 1]
    seen = [((int(k) >> 16) & 255, (int(k) >> 8) & 255, int(k) & 255) for k in keys]
    tree = ctw.Subtrees(*np.unique(keys, return_counts=True), root=1, depth=2)
    tree.descend(ctw.weigh_top(tree.sums, root=1))

    def weighted(rows, prefix, k, depth, ctx):
        """P_w of the k-th bit decisions after ``prefix`` at the node (depth, ctx)."""
        mine = [r for r in rows if (r[2] >> (8 - k)) == prefix and (depth == 0 or r[1] == ctx[0]) and (depth < 2 or r[0] == ctx[1])]
        ones = sum(r[2] >> (7 - k) & 1 for r in mine)
        own = _kt(len(mine) - ones, ones)
        if depth == 2 or not mine:
            return own
        below = 1.0
        for c in {r[1 - depth] for r in rows if depth == 0 or r[1] == ctx[0]}:
            below *= weighted(rows, prefix, k, depth + 1, (*ctx, c))
        return 0.5 * own + 0.5 * below

    older, newer = seen[10][0], seen[10][1]
    for row in [(older, newer, byte) for byte in (97, 98, 99, 100, 255)] + [(older, 65, 97), (65, newer, 97), (65, 66, 67)]:
        p = 1.0
        for k in range(8):
            prefix = row[2] >> (8 - k)
            p *= weighted([*seen, row], prefix, k, 0, ()) / weighted(seen, prefix, k, 0, ())
        got = 2.0 ** -tree.code_lengths(np.array([row[0] << 16 | row[1] << 8 | row[2]]))[0]
        assert abs(got - p) < 1e-9 * p
    for c in (older << 8 | newer, 0xFEFE, 0x4142):
        assert abs((2.0 ** -tree.code_lengths((np.int64(c) << 8) | np.arange(256))).sum() - 1) < 1e-5


def _code_length(learned, text, depth=5):
    """Bits of ``text`` after ``learned``: each bit costs log P_w(all with the bit) - log P_w(all) at the root."""
    def decisions(t):
        data = bytes([0xFE] * depth) + bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()) + b"\xff"
        for i in range(depth, len(data)):
            for k in range(8):
                yield [data[i - d:i] for d in range(depth + 1)], (k, data[i] >> (8 - k)), data[i] >> (7 - k) & 1

    counts, below = {}, {}
    for t in learned:
        for contexts, bits, one in decisions(t):
            for d, c in enumerate(contexts):
                counts.setdefault((c, bits), [0, 0])[one] += 1
                if d < depth:
                    below.setdefault((c, bits), set()).add((contexts[d + 1], bits))

    def kt(zeros, ones):
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    known = {}

    def weighted(node):
        if node not in counts:
            return 0.0
        if node not in known:
            own = kt(*counts[node])
            known[node] = own if len(node[0]) == depth else np.logaddexp(own, sum(map(weighted, below[node]))) - math.log(2)
        return known[node]

    total = 0.0
    for contexts, bits, one in decisions(text):
        child_old = child_new = 0.0
        for d in range(depth, -1, -1):
            node = (contexts[d], bits)
            now = list(counts.get(node, [0, 0]))
            now[one] += 1
            old = weighted(node)
            if d == depth:
                new = kt(*now)
            else:
                new = np.logaddexp(kt(*now), sum(map(weighted, below.get(node, ()))) - child_old + child_new) - math.log(2)
            child_old, child_new = old, new
        total -= (child_new - child_old) / math.log(2)
    return total


def test_scores_are_those_of_the_whole_tree(spark, monkeypatch):
    """Many shards and blocks, every context of the corpus: the scores are the brute-force ones."""
    monkeypatch.setattr(ctw, "SHARD_ENTRIES", 40)
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 120)
    rng = np.random.default_rng(11)
    vocabulary = ["tree", "Trees", "weight", "über", "a", "of", "mixing"]
    rows = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(1, 12))))) for i in range(40)]
    rows += [(40, None), (41, ""), (42, rows[0][1]), (0, rows[0][1]), (43, "xyzzy 漢字 unseen"), (44, "mixing " * 60), (None, "Of a tree")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ctw.scoring_report(docs).collect()
    assert len(got) == len(rows) and any(r.held_out for r in got)
    learned = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    want = sorted((-1 if i is None else i, -_code_length(learned, t) * math.log10(2)) for i, t in rows)
    have = sorted((-1 if r.doc_id is None else r.doc_id, r.score) for r in got)
    assert [h[0] for h in have] == [w[0] for w in want]
    assert np.allclose([h[1] for h in have], [w[1] for w in want], rtol=1e-5, atol=1e-5)


def test_counting_holds_few_bytes_for_each_key():
    """A task's gathered keys, at most 2^21, cost it no more than 56 bytes each at any time, chunks included."""
    caught = []

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):  # noqa: N802
            caught.append(run)
            raise StopIteration

    with pytest.raises(StopIteration):
        ctw.count_corpus(Docs())
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(97, 123, 1 << 18, dtype=np.uint8)).decode() for _ in range(14)] + ["z" * 300_000]
    tracemalloc.start()
    try:
        sent = {}
        for batch in caught[0](iter([pa.record_batch({"text": [t]}) for t in texts])):
            kind, key, n = (batch.column(c) for c in ("kind", "key", "n"))
            if kind[0].as_py() == 0:
                sent.update({"rows": sent.get("rows", 0) + len(n), "n": sent.get("n", 0) + pc.sum(n).as_py(), "z": max(sent.get("z", 0), pc.max(n).as_py())})
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sent["n"] == sum(map(len, texts)) + len(texts) and sent["z"] > 299_000  # whole, also beyond 16 bits
    assert most < 56 * 2 * ctw._HALF, most


def test_counted_keys_are_dealt_before_spark_sums_them(spark, docs, monkeypatch):
    """The tasks have summed theirs; a second sum before the shuffle would hold all keys of a task in a hash table."""
    caught = []
    monkeypatch.setattr(ctw, "written", lambda df, name: caught.append(df) or df)
    got = ctw.count_corpus(docs)
    plan = caught[0]._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan and "Aggregate" not in plan[plan.rindex("Exchange hashpartitioning"):plan.index("MapInArrow")], plan
    assert got.count() == got.select("kind", "key").distinct().count()


def test_nothing_learned_is_eight_bits_a_byte(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row, = ctw.scoring_report(spark.createDataFrame([(held, "abc")], "doc_id long, text string")).collect()
    assert row.held_out and row.train_tokens == 0 and abs(row.bits_per_byte - 8) < 1e-6


def test_scoring_base_and_gain(spark, docs, rows, empty):
    import re
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) for _, t, *_ in rows]
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10 == 0 for r in rows]
    counts = {}
    for t, h in zip(tokens, held, strict=True):
        for w in () if h else [*t, None]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = sorted((len(t) + 1, sum(w in counts for w in [*t, None]),
                   round(sum(np.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in [*t, None]), 5)) for t in tokens)
    got = ctw.scoring_report(docs, head_words=50).collect()
    have = sorted((r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got)
    assert [h[:2] for h in have] == [w[:2] for w in want] and np.allclose([h[2] for h in have], [w[2] for w in want])
    assert {r.train_tokens for r in got} == {n} and sum(r.held_out for r in got) == sum(held)
    assert all(r.score < 0 for r in got)
    assert ctw.scoring_report(empty).count() == 0
