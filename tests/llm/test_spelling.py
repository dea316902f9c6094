"""Spelling variants against plain counting and all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import spelling
from tests.llm.tables import SCHEMA, frame

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    n = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return n


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = {w: c for w, c in counted(rows).items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n), near


def texts(seed=1, words=60):
    """Words with misspelled copies of falling frequency, chains among them."""
    rng = random.Random(seed)
    letters = "abcdeéÿ×"
    pool = []
    for _ in range(words):
        w, c = "".join(rng.choice(letters) for _ in range(rng.randint(5, 12))), rng.choice([400, 150, 30])
        while c >= 4:
            pool += [w] * c
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]])
            c //= rng.choice([2, 5, 6])
    rng.shuffle(pool)
    seps = [" ", "-", "9", "\n", "日", "Ÿ", "_"]
    rows = [(i, "".join(w.upper() if rng.random() < 0.1 and w.isascii() else w + rng.choice(seps) for w in pool[i * 40:(i + 1) * 40])) for i in range(len(pool) // 40 + 1)]
    return [*rows, *rows[:3], (None, "Banana " * 7), (-3, None), (90_000, ""), (90_001, "Ã" * 5), (90_002, ("ab" * 1500 + " ") * 6 + ("ab" * 1500 + "c ") * 40)]


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.mark.parametrize("wave,blocks", [(16 << 20, 1 << 16), (64, 1)])
def test_report(spark, rows, monkeypatch, wave, blocks):
    monkeypatch.setattr(spelling, "WAVE_BYTES", wave)
    monkeypatch.setattr(spelling, "FILTER_BLOCKS", blocks)
    docs = frame(spark, [(i, t, None, None, 0) for i, t in rows]).withColumn("word", F.lit(1)).withColumn("h", F.lit("x"))
    want, near = brute(rows)
    got = sorted(tuple(r) for r in spelling.spelling_report(docs).collect())
    assert got == want
    assert sum(map(len, near.values())) > 50 and any(w[2] != w[1] and w[1] is not None for w in want) and any(c > 1 for *_, c, _ in want)


def test_slips_occur(rows):
    assert sum(zlib.crc32(f"{d}:{w}".encode()) % 199 == 0 for d, t in rows for w in RUN.findall((t or "").lower())) > 10


def test_edit_hashes_are_those_of_the_edited_words():
    words = [b"banana", b"aaaaaa", b"ab\xe9\xffcd", b"\xff" * 6]
    table = np.frombuffer(b"".join(words), np.uint8).reshape(4, 6)
    got = {}
    for h, at, size in spelling.edit_hashes(np.concatenate([table, table[:, ::-1]], axis=1)):
        for x, i in zip(h.tolist(), at.tolist(), strict=True):
            got.setdefault(i, []).append((x, size))
    for i, w in enumerate(words):
        w = w + w[::-1]
        edits = {w[:k] + w[k + 1:] for k in range(12)} | {w[:k] + bytes([c]) + w[k + 1:] for k in range(12) for c in spelling.ALPHABET.tolist() if c > w[k]}
        want = sorted(zip(spelling.word_hashes(list(edits)).tolist(), (len(e) for e in edits), strict=True))
        assert sorted(got[i]) == want


def test_filters_hold_their_words_and_few_others(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randint(6, 9))) for _ in range(3000)})
    vocabulary = spelling._hashed(spark.createDataFrame([(w, 5) for w in words], "word string, n long")).cache()
    sizes = Counter(map(len, words))
    plan = spelling.filter_plan(sizes)
    assert len(plan) == 1
    filters = spelling._filters(vocabulary, plan[0])
    for size in sizes:
        own = spelling.word_hashes([w.encode() for w in words if len(w) == size])
        assert spelling._positive(own, filters[size]).all()
        other = spelling.word_hashes([bytes(rng.choices(b"klmnop", k=size)) + b"%d" % i for i in range(20_000)])
        assert spelling._positive(other, filters[size]).mean() < 0.01


def test_plan_bounds_each_wave():
    sizes = {6: 10, 7: 5_000_000, 8: 40_000_000, 9: 1}
    plan = spelling.filter_plan(sizes)
    seen = Counter()
    for wave in plan:
        assert sum(8 * spelling.LANES * blocks * len(own) for _, blocks, own in wave.values()) <= spelling.WAVE_BYTES
        for length, (parts, blocks, own) in wave.items():
            assert blocks <= spelling.FILTER_BLOCKS and max(own) < parts
            seen.update((length, p) for p in own)
    assert set(seen.values()) == {1} and sum(1 for length, _ in seen if length == 8) == plan[-1][8][0]


def test_empty(spark):
    assert spelling.spelling_report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert spelling.spelling_report(frame(spark, [(1, None, None, None, 0), (2, "short", None, None, 0)])).count() == 0
