"""BK-tree near duplicates against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import hamming
from tests.llm.tables import SCHEMA, corpus, frame


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def fingerprint(text, k=4):
    w = words(text)
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, ids, radius):
    """Smallest id of each row's class, by linking all pairs."""
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                up[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [least.get(root(i)) for i in range(len(prints))]


def test_near_duplicates(spark):
    rows = corpus()
    prints = [fingerprint(r[1]) for r in rows]
    want = [(r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, classes(prints, [r[0] for r in rows], 4), strict=True)]
    got = [tuple(r) for r in hamming.near_duplicates(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert 20 < len({w[2] for w in want}) < len(want)


def random_prints(n, seed):
    rng = random.Random(seed)
    prints = {0, 1, (1 << 64) - 1, 1 << 63}
    while len(prints) < n:
        p = rng.getrandbits(64)
        prints.add(p)
        for _ in range(rng.randint(0, 3)):  # chains of near prints
            for _ in range(rng.randint(1, 6)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    return sorted(prints)


@pytest.mark.parametrize("radius,part,shard", [(4, 1 << 16, 1 << 13), (4, 8, 1 << 13), (4, 8, 1), (0, 1 << 16, 1 << 13), (9, 50, 4)])
def test_links_connect_all_near_prints(spark, monkeypatch, radius, part, shard):
    monkeypatch.setattr(hamming, "PART", part)
    monkeypatch.setattr(hamming, "SHARD", shard)
    monkeypatch.setattr(hamming, "FRONTIER", 64)
    # half of the prints agree on the upper bits: shards of several trees
    prints = sorted({*random_prints(300, 3), *(p & 0xFFFFF for p in random_prints(200, 4))})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = hamming.near_links(spark.createDataFrame([(p,) for p in signed], "print long"), radius).collect()
    assert all(0 < ((r.a ^ r.b) % (1 << 64)).bit_count() for r in links)
    at = {p: i for i, p in enumerate(signed)}
    up = np.arange(len(prints))
    if links:
        up = hamming._joined(up, np.array([at[r.a] for r in links]), np.array([at[r.b] for r in links]))
    want = classes(prints, range(len(prints)), radius)
    assert up.tolist() == want
    assert radius == 0 or len(set(want)) < len(want) - 50


def test_trees_find_every_near_pair():
    prints = np.array(random_prints(400, 9), dtype=np.uint64)
    group = np.arange(len(prints)) % 3
    trees = hamming.Trees(prints, group, 4)
    got = {(int(q), int(r)) for a, b in trees.near(prints, group, 7) for q, r in zip(a, b, strict=True)}
    want = {(i, j) for i in range(len(prints)) for j in range(len(prints)) if group[i] == group[j] and (int(prints[i]) ^ int(prints[j])).bit_count() <= 7}
    assert got == want and len(want) > len(prints)
    # children are keyed by their distance to the parent, one for each distance
    parent, edge = trees.key // 65, trees.key % 65
    kids = trees.key >= 0
    assert (np.bitwise_count(trees.prints[kids] ^ trees.prints[parent[kids]]) == edge[kids]).all()
    assert len(np.unique(trees.key[kids])) == kids.sum() and (np.diff(trees.key) >= 0).all()


def test_every_shard_plan_is_complete():
    rng = random.Random(1)
    for n in (10, 10**6, 10**9, 10**11):
        masks = hamming.shard_masks(n, 4)
        for _ in range(300):
            flips = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not flips & m for m in masks)


def test_odd_rows(spark):
    assert hamming.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    # null and wordless texts share the fingerprint zero; only rows without an id: no component_id
    odd = [(7, None), (3, ""), (9, " \n\t"), (None, None), (5, "A b"), (5, "a B"), (None, "x" * 300_000), (8, "one two three four " * 20_000)]
    got = [tuple(r) for r in hamming.near_duplicates(spark.createDataFrame(odd, "doc_id long, text string")
                                                     .withColumn("print", F.lit("x")).withColumn("comp", F.lit(1))).collect()]
    want = [(7, "0" * 16, 3), (3, "0" * 16, 3), (9, "0" * 16, 3), (None, "0" * 16, 3)] + [(5, f"{fingerprint('a b'):016x}", 5)] * 2
    want += [(None, f"{fingerprint('x' * 300_000):016x}", None), (8, f"{fingerprint(odd[-1][1]):016x}", 8)]
    assert sorted(got, key=str) == sorted(want, key=str)
