"""Memory of one chunk of the suffix sort, and of the driver while it fits the toxicity model."""

import random
import tracemalloc

import numpy as np

from strata.llm import repeats, toxicity


def test_a_chunk_of_the_suffix_sort_is_small():
    raw = np.random.default_rng(3).integers(97, 123, repeats.SEGMENT_BYTES).astype(np.uint8)
    off = np.arange(0, len(raw) + 1, 4096)
    repeats.anchors(raw, off, repeats.THRESHOLD, repeats.GRAM)  # the powers of the hash are kept
    tracemalloc.start()
    repeats.anchors(raw, off, repeats.THRESHOLD, repeats.GRAM)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20


def _labelled(spark):
    """240 texts of 500 random words; every fourth is toxic."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=9)) + (". you vile thing" if i % 4 == 0 and k == 7 else "." if k % 9 == 0 else "") for k in range(500)) for i in range(240)]
    texts += ["", None, "...", "vile"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return texts, docs, docs.select("doc_id", (docs.doc_id % 4 == 0).cast("int").alias("toxic"))


def test_the_driver_gets_the_weighted_features_of_the_sample_only(spark, monkeypatch):
    texts, docs, labels = _labelled(spark)
    fit, got = toxicity.fit, []
    monkeypatch.setattr(toxicity, "fit", lambda bags, **how: got.append(sum(b[1].nbytes + b[2].nbytes for b in bags)) or fit(bags, **how))
    toxicity.train(docs, labels)  # imports and workers
    tracemalloc.start()
    model = toxicity.train(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.weights.any() and len(got) == 2
    assert 0 < got[1] < 64 << 10  # all features: 240 * 500 * 4 pairs of 8 bytes
    assert peak < 24 << 20        # the weights are 4 MB


def test_the_model_is_that_of_all_features(spark):
    texts, docs, labels = _labelled(spark)
    bags = []
    for i, text in enumerate(texts):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        one = toxicity.Bags(raw, np.array([0, len(raw)]))
        who, ids = one.features()
        order = np.argsort(one.sentence_of_word[who], kind="stable")
        bags.append((int(i % 4 == 0), ids[order].astype(np.int32), one.sentence_of_word[who][order].astype(np.int32)))
    want = toxicity.fit(sorted(bags, key=lambda b: (b[0], b[1].tobytes())))
    got = toxicity.train(docs, labels)
    assert np.array_equal(got.weights, want.weights) and got.bias == want.bias and want.weights.any()
