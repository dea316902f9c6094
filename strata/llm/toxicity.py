"""Toxicity by multiple-instance learning: a text is a bag of sentences.

Only whole documents are labelled.  Each sentence gets a logistic score of its
words; the document's score is their noisy-or, ``1 - prod(1 - p)``: one toxic
sentence suffices.  The gradient of the document loss flows to the sentences
that explain it, so after training the sentence scores locate the offence.

Features of a sentence are its lower-cased words and the first 4, 5 and 6 bytes
of longer words (inflected forms share a stem), hashed to ``2**FEATURE_BITS``
weights.  Scoring is one pass over the texts without a shuffle; the model is a
4 MB array, whatever the corpus.

The classifier is fitted on a bounded sample of labelled rows: at most about
``max_per_class`` documents of either label, chosen by a hash of the doc_id.
Spark counts the sample's features; the driver gets those that speak for a label.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORD, BYTE_MIX, Words, add_text_columns, fresh, mix64, powers, return_memory, text_chunks, written

FEATURE_BITS = 20
PREFIXES = (4, 5, 6)
EVIDENCE = 10.0  # likelihood ratio statistic above which a feature gets a weight
_END = np.zeros(256, dtype=bool)
_END[[ord("."), ord("!"), ord("?"), ord("\n")]] = True


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray  # float32, 2**FEATURE_BITS
    bias: float


class Bags:
    """Sentences of a chunk and the hashed features of their words."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        words = Words(raw, off, ALNUM_WORD)
        ends = np.flatnonzero(_END[raw])
        # a sentence is a run of words of one text with no end mark between them
        before = np.searchsorted(ends, words.at)
        doc = words.doc()
        new = np.ones(words.n, dtype=bool)
        if words.n:
            new[1:] = (before[1:] != before[:-1]) | (doc[1:] != doc[:-1])
        self.first = np.flatnonzero(new)                    # first word of each sentence
        self.sentence_of_word = np.cumsum(new) - 1
        self.doc_of_sentence = doc[self.first]
        self.ptr = np.searchsorted(self.doc_of_sentence, np.arange(len(off)))
        self.words, self.raw_len = words, len(raw)

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(word index, feature id) pairs: the whole word, then prefixes of longer words."""
        w = self.words
        if not w.n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lens = np.diff(w.off)
        pos = np.arange(len(w.data)) - np.repeat(w.off[:-1], lens)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_MIX[w.data] * powers(int(lens.max()))[pos], dtype=np.uint64)])
        who, ids = [np.arange(w.n)], [total[w.off[1:]] - total[w.off[:-1]]]
        for k in PREFIXES:
            longer = np.flatnonzero(lens > k)
            who.append(longer)
            ids.append(total[w.off[longer] + k] - total[w.off[longer]] + np.uint64(k))
        h = mix64(np.concatenate(ids)) >> np.uint64(64 - FEATURE_BITS)
        return np.concatenate(who), h.astype(np.int64)

    def scores(self, model: ToxicityModel) -> np.ndarray:
        """Logit of each sentence."""
        who, ids = self.features()
        hit = np.flatnonzero(model.weights[ids])
        both = np.unique(self.sentence_of_word[who[hit]] << FEATURE_BITS | ids[hit])  # once in a sentence
        return np.bincount(both >> FEATURE_BITS, weights=model.weights[both & ((1 << FEATURE_BITS) - 1)],
                           minlength=len(self.first)) + model.bias


def _noisy_or(z: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """1 - prod(1 - sigmoid(z)) of each bag; an empty bag has 0."""
    calm = np.concatenate([[0.0], np.cumsum(np.logaddexp(0.0, z))])
    return -np.expm1(-(calm[ptr[1:]] - calm[ptr[:-1]]))


def _log_ratio(pos: np.ndarray, neg: np.ndarray, n_pos: float, n_neg: float) -> np.ndarray:
    """Likelihood ratio statistic of document counts where toxic documents have more."""
    total, rate = pos + neg, n_pos / max(1.0, n_pos + n_neg)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(pos > 0, pos * np.log(pos / (total * rate)), 0.0)
                 + np.where(neg > 0, neg * np.log(neg / (total * (1 - rate))), 0.0))
    return np.where(pos > total * rate, np.nan_to_num(g, posinf=0.0), 0.0)


def fit(bags: list[tuple[int, np.ndarray, np.ndarray]], rounds: int = 800, rate: float = 0.1,
        decay: float = 1e-5, evidence: float | None = EVIDENCE, bias: float = -9.0,
        neg_weight: float = 1.0, counts: np.ndarray | None = None) -> ToxicityModel:
    """Full-batch Adam on the noisy-or likelihood.

    ``bags``: (label, feature ids, sentence index of each feature inside the document).
    Only features over-represented in toxic documents, by a likelihood ratio
    statistic above ``evidence``, get a weight; the rest keep 0.  With ``evidence``
    None the bags hold such features only, and ``counts`` has the sentences of each
    bag (else: up to its last feature).  ``neg_weight``: how many clean documents one
    sampled clean document stands for.
    """
    size = 1 << FEATURE_BITS
    weights = np.zeros(size, dtype=np.float32)
    if not bags:
        return ToxicityModel(weights, bias)
    y = np.array([b[0] for b in bags], dtype=float)
    if counts is None:
        counts = np.array([int(b[2].max()) + 1 if len(b[2]) else 0 for b in bags])
    ptr = np.concatenate([[0], np.cumsum(counts)])
    ids = np.concatenate([b[1] for b in bags]).astype(np.int64)
    sent = np.concatenate([b[2] + p for b, p in zip(bags, ptr, strict=False)]).astype(np.int64)
    if evidence is not None:
        seen = np.zeros((2, size))
        for label, own, _ in bags:
            seen[int(label == 1)][np.unique(own)] += 1
        use_feature = _log_ratio(seen[1], seen[0], y.sum(), (1 - y).sum()) > evidence
        ids, sent = ids[use_feature[ids]], sent[use_feature[ids]]
    both = np.unique(sent << FEATURE_BITS | ids)  # a feature counts once in a sentence
    ids, sent = both & (size - 1), both >> FEATURE_BITS
    known, ids = np.unique(ids, return_inverse=True)
    doc = np.repeat(np.arange(len(bags)), counts)
    n = max(1, len(bags))
    w = np.zeros(len(known) + 1)  # the last is the bias
    w[-1] = bias
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(sent, weights=w[ids], minlength=ptr[-1]) + w[-1]
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
        bag = np.clip(_noisy_or(z, ptr), 1e-9, 1.0 - 1e-12)
        pull = np.where(y == 1, -(1.0 - bag) / bag, neg_weight)[doc] * p
        g = np.bincount(ids, weights=pull[sent], minlength=len(known) + 1)
        g[-1] = pull.sum()
        g = g / n
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-7)
    weights[known] = w[:-1]
    return ToxicityModel(weights, float(w[-1]))


def _evident(sample: DataFrame, evidence: float) -> np.ndarray:
    """Features with a statistic above ``evidence``, counted over the sample's documents, ascending."""
    sums = sample.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    n_pos = float(sums[0] or 0)
    n_neg = float(sums[1]) - n_pos
    counts = (sample.select((F.col("toxic") == 1).cast("long").alias("hit"), F.explode("features").alias("feature"))
              .groupBy("feature").agg(F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg")))

    def choose(batches):
        for rows in batches:
            pos, neg = (rows.column(rows.schema.get_field_index(c)).to_numpy().astype(float) for c in ("pos", "neg"))
            yield rows.select(["feature"]).filter(pa.array(_log_ratio(pos, neg, n_pos, n_neg) > evidence))

    return np.sort(counts.mapInArrow(choose, "feature int").toArrow().column("feature").to_numpy())


def train(docs: DataFrame, labels: DataFrame, max_per_class: int = 2500) -> ToxicityModel:
    """Fit on about ``max_per_class`` documents of each label at most.

    ``labels`` has (doc_id, toxic); rows with a null in either are left out, repeated
    labels of one doc_id count as their maximum.  Texts are turned into hashed
    features on the executors and counted there; of the sample's sentences the driver
    gets the features with a weight only, once each.
    """
    lab = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    scale = 1 << 30
    share = F.lit(0)
    for k, n in sizes.items():
        share = F.when(F.col("toxic") == k, F.lit(int(scale * min(1.0, max_per_class / n)))).otherwise(share)
    picked = lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < share)  # bounded by max_per_class
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))

    def featurise(batches):
        for rows, raw, off in text_chunks(batches):
            bags = Bags(raw, off)
            who, ids = bags.features()
            sent = bags.sentence_of_word[who]
            order = np.argsort(sent, kind="stable")
            sent, ids = sent[order], ids[order]
            cut = np.searchsorted(sent, bags.ptr)
            own = [np.unique(ids[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in own])])
            yield pa.RecordBatch.from_arrays([
                rows.column(rows.schema.get_field_index("toxic")),
                pa.array(np.diff(bags.ptr).astype(np.int32)),
                pa.array([ids[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                pa.array([(sent[a:b] - s).astype(np.int32).tobytes() for a, b, s in zip(cut[:-1], cut[1:], bags.ptr, strict=False)], pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(own).astype(np.int32))),
            ], names=["toxic", "sentences", "ids", "sent", "features"])

    sample = written(sample.mapInArrow(featurise, "toxic int, sentences int, ids binary, sent binary, features array<int>"), "toxicity-sample")
    weighted = _evident(sample, EVIDENCE)

    def thin(batches):
        use = np.zeros(1 << FEATURE_BITS, dtype=bool)
        use[weighted] = True
        for rows in batches:
            kept = []
            for ids, sent in zip(*(rows.column(rows.schema.get_field_index(c)).to_pylist() for c in ("ids", "sent")), strict=True):
                ids, sent = np.frombuffer(ids, np.int32), np.frombuffer(sent, np.int32)
                hit = use[ids]
                both = np.unique(sent[hit].astype(np.int64) << FEATURE_BITS | ids[hit])
                kept.append(((both & ((1 << FEATURE_BITS) - 1)).astype(np.int32).tobytes(), (both >> FEATURE_BITS).astype(np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays([*(rows.column(rows.schema.get_field_index(c)) for c in ("toxic", "sentences")),
                                              *(pa.array(list(x), pa.binary()) for x in zip(*kept, strict=True))],
                                             names=["toxic", "sentences", "ids", "sent"])

    # sorted: the same model whatever order the tasks end in; ranges of a short prefix, as the driver samples their keys
    rows = (sample.select("toxic", "sentences", "ids", "sent")
            .repartitionByRange("toxic", F.substring("ids", 1, 32)).sortWithinPartitions("toxic", "ids", "sent")
            .mapInArrow(thin, "toxic int, sentences int, ids binary, sent binary").toArrow())
    bags = [(toxic.as_py(), *(np.frombuffer(x.as_buffer(), np.int32) for x in both))
            for toxic, *both in zip(*(rows.column(c) for c in ("toxic", "ids", "sent")), strict=True)]
    model = fit(bags, evidence=None, counts=rows.column("sentences").to_numpy(), neg_weight=max(1.0, sizes.get(0, 0) / max_per_class))
    del rows, bags
    return_memory()
    return model


def score(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None, spans: bool = False) -> DataFrame:
    """Appends ``score`` (double), ``predicted`` (int), ``n_sentences`` and ``n_offending`` (int).

    With ``spans`` also ``offending``: the sentences with a score of 0.5 or more as
    (byte start of the first word, byte end of the last word, score).  Null and empty
    texts, and texts without words, have no sentence and the score 0.
    """
    fields = [("score", "double"), ("predicted", "int"), ("n_sentences", "int"), ("n_offending", "int")]
    if spans:
        fields.append(("offending", "array<struct<start:int,end:int,score:double>>"))

    def compute(raw, off, rows):
        bags = Bags(raw, off)
        z = bags.scores(model)
        total = _noisy_or(z, bags.ptr)
        bad = np.concatenate([[0], np.cumsum(z >= 0)])
        out = [total, (total >= 0.5).astype(np.int32), np.diff(bags.ptr).astype(np.int32),
               (bad[bags.ptr[1:]] - bad[bags.ptr[:-1]]).astype(np.int32)]
        if spans:
            at, lens = bags.words.at, np.diff(bags.words.off)
            last = np.append(bags.first[1:], bags.words.n) - 1
            found: list[list[dict]] = [[] for _ in range(len(off) - 1)]
            for s in np.flatnonzero(z >= 0):
                d = int(bags.doc_of_sentence[s])
                found[d].append({"start": int(at[bags.first[s]] - off[d]), "end": int(at[last[s]] + lens[last[s]] - off[d]),
                                 "score": float(1 / (1 + np.exp(-z[s])))})
            out.append(pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))))
        return out

    return add_text_columns(docs, compute, fields, keep=keep)


def held_out(column: str, modulus: int, remainder: int):
    """crc32 of the id as text, modulo ``modulus``, equals ``remainder`` (a null id: text '')."""
    return F.crc32(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "UTF-8")) % modulus == remainder


def _trained(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    learn = ~held_out("doc_id", 5, 0)
    return train(docs.where(learn), labels.where(learn))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_sentences, n_offending.

    Learns only from rows that are not held out (crc32 of the doc_id modulo 5 is not 0): labels of
    the others are not even counted.
    """
    model = _trained(docs, labels)
    rows = docs.select("doc_id", "text")
    return (score(rows, model, keep=["doc_id"])
            .select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted", "n_sentences", "n_offending"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; the model learns as in :func:`toxicity_report`.

    Null, empty and wordless texts stay; repeated rows share their fate; columns may have any names.
    """
    model = _trained(docs, labels)
    verdict, = fresh(docs.columns, "toxic_verdict")

    def compute(raw, off, rows):
        bags = Bags(raw, off)
        return [_noisy_or(bags.scores(model), bags.ptr) >= 0.5]

    return add_text_columns(docs, compute, [(verdict, "boolean")]).where(~F.col(verdict)).drop(verdict)
