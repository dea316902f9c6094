"""Whitening against exact fractions and a plain dense computation."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"
SF = "/root/testdata/sf0.001/embeddings.parquet"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).repartition(3)


def brute(vectors):
    """(x, exact sums, covariance from exact fractions) of a list of vectors."""
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    cov = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3) for j in range(d)] for i in range(d)]
    return x, s, cov


@pytest.mark.parametrize("spread", [1, 1e6])
def test_against_exact_covariance(spark, spread):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(60, 6)) * np.array([9, 5, 3, 2, 1, 0.5]) * spread).astype(np.float32).tolist()
    x, s, cov = brute(vectors)
    got = whitening.whitening_report(frame(spark, [(i, v, 0) for i, v in enumerate(vectors)])).collect()
    assert len(got) == 60 * 6
    values, axes = np.linalg.eigh(np.array(cov, dtype=float))
    values, axes = values[::-1], axes[:, ::-1]
    n = len(x)
    by = {(r.vec_id, r.component): r for r in got}
    for k in range(6):
        plain = np.array([[float(Fraction(n * v - t, n)) for v, t in zip(r, s, strict=True)] for r in x]) @ axes[:, k] / math.sqrt(values[k])
        mine = np.array([by[i, k + 1].whitened for i in range(n)])
        assert np.allclose(mine, plain * np.sign(mine @ plain), atol=1e-9)
        assert by[0, k + 1].explained == pytest.approx(float(values[k] / values.sum()), rel=1e-9)
    for i, r in enumerate(x):
        want = sum((n * v - t) ** 2 for v, t in zip(r, s, strict=True))
        assert by[i, 1].deviation == (want if want < 1 << 63 else None)
    assert {r.n for r in got} == {60} and {r.identity_error for r in got}.pop() < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0], 0), (1, [0.5, 1.0], 0), (None, [0.25, -1.0], None), (4, [2.0, 3.0], 1)]
    odd = [(5, None, 1), (6, [None, 1.0], 1), (7, [nan, 1.0], 1), (8, [inf, 0.0], 1), (9, [-inf, 0.0], 1), (10, [], 1), (11, [1.0], 1), (12, [3e38, 0.0], 1)]
    got = whitening.whitening_report(frame(spark, good + odd)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted((i, c) for i in (1, 1, 0, 4) for c in (1, 2))
    assert {r.n for r in got} == {4}
    assert whitening.whitening_report(frame(spark, [])).count() == 0
    assert whitening.whitening_report(frame(spark, odd[:3])).count() == 0
    one = whitening.whitening_report(frame(spark, good[:2])).collect()
    assert len(one) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in one)


def test_no_variance_in_a_direction(spark):
    got = whitening.whitening_report(frame(spark, [(i, [float(i % 5), 7.0, float(i % 5)], 0) for i in range(20)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got)
    assert {r.explained for r in got if r.component == 1} == {1.0} and got[0].identity_error < 1e-12


def test_clashing_columns(spark):
    rows = frame(spark, [(1, [1.0, 2.0], 7, 3.0), (2, [2.0, 1.0], 8, 4.0)], "vec_id long, embedding array<float>, deviation int, n double")
    model = whitening.fit(rows)
    got = whitening.transform(rows, model)
    assert got.columns == ["vec_id", "n", "deviation", "whitened"] and [r.n for r in got.orderBy("vec_id").collect()] == [3.0, 4.0]
    assert whitening.whitening_report(rows.withColumn("component", F.lit("x")).withColumn("whitened", F.lit("y"))).count() == 4


def test_exact_products():
    rng = np.random.default_rng(2)
    for most in (50, 1 << 19, 1 << 33, 1 << 60):
        y = rng.integers(-most, most, (30, 4))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j], strict=True)) for j in range(4)] for i in range(4)]
        assert whitening._products(y).tolist() == want
        assert whitening._column_sums(y).tolist() == [sum(map(int, y[:, j])) for j in range(4)]


@pytest.mark.parametrize("values", [np.linspace(1, 100, 40), [100 + k * 1e-9 for k in range(8)] + [50.0] * 10 + [1 + k * 1e-6 for k in range(22)],
                                    list(range(1, 21)) + [0] * 20])
def test_refinement_of_clusters(values):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(40) - q.T @ q) / 2
    values = np.sort(np.array(values, dtype=np.longdouble))[::-1]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, x = whitening.refined_eigen(a)
    assert np.abs(got - values).max() < 1e-15 and np.abs(x.T @ x - np.eye(40)).max() < 1e-17
    assert np.abs(a @ x - x * got).max() < 1e-15
    # vectors of eigenvalues that stand alone are right to double precision
    for k in range(40):
        if min(abs(values[k] - values[j]) for j in range(40) if j != k) > 0.5:
            assert min(np.abs(x[:, k] - s * q[:, k]).max() for s in (1, -1)) < 1e-16


def test_given_table(spark):
    got = whitening.whitening_report(spark.read.parquet(SF))
    rows = got.agg(F.count("*").alias("c"), F.countDistinct("vec_id").alias("v"), F.max("identity_error").alias("e"), F.max("component").alias("k")).first()
    assert rows.c == 32 * rows.v and rows.e < 1e-9 and rows.k == 32
