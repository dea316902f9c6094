"""Embedding whitening: exact distributed covariance, float32 eigenvectors refined in higher precision.

1. Each entry c of a vector becomes the integer ``floor(64 * c) + 1000000``.  Sums and, in a
   second pass, products of the entries centred on the nearest integer mean are added up
   exactly, so the covariance is the correctly rounded one however the rows are dealt out.
2. Its eigenvectors are found in float32 and corrected by Ogita-Aishima iterations: a few
   matrix products in extended precision, each doubling the number of right digits.
   Eigenvalues too close for the current digits form a cluster; inside it the vectors are
   turned by a sub-solve of the cluster's own small matrix, shifted by its mean.
3. The leading components divided by the roots of their eigenvalues are sent to the tasks,
   which project the centred vectors.  One more pass measures how far the covariance of the
   whitened vectors is from the identity.

The driver holds matrices of d x d numbers for vectors of d entries, whatever the number of
rows; a task sends d * (d + 1) / 2 sums.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
LARGEST = float(1 << 55)   # entries from here on have no integer form in a long and count as not finite
CELLS = 1 << 19            # vector entries handled at once inside a task
LIMB = 20                  # bits of a factor in exact float64 products
LEAST_SHARE = 2.0 ** -50   # an eigenvalue below this part of the largest one counts as zero

_WIDE = np.longdouble


@dataclass(frozen=True)
class Whitening:
    """What the fit learned: ``directions`` (d, k) are unit columns, ``matrix`` whitens centred integer vectors."""

    n: int
    sums: list[int]
    eigenvalues: list[float]
    explained: list[float | None]
    directions: np.ndarray
    matrix: np.ndarray          # columns of zero eigenvalues are not a number

    @property
    def dim(self) -> int:
        return len(self.sums)


def _finite(vector: str):
    return F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))


def remaining(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is not null and holds neither null nor non-finite entries."""
    return vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & _finite(vector))


def _slices(batches, vector: str, dim: int):
    """(slice of rows, their integers x) of a bounded number of entries each."""
    for batch in batches:
        step = max(1, CELLS // dim)
        for lo in range(0, batch.num_rows, step):
            rows = batch.slice(lo, step)
            flat = rows.column(rows.schema.get_field_index(vector)).flatten().to_numpy(zero_copy_only=False)
            yield rows, np.floor(flat.astype(np.float64) * SCALE).astype(np.int64).reshape(-1, dim) + SHIFT


def _column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums as Python integers."""
    high = (x >> 31).sum(axis=0).astype(object)
    return high * (1 << 31) + (x & ((1 << 31) - 1)).sum(axis=0).astype(object)


def _products(y: np.ndarray) -> np.ndarray:
    """Exact ``y.T @ y`` as Python integers, by float64 products that cannot round."""
    most = int(np.abs(y).max()) if y.size else 0
    if most < 1 << LIMB:
        rows = min(1 << 16, (1 << 53) // max(1, most * most))
        return sum((p.T @ p).astype(np.int64).astype(object) for p in (y[a:a + rows].astype(np.float64) for a in range(0, len(y), rows)))
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for a in range(0, len(y), 1 << 12):
        rest, limbs = y[a:a + (1 << 12)], []
        while int(np.abs(rest).max()) >= 1 << LIMB:
            limbs.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
            rest = rest >> LIMB
        limbs.append(rest.astype(np.float64))
        for i, p in enumerate(limbs):
            for j, q in enumerate(limbs):
                total += (p.T @ q).astype(np.int64).astype(object) * (1 << LIMB * (i + j))
    return total


def _whole(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _sums(rows: DataFrame, vector: str, dim: int) -> tuple[int, list[int]]:
    def run(batches):
        n, total = 0, np.zeros(dim, dtype=object)
        for _, x in _slices(batches, vector, dim):
            n, total = n + len(x), total + _column_sums(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array([n] * dim, pa.int64()), _whole(total)], names=["j", "n", "total"])

    found = (rows.select(vector).mapInArrow(run, "j int, n long, total decimal(38,0)")
             .groupBy("j").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("j").collect())
    return (found[0].n, [int(r.total) for r in found]) if found else (0, [0] * dim)


def _covariance(rows: DataFrame, vector: str, n: int, sums: list[int]) -> tuple[np.ndarray, Fraction]:
    """(covariance in extended precision, its exact trace): centred on the nearest integer means,
    summed exactly, then moved to the means themselves."""
    dim = len(sums)
    middle = [(2 * s + n) // (2 * n) for s in sums]
    a, b = np.triu_indices(dim)

    def run(batches):
        total = np.zeros((dim, dim), dtype=object)
        for _, x in _slices(batches, vector, dim):
            total = total + _products(x - np.array(middle, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), _whole(total[a, b])], names=["i", "j", "total"])

    found = rows.select(vector).mapInArrow(run, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    left = [s - n * m for s, m in zip(sums, middle, strict=True)]  # sums of the centred entries
    cov, trace = np.zeros((dim, dim), dtype=_WIDE), 0
    for r in found:
        exact = n * int(r.total) - left[r.i] * left[r.j]         # n * n times the covariance
        cov[r.i, r.j] = cov[r.j, r.i] = np.ldexp(_WIDE(str((exact << 96) // (n * n))), -96)
        trace += exact if r.i == r.j else 0
    return cov, Fraction(trace, n * n)


def _correct(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima step: (better eigenvectors, eigenvalues, size of the correction, distance
    up to which eigenvalues cannot be told apart yet)."""
    r = np.eye(len(a), dtype=_WIDE) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    norm = lambda m: float(np.linalg.norm(m.astype(np.float64), 2))
    blur = 2 * (norm(off) + norm(a) * norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > blur
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, values, float(np.abs(e).max()), blur


def _turn_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray, blur: float) -> np.ndarray:
    """Sub-solves: eigenvectors whose eigenvalues lie within ``blur`` are turned to their cluster's own axes."""
    order = np.argsort(values)
    ends = np.flatnonzero(np.diff(values[order]) > blur) + 1
    for group in np.split(order, ends):
        if len(group) > 1:
            own = x[:, group]
            small = own.T @ (a @ own - values[group].mean() * own)
            size = np.abs(small).max()
            if size > np.finfo(_WIDE).eps * len(a):
                turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))[1]
                x[:, group] = own @ turn.astype(_WIDE)
    return x


def refined_eigen(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix, in extended precision.

    The largest entry of each vector is positive.
    """
    size = np.abs(cov).max()
    if not size:
        return np.zeros(len(cov), dtype=_WIDE), np.eye(len(cov), dtype=_WIDE)
    a = cov / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(_WIDE)
    least, idle = np.inf, 0
    while idle < 3:  # corrections shrink fast down to the noise of the arithmetic
        x, values, moved, blur = _correct(a, x)
        if moved < 4e-16:
            break
        idle, least = (0, moved) if moved < least / 2 else (idle + 1, least)
        x = _turn_clusters(a, x, values, blur)
    x, values, _, _ = _correct(a, x)
    for _ in range(2):
        x = x + x @ (np.eye(len(a), dtype=_WIDE) - x.T @ x) / 2
    values = np.diag(x.T @ (a @ x))
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(a))] < 0, -1, 1)
    return values[order] * size, x


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Learn from all remaining vectors; None without any.

    Vectors are of the most frequent length (of equally frequent ones the longest); others
    cannot be compared with them and take no part.
    """
    rows = remaining(vectors, vector)
    sizes = rows.groupBy(F.size(vector).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if not sizes:
        return None
    dim = sizes[0].dim
    rows = rows.where(F.size(vector) == dim)
    n, sums = _sums(rows, vector, dim)
    cov, trace = _covariance(rows, vector, n, sums)
    values, directions = refined_eigen(cov)
    k = min(components, dim)
    values, directions = values[:k], directions[:, :k]
    live = values > LEAST_SHARE * values[0]
    matrix = np.where(live, directions / np.sqrt(np.where(live, values, 1)), np.nan).astype(np.float64)
    explained = [float(Fraction(*v.as_integer_ratio()) / trace) if trace else None for v in np.maximum(values, 0)]
    return Whitening(n, sums, [float(v) for v in values], explained, directions.astype(np.float64), matrix)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums``, exact: longs, or Python integers where longs would not hold them."""
    most = max(int(np.abs(x).max()) * n, max(abs(int(s)) for s in sums)) if x.size else 0
    if most < 1 << 61:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _squares(d: np.ndarray) -> pa.Array:
    most = int(np.abs(d).max()) if d.size else 0
    if most * most * d.shape[1] < 1 << 63 and d.dtype != object:
        return pa.array((d * d).sum(axis=1))
    total = (d.astype(object) ** 2).sum(axis=1)
    return pa.array([int(t) if t < 1 << 63 else None for t in total], pa.int64())


def transform(vectors: DataFrame, model: Whitening, vector: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """The remaining rows with ``deviation`` long and ``whitened`` array<double>.

    ``deviation``: sum over the dimensions of ``(n * x - sum)**2``, null where it does not fit a
    long.  ``keep`` names the input columns to return (default all but the vector); those named
    like a new column are replaced.  A component of no variance has null entries.
    """
    kept = [c for c in (keep if keep is not None else vectors.columns) if c not in (vector, "deviation", "whitened")]
    rows = remaining(vectors, vector).where(F.size(vector) == model.dim).select(*kept, vector)
    shape = rows.select(*kept).schema.add("deviation", LongType()).add("whitened", ArrayType(DoubleType()))
    n, sums, matrix = model.n, np.array(model.sums, dtype=object), model.matrix
    dead, solid = np.isnan(matrix[0]), np.nan_to_num(matrix)

    def run(batches):
        for part, x in _slices(batches, vector, len(sums)):
            d = _deviations(x, n, sums)
            z = (d.astype(np.float64) / n) @ solid
            flat = pa.array(z.ravel(), mask=np.tile(dead, len(z)) if dead.any() else None)
            lists = pa.ListArray.from_arrays(np.arange(0, z.size + 1, z.shape[1], dtype=np.int32), flat)
            yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in kept], _squares(d), lists],
                                             names=[*kept, "deviation", "whitened"])

    return rows.mapInArrow(run, shape)


def identity_error(vectors: DataFrame, model: Whitening, vector: str = "embedding") -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured over all
    of them (None without a component of variance)."""
    live = np.flatnonzero(~np.isnan(model.matrix[0]))
    if not len(live):
        return None
    k, (a, b) = len(live), np.triu_indices(len(live))

    def run(batches):
        sums, total = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            z = flat.reshape(-1, model.matrix.shape[1])[:, live]
            sums, total = sums + z.sum(axis=0), total + z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, np.arange(k)]).astype(np.int32)), pa.array(np.concatenate([b, np.full(k, -1)]).astype(np.int32)),
                                          pa.array(np.concatenate([total[a, b], sums]))], names=["i", "j", "total"])

    found = (transform(vectors, model, vector, keep=[]).select("whitened").mapInArrow(run, "i int, j int, total double")
             .groupBy("i", "j").agg(F.sum("total").alias("total")).collect())
    cov, mean = np.zeros((k, k)), np.zeros(k)
    for r in found:
        if r.j < 0:
            mean[r.i] = r.total / model.n
        else:
            cov[r.i, r.j] = cov[r.j, r.i] = r.total / model.n
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max())


REPORT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitening_report(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per remaining vector and component: vec_id, component (from 1 by falling eigenvalue), n,
    deviation, whitened, explained, identity_error.

    Vectors that are null, empty, hold a null or non-finite entry or have another length than most
    are left out.  Repeated and null ids are rows like any other; no vectors give no rows.  With one
    vector, or equal ones only, there is no variance: whitened, explained and identity_error are null.
    Other columns of ``vectors`` are not read.
    """
    model = fit(vectors, components=components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], REPORT)
    error = identity_error(vectors, model)
    rows = transform(vectors, model, keep=["vec_id"]).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(v).cast("double") for v in model.explained])
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
