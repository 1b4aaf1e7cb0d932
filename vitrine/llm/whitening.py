"""Operator 13, embedding whitening by spectral divide and conquer.

Vectors are whole numbers x (`SCALE` times an entry, rounded down, plus
`SHIFT`).  Sums are exact.  The covariance is taken in a second pass, centred
before multiplying, from one matrix per task.  It has a row per dimension, so
the driver holds it whatever the number of vectors: at most `MAX_DIMENSION`
squared numbers.

Its eigenvectors come from polar decompositions (QR-based dynamically weighted
Halley iteration).  For a shift inside the spectrum the polar factor of the
shifted matrix is its sign; half of the sign plus the identity projects on the
eigenvectors above the shift.  Orthogonal bases of that space and of its
complement split the matrix in two, and so on down to single components.  One
step of refinement against the covariance follows.

The leading components over the roots of their eigenvalues are broadcast, and
each task whitens its vectors.  How far the covariance of what comes out lies
from the identity is measured on all of it, in two more passes.

Defined results: vectors that are null, hold null or non-finite entries, or
entries of 2**46 and more (whose x doubles no longer tell apart), and vectors
of another length than most have (ties: the shorter) are dropped; null and
repeated ids are carried; a deviation beyond 64 bits is null; a component
whose eigenvalue is zero up to rounding has whitened null and takes no part in
the identity error; without any spread, explained and the identity error are
null; empty tables give none; extra columns are ignored.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
MAX_DIMENSION = 4096
_EPS = float(np.finfo(float).eps)
_LARGEST = float(1 << 46)
_CHUNK = 1 << 21  # entries that are worked on at once


# ---------------------------------------------------------------- eigenvectors
def polar_sign(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix without zero eigenvalues: its sign."""
    n = len(a)
    x, low = a / np.linalg.norm(a), _EPS
    for _ in range(40):
        low2 = low * low
        d = np.cbrt(4 * (1 - low2) / (low2 * low2))
        root = np.sqrt(1 + d)
        h = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low2) / (low2 * root)))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        q = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(n)]))[0]
        y = (b / c) * x + (h - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        y = (y + y.T) / 2
        moved = np.linalg.norm(y - x)
        x, low = y, min(1.0, low * (h + b * low2) / (1 + c * low2))
        if moved <= np.cbrt(4 * _EPS) and 1 - low <= 10 * _EPS:
            break
    return x


def _halves(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces of a symmetric matrix."""
    n = len(a)
    diagonal = np.diag(a)
    spread = max(np.ptp(diagonal), np.abs(a - np.diag(diagonal)).max())
    start = np.random.default_rng(n).normal(size=(n, n))
    for step in (0, 0.03, -0.03, 0.11, -0.11, 0.23, -0.23, 0.41, -0.41):  # another shift if one meets an eigenvalue
        above = (polar_sign(a - (np.median(diagonal) + step * spread) * np.eye(n)) + np.eye(n)) / 2
        k = round(float(np.trace(above)))
        if not 0 < k < n:
            continue
        q = np.hstack([above @ start[:, :k], start[:, k:] - above @ start[:, k:]])
        for _ in range(2):
            q = np.linalg.qr(q)[0]
            q = np.hstack([above @ q[:, :k], q[:, k:] - above @ q[:, k:]])
        q = np.linalg.qr(q)[0]
        if np.linalg.norm(q[:, k:].T @ a @ q[:, :k]) <= 8 * n * _EPS * scale:
            return q[:, :k], q[:, k:]
    return None


def spectral_components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    a = (a + a.T) / 2
    scale, n = float(np.linalg.norm(a)), len(a)
    done, todo = [], [(a, np.eye(n))]
    while todo:
        m, basis = todo.pop()
        if len(m) == 1 or np.linalg.norm(m - np.diag(np.diag(m))) <= n * _EPS * scale or (pair := _halves(m, scale)) is None:
            done.append((np.diag(m), basis))  # single, or alike up to rounding
            continue
        todo += [((s := q.T @ m @ q) / 2 + s.T / 2, basis @ q) for q in pair]
    vectors = np.hstack([b for _, b in done]) if done else np.zeros((0, 0))
    for _ in range(2):  # refinement: what is left off the diagonal turns the vectors a little further
        r, s = np.eye(n) - vectors.T @ vectors, vectors.T @ a @ vectors
        values = np.diag(s) / (1 - np.diag(r))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= 2 * (np.linalg.norm(s - np.diag(values)) + scale * np.linalg.norm(r))
        vectors = vectors + vectors @ np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
        for _ in range(3):  # back to orthonormal vectors: each step squares what is missing
            vectors = vectors @ (1.5 * np.eye(n) - vectors.T @ vectors / 2)
    values = np.diag(vectors.T @ a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ---------------------------------------------------------------- passes
def _chunks(batches, d: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole numbers x of the vectors that stay, some rows at a time."""
    step = max(1, _CHUNK // max(1, d))
    for batch in batches:
        batch = batch.filter(pc.equal(pc.list_value_length(batch.column("embedding")), d))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            c = part.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(part.num_rows, d)
            good = (np.abs(np.nan_to_num(c, nan=np.inf)) < _LARGEST).all(axis=1)
            yield part.column("vec_id").filter(pa.array(good)), np.floor(SCALE * c[good]).astype(np.int64) + SHIFT


def _cells(vectors: DataFrame, d: int, state, kind: str) -> dict[int, object]:
    """Sums over all vectors of `state(x)`, a flat array per chunk: one row per task and number, added in Spark."""
    def run(batches):
        total = 0
        for _, x in _chunks(batches, d):
            total = total + state(x)
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["cell", "v"])

    rows = vectors.mapInArrow(run, f"cell int, v {kind}").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    return np.array([r.v for r in sorted(rows, key=lambda r: r.cell)], np.int64 if kind == "long" else float)


@dataclasses.dataclass
class Whitening:
    """The mean of x as whole number and rest, components (rows) over the roots of their eigenvalues, and explained shares."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums of (n x - S) squared, in whole numbers."""
        away = x - self.whole
        most = self.n * (int(np.abs(away).max(initial=0)) + 1)
        if most * most * max(1, x.shape[1]) < 1 << 63:
            return pa.array(((self.n * away - self.rest) ** 2).sum(axis=1), pa.int64())
        exact = ((self.n * away.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return pa.array([v if v < 1 << 63 else None for v in exact.tolist()], pa.int64())


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of vectors (vec_id, embedding) over all that stay; None if none does."""
    length = vectors.where("embedding IS NOT NULL").groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None or length.d == 0:
        return None
    d = length.d
    if d > MAX_DIMENSION:
        raise ValueError(f"vectors of {d} dimensions: the covariance of more than {MAX_DIMENSION} is not held by the driver")
    sums = _cells(vectors, d, lambda x: np.append(x.sum(axis=0), len(x)), "long")
    if not len(sums) or not sums[-1]:
        return None
    n, s = int(sums[-1]), sums[:-1]
    model = Whitening(n, s // n, s % n, np.zeros((0, d)), np.zeros(0))
    upper = np.triu_indices(d)
    cells = _cells(vectors, d, lambda x: ((y := model.centred(x)).T @ y)[upper], "double")
    v = np.zeros((d, d))
    v[upper] = cells / n
    v = v + np.triu(v, 1).T
    values, basis = spectral_components(v)
    k, trace = min(components, d), float(np.trace(v))
    good = (values > d * _EPS * max(values[0], 0.0))[:k]
    model.components = np.where(good, 1 / np.sqrt(np.where(good, values[:k], 1)), np.nan)[:, None] * basis.T[:k]
    model.explained = values[:k] / trace if trace > 0 else np.full(k, np.nan)
    if good.any():
        model.identity_error = _identity_error(vectors, d, dataclasses.replace(model, components=model.components[good]))
    return model


def _identity_error(vectors: DataFrame, d: int, model: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity."""
    mean = _cells(vectors, d, lambda x: model.whitened(x).sum(axis=0), "double") / model.n
    cells = _cells(vectors, d, lambda x: ((z := model.whitened(x) - mean).T @ z).ravel(), "double") / model.n
    k = len(mean)
    return float(np.abs(cells.reshape(k, k) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per vector that stays and component."""
    vectors = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    schema = vectors.select("vec_id").schema.add("component", "integer").add("n", "long").add("deviation", "long").add("whitened", "double").add("explained", "double").add("identity_error", "double")
    model = fit_whitening(vectors, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    sent = vectors.sparkSession.sparkContext.broadcast(vars(model))

    def apply(batches):
        model = Whitening(**sent.value)
        k, d = model.components.shape
        shares = pa.array(model.explained, pa.float64(), from_pandas=True)
        for ids, x in _chunks(batches, d):
            rows = pa.array(np.repeat(np.arange(len(x)), k))
            each = pa.array(np.tile(np.arange(k), len(x)))
            yield pa.RecordBatch.from_arrays([
                ids.take(rows), pc.add(each, 1).cast(pa.int32()), pa.array(np.full(len(rows), model.n)), model.deviations(x).take(rows),
                pa.array(model.whitened(x).ravel(), pa.float64(), from_pandas=True), shares.take(each),
                pa.array([model.identity_error], pa.float64()).take(pa.array(np.zeros(len(rows), np.int64)))], names=schema.names)

    return vectors.mapInArrow(apply, schema)


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 13 over the whole of `embeddings`."""
    return whiten(table(spark, sf_dir, "embeddings"))
