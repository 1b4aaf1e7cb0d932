"""Operator 13: spectral divide and conquer against numpy's eigenvectors, whitening against a plain computation."""

import numpy as np
import pandas as pd
import pytest

from vitrine.llm import whitening
from vitrine.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"


def matrices():
    r = np.random.default_rng(2)
    q = np.linalg.qr(r.normal(size=(40, 40)))[0]
    yield np.cov(r.normal(size=(64, 300)))
    yield q @ np.diag(np.logspace(0, -12, 40)) @ q.T                  # many sizes
    yield q @ np.diag(np.repeat([3.0, 1.0, 1.0 - 1e-9, 0.0], 10)) @ q.T  # clusters, and no full rank
    yield np.diag(np.arange(9.0))
    yield np.full((6, 6), 2.0)
    yield np.zeros((5, 5))
    yield np.array([[1.0, 0.5], [0.5, 1.0]])
    yield np.array([[7.0]])
    yield np.outer(np.arange(1.0, 9), np.arange(1.0, 9)) + 1e-3 * np.eye(8)


@pytest.mark.parametrize("a", list(matrices()), ids=lambda a: f"{len(a)}")
def test_components(a):
    values, vectors = whitening.spectral_components(a)
    n, scale = len(a), max(np.linalg.norm(a), 1e-300)
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * scale and (np.diff(values) <= 1e-14 * scale).all()
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * scale


def test_polar_sign_is_sign():
    r = np.random.default_rng(5)
    q = np.linalg.qr(r.normal(size=(30, 30)))[0]
    e = r.normal(size=30) * np.logspace(0, -9, 30)
    assert np.abs(whitening.polar_sign(q @ np.diag(e) @ q.T) - q @ np.diag(np.sign(e)) @ q.T).max() < 1e-5


def plain(x):
    """n, S, components of whole numbers x."""
    n, s = len(x), [sum(int(v) for v in c) for c in x.T]
    y = np.array([[(n * int(v) - t) / n for v, t in zip(row, s, strict=True)] for row in x])
    e, q = np.linalg.eigh(y.T @ y / n)
    return n, s, y, e[::-1], q[:, ::-1]


def check(got, ids, x, k):
    n, s, y, e, q = plain(x)
    assert len(got) == n * k and set(got.n) == {n} and sorted(set(got.component)) == list(range(1, k + 1))
    wide = got.pivot_table(index="vec_id", columns="component", values="whitened").loc[list(ids)].to_numpy()
    want = y @ q[:, :k] / np.sqrt(e[:k])
    sign = np.sign((wide * want).sum(axis=0))
    assert np.abs(wide * sign - want).max() < 1e-7
    assert np.allclose(got.groupby("component").explained.first(), e[:k] / e.sum(), rtol=1e-9)
    deviation = {i: sum((n * int(v) - t) ** 2 for v, t in zip(row, s, strict=True)) for i, row in zip(ids, x, strict=True)}
    assert got.groupby("vec_id").deviation.agg(["min", "max"]).apply(lambda r: r["min"] == r["max"] == deviation[r.name], axis=1).all()
    assert got.identity_error.nunique() == 1 and 0 <= got.identity_error.iloc[0] < 1e-9


def test_query_against_numpy(spark):
    table = pd.read_parquet(f"{SF01}/embeddings.parquet")
    keep = [v is not None and not pd.isna(np.array(v, float)).any() and np.isfinite(np.array(v, float)).all() for v in table.embedding]
    table = table[keep]
    x = np.array([[np.floor(64 * float(c)) for c in v] for v in table.embedding]).astype(np.int64) + 1_000_000
    check(QUERIES["op13_embedding_whitening"](spark, SF01).toPandas(), table.vec_id, x, 32)


def test_what_stays(spark):
    r = np.random.default_rng(6)
    c = np.round(r.normal(size=(60, 5)) * [9, 5, 3, 2, 1], 3)
    good = [(i, v.tolist(), "a", 1.0) for i, v in enumerate(c)]
    bad = [(100, None), (101, []), (102, [1.0] * 4), (103, [1.0, None, 1.0, 1.0, 1.0]), (104, [1.0, float("nan"), 1.0, 1.0, 1.0]), (105, [float("inf")] * 5), (106, [1e300] + [0.0] * 4)]
    rows = good + [(i, v, None, None) for i, v in bad] + [(0, c[0].tolist(), "b", None), (None, c[1].tolist(), "c", 2.0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string, whitened double").repartition(3)
    got = whitening.whiten(vectors).toPandas()
    x = np.floor(64 * np.vstack([c, c[:2]])).astype(np.int64) + 1_000_000
    assert len(got) == 62 * 5 and set(got.n) == {62} and (got.vec_id == 0).sum() == 10 and got.vec_id.isna().sum() == 5
    once = got[got.vec_id.notna()].drop_duplicates(["vec_id", "component"])
    n, s, y, e, q = plain(x)
    wide = once.pivot_table(index="vec_id", columns="component", values="whitened").to_numpy()
    want = y[:60] @ q / np.sqrt(e)
    assert np.abs(np.abs(wide) - np.abs(want)).max() < 1e-9 and got.identity_error.iloc[0] < 1e-10


def test_no_spread_and_no_rows(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], kind)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], kind)).collect()
    assert len(same) == 8 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in same)
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(4)], kind)).toPandas()
    assert line[line.component == 2].whitened.isna().all() and line[line.component == 1].whitened.notna().all() and line.identity_error.iloc[0] < 1e-12


def test_deviation_beyond_64_bits(spark):
    rows = [(i, [float(i * 1 << 35), 0.0]) for i in range(3)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: r.deviation for r in got} == {0: None, 1: 0, 2: None}
