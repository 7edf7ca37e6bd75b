"""Eigenvectors by refinement against exact figures, and whole results against plain sums."""

import math
from fractions import Fraction

import numpy as np
import pytest

from gridmix.llm import whitening


def matrix(values, seed=3):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0].astype(np.longdouble)
    for _ in range(4):  # Newton-Schulz, to orthogonality in extended precision
        q = q @ (3 * np.eye(len(values), dtype=np.longdouble) - q.T @ q) / 2
    return ((q * np.array(values, np.longdouble)) @ q.T), q


@pytest.mark.parametrize("values", [
    [10.0, 7, 4, 2, 1, 0.5], [5.0, 5 - 1e-6, 5 - 2e-6, 3, 3 - 1e-9, 1], [2.0, 2, 2, 1, 1, 0], [1e8, 1e4, 1, 1 - 1e-7, 1e-3, 0], [1 - 1e-8 * i for i in range(20)],
])
def test_eigenvectors(values):
    v, q = matrix(values)
    e, x = whitening.eigen(((v + v.T) / 2).astype(float))
    top = max(values)
    assert np.abs(e - np.array(values)).max() <= 4e-15 * top
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-14
    assert np.abs((v.astype(float) @ x) - x * e).max() <= 1e-14 * top
    for i, w in enumerate(values):  # single vectors are only defined where eigenvalues are apart by more than rounding
        gap = min([abs(w - u) for j, u in enumerate(values) if j != i])
        if gap > 1e-10 * top:
            assert abs(abs(float(x[:, i] @ q[:, i].astype(float))) - 1) < 1e-12 and np.abs(np.abs(x[:, i]) - np.abs(q[:, i].astype(float))).max() < max(1e-14, 1e-14 * top / gap)


def test_refinement_beats_single_precision():
    v, _ = matrix([3 - 0.01 * i for i in range(64)])
    v = ((v + v.T) / 2).astype(float)
    single = np.linalg.eigh(v.astype(np.float32))[1].astype(float)
    off = lambda m: np.abs(m - np.diag(np.diag(m))).max()
    x = whitening.eigen(v)[1]
    assert off(single.T @ v @ single) > 1e-8 and off(x.T @ v @ x) < 1e-14


def table_of(spark, rows):
    full = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, f"x{i}") for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, label int, id string").repartition(4)


def test_whole_result(spark):
    rng = np.random.default_rng(5)
    good = (rng.normal(size=(300, 6)) @ np.diag([3, 2, 1.5, 1, 0.6, 0.3])).astype(np.float32)
    good[40:60] = good[40]
    rows = list(enumerate(good.tolist()))
    odd = [(900, None), (901, [1, 2, None, 3, 4, 5]), (902, [1, 2, math.nan, 3, 4, 5]), (903, [math.inf, 2, 3, 3, 4, 5]), (904, []), (905, [1.0, 2.0]), (906, [3e38] * 6)]
    out = whitening.whiten(table_of(spark, rows + odd), components=8).collect()
    assert sorted({r["vec_id"] for r in out}) == list(range(300)) and len(out) == 300 * 6
    x = [[math.floor(Fraction(float(c)) * 1024) + 100000 for c in v] for v in good]
    n, s = 300, [sum(c) for c in zip(*x)]
    z = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(v, s)] for v in x])
    cov = z.T @ z / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    w = np.zeros((300, 6))
    for r in out:
        w[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == sum((n * a - b) ** 2 for a, b in zip(x[r["vec_id"]], s))
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / np.trace(cov), rel=1e-10) and 0 <= r["identity_error"] < 1e-10
    want = z @ u / np.sqrt(e)
    sign = np.sign((w * want).sum(0))
    assert np.abs(w * sign - want).max() < 1e-9


def test_odd_tables(spark):
    assert whitening.whiten(table_of(spark, [])).count() == 0
    assert whitening.whiten(table_of(spark, [(1, None), (2, [None, 1.0])])).count() == 0
    assert whitening.whiten(table_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    one = whitening.whiten(table_of(spark, [(i, [i, 7.0, 0.0]) for i in range(9)])).collect()  # constant dimensions
    assert len(one) == 9 and {r["component"] for r in one} == {1}
    assert abs(sum(r["whitened"] ** 2 for r in one) / 9 - 1) < 1e-12


def test_deviation_is_exact_or_an_error(spark):
    far = [(i, [c, 1.0]) for i, c in enumerate([2e5, -2e5, 1e5, 0.0])]
    out = {r["vec_id"]: r["deviation"] for r in whitening.whiten(table_of(spark, far)).collect()}
    x = [[math.floor(c * 1024) + 100000 for c in v] for _, v in far]
    s = [sum(c) for c in zip(*x)]
    assert out == {i: sum((4 * a - b) ** 2 for a, b in zip(v, s)) for i, v in enumerate(x)}
    with pytest.raises(Exception, match="(?i)overflow|too large|convert|range"):
        whitening.whiten(table_of(spark, [(i, [c, 1.0]) for i, c in enumerate([2e9, -2e9])])).collect()
