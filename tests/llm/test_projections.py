"""Embedding links against brute force: groups of near and exact copies, crowded signs, recall at the threshold."""

import math

import numpy as np
import pytest

from gridmix.llm import projections
from gridmix.llm.simhash import labels_of


def table_of(spark, rows):
    full = [(i, None if v is None else [None if c is None else float(c) for c in v], 0, 1) for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, label int, node int").repartition(5)


def plain(rows, least=0.9):
    """vec_id: (links, least id reached) of all rows."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {i: (0, i) for i, _ in rows}
    for d in {len(v) for _, v in good}:
        ids = np.array([i for i, v in good if len(v) == d])
        x = np.stack([v / np.abs(v).max() for _, v in good if len(v) == d])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= least
        np.fill_diagonal(near, False)
        order = np.argsort(ids)
        ids, near = ids[order], near[order][:, order]
        label = labels_of(len(ids), *np.nonzero(near))
        out |= {int(i): (int(n), int(ids[k])) for i, n, k in zip(ids, near.sum(1), label)}
    return out


def found(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}


def copies(rng, d, groups):
    """Rows in groups of near copies: (size, least cosine of a copy to its source)."""
    out = []
    for size, cosine in groups:
        v = rng.normal(size=d)
        v /= np.linalg.norm(v)
        for _ in range(size):
            w = rng.normal(size=d)
            w -= (w @ v) * v
            c = rng.uniform(cosine, 1)
            out.append((c * v + math.sqrt(1 - c * c) * w / np.linalg.norm(w)) * rng.uniform(0.1, 9))
    return out


@pytest.mark.parametrize("hot", [projections.HOT, 12])
def test_groups(spark, hot):
    rng = np.random.default_rng(8)
    x = [*copies(rng, 32, [(150, 0.985), (60, 0.99), (30, 0.97), *[(3, 0.97)] * 20, *[(2, 0.96)] * 20]), *rng.normal(size=(300, 32))]
    x += [x[3]] * 40 + [x[-1]] * 2
    order = rng.permutation(len(x))
    rows = [(int(7 * k), x[i].tolist()) for k, i in enumerate(order)]
    rows += [(100_001, None), (100_002, []), (100_003, [0.0] * 32), (100_004, [1.0, None]), (100_005, [math.nan] * 32), (100_006, [math.inf] + [1.0] * 31), (100_007, [3.0, 4.0]), (100_008, [0.6, 0.8])]
    got, want = found(projections.near_duplicates(table_of(spark, rows), hot=hot)), plain(rows)
    assert got.keys() == want.keys()
    links = sum(n for n, _ in want.values())
    assert sum(min(got[i][0], want[i][0]) for i in want) >= 0.999 * links and all(got[i][0] <= want[i][0] for i in want)
    assert np.mean([got[i] == want[i] for i in want]) > 0.97
    assert got[100_007] == (1, 100_007) == (1, got[100_008][1])


def test_recall_at_the_threshold(spark):
    """Pairs just over the threshold, the hardest ones: nearly all are found, and none below it."""
    rng = np.random.default_rng(2)
    x = []
    for k in range(400):
        v, w = rng.normal(size=(2, 48))
        v /= np.linalg.norm(v)
        w -= (w @ v) * v
        c = 0.9005 if k % 2 else 0.8995
        x += [v, c * v + math.sqrt(1 - c * c) * w / np.linalg.norm(w)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = found(projections.near_duplicates(table_of(spark, rows))), plain(rows)
    pairs = sum(n for n, _ in want.values()) / 2
    assert pairs == 200 and sum(n for n, _ in got.values()) / 2 >= 0.96 * pairs
    assert all(got[i][0] <= want[i][0] for i in want)


def test_balls_hold_large_groups(spark):
    """Pairs of a large group are not formed one by one."""
    rng = np.random.default_rng(6)
    x = copies(rng, 24, [(600, 0.99)]) + [*rng.normal(size=(200, 24))]
    nodes = table_of(spark, [(i, v.tolist()) for i, v in enumerate(x)]).selectExpr("vec_id AS node", "embedding AS v")
    ball, links = projections.links_of(nodes, 800)
    size = [r["count"] for r in ball.groupBy("ball").count().collect()]
    assert max(size) > 560 and links.count() < 600 * 40 < 600 * 599 / 2


def test_chance():
    """The stated chance of a collision is the measured one."""
    rng = np.random.default_rng(1)
    v, w = np.zeros(16), np.zeros(16)
    v[0], w[0], w[1] = 1, 0.9, math.sqrt(1 - 0.81)
    a = rng.normal(size=(200_000, 5, 16))
    y, z = a @ v, a @ w
    hit = ((y[:, :4] > 0) == (z[:, :4] > 0)).all(1) & (np.abs(y[:, 4] - z[:, 4]) <= projections.REACH)
    assert abs(hit.mean() - projections.chance(4)) < 0.005


def test_odd_tables(spark):
    assert found(projections.near_duplicates(table_of(spark, []))) == {}
    assert found(projections.near_duplicates(table_of(spark, [(3, None), (1, [0.0])]))) == {3: (0, 3), 1: (0, 1)}
    assert found(projections.near_duplicates(table_of(spark, [(i, [1.0, 2.0]) for i in (9, 4, 7)]))) == {i: (2, 4) for i in (9, 4, 7)}
    rows = projections.near_duplicates(table_of(spark, [(None, [1.0, 2.0]), (None, [1.0, -2.0]), (5, [1.0, 2.0])])).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in rows) == [("5", 1, 5, True), ("None", 0, None, True), ("None", 1, 5, False)]
    huge = found(projections.near_duplicates(table_of(spark, [(1, [3e38, 3e38]), (2, [1e-40, 1e-40]), (3, [1.0, -1.0])])))
    assert huge == {1: (1, 1), 2: (1, 1), 3: (0, 3)}
