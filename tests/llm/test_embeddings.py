"""The vector graph against brute force."""

import math
from dataclasses import replace

import numpy as np
import pytest

from lamina.llm import embedding_graph as eg

SMALL = eg.Settings(shard=60, widest=400, sample=2000)


def clustered(seed=0, n=700):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, 16)) * 1.5
    x = base[rng.integers(0, 12, n)] + rng.normal(size=(n, 16))
    for start, size in ((0, 40), (100, 5), (200, 2)):
        x[start : start + size] = x[start] + rng.normal(size=(size, 16)) * 0.05
    x[300:330] = x[300]
    return x.astype(np.float32).astype(float)


def brute(x, radius=0.95):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    links = u @ u.T >= radius
    np.fill_diagonal(links, False)
    root = np.arange(len(x))
    while True:
        low = np.minimum(root, np.where(links, root[None, :], len(x)).min(axis=1))
        low = low[low]
        if (low == root).all():
            return links.sum(axis=1), root
        root = low


@pytest.mark.parametrize("settings", [SMALL, replace(SMALL, widest=50), eg.Settings()])
def test_against_brute_force(spark, settings):
    """With narrow shards every cluster is cut into blocks, and pairs of blocks are compared."""
    x = clustered()
    rows = [(i, v.tolist(), "x", 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string, n int")
    got = {r.vec_id: r for r in eg.near_duplicates(df, settings=settings).collect()}
    degree, root = brute(x)
    assert len(got) == len(x)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= degree).all() and found.sum() >= 0.98 * degree.sum()
    assert np.mean([got[i].component_id == root[i] for i in range(len(x))]) >= 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert got[0].recall >= 0.97


def test_odd_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.01]), (4, [0.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]), (8, [nan, 1.0]),
        (9, [inf, 1.0]), (10, [None, 1.0]), (11, [1.0, 0.0, 0.0]), (None, [0.0, 1.0]), (12, [1e-30, 0.0]), (12, [1e-30, 0.0]), (13, [3e38, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in eg.near_duplicates(df).collect()))
    line = {1, 2, 3, 12, 13}
    want = []
    for i, _ in rows:
        if i in line:
            want.append((i, 5, 1, i == 1))
        elif i in (4, None):
            want.append((i or 0, 1, 4, i == 4))
        else:
            want.append((i, 0, i, True))
    assert got == sorted(want)
    assert eg.near_duplicates(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert eg.near_duplicates(alone).first().n_links == 0
