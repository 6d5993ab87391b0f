"""Exact top-k and hard negatives against brute force in whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import hard_negatives, inner_topk, vector_blocks


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * float(x)) for x in vector]


def product(a, b):
    return min(max(sum(x * y for x, y in zip(a, b)), -(1 << 63)), (1 << 63) - 1)


def id_key(i):
    return (1 << 63) if i is None else i


def plain_top(rows, every, count=5):
    known = [(i, whole(v)) for i, v, *_ in rows if whole(v) is not None]
    out = []
    for q, (qid, qv) in enumerate(known):
        if qid is None or qid % every:
            continue
        scored = sorted((-product(qv, v), id_key(i)) for c, (i, v) in enumerate(known) if c != q)[:count]
        out += [(qid, n + 1, None if i == 1 << 63 else i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out, key=str)


def plain_negatives(rows, every):
    known = []
    for i, v, label, *_ in rows:
        if label is not None and whole(v) is not None:
            known.append((i, whole(v), (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for a, (aid, av, al) in enumerate(known):
        if aid is None or aid % every:
            continue
        scored = sorted((-product(av, v), id_key(i), label) for c, (i, v, label) in enumerate(known) if c != a)
        for p, pid, _ in [s for s in scored if s[2] == al][:5]:
            fit = [s for s in scored if s[2] != al and -80 * p <= -100 * s[0] <= -100 * p][:5]
            show = lambda i: None if i == 1 << 63 else i
            out += [(aid, show(pid), n + 1, show(i), -p, -s) for n, (s, i, _) in enumerate(fit)]
    return sorted(out, key=str)


def top(df, every):
    rows = inner_topk.top_products(df, F.col("vec_id") % every == 0).collect()
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in rows), key=str)


def negatives(df, every):
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r[n] for n in names) for r in hard_negatives.hard_negatives(df, F.col("vec_id") % every == 0, moved).collect()), key=str)


SCHEMA = "vec_id long, embedding array<double>, label int"


def table(n, dims, seed, kind):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * np.exp(rng.normal(size=(n, 1)) * (kind == "lengths"))
    if kind == "few values":
        x = rng.integers(-1, 2, size=(n, dims)) / 64.0
    if kind == "one hot group":
        x[: n // 3] = x[0]
    if kind == "low rank":
        x = rng.normal(size=(n, 3)) @ rng.normal(size=(3, dims)) + 0.01 * x
    return [(int(i), [float(v) for v in row], int(label)) for i, row, label in zip(rng.permutation(n * 2)[:n], x, rng.integers(0, 4, n))]


@pytest.mark.parametrize("kind", ["plain", "lengths", "few values", "one hot group", "low rank"])
def test_against_brute_force(spark, monkeypatch, kind):
    """Several groups of queries, stripes and slabs; ties and equal vectors."""
    monkeypatch.setattr(vector_blocks, "GROUP_ROWS", 40)
    monkeypatch.setattr(vector_blocks, "ROWS_A_STRIPE", 8)
    monkeypatch.setattr(inner_topk, "SLAB", 64)
    monkeypatch.setattr(hard_negatives, "SLAB", 32)
    rows = table(600, 20, 3, kind)
    df = spark.createDataFrame(rows, SCHEMA)
    assert top(df, 5) == plain_top(rows, 5)
    assert negatives(df, 10) == plain_negatives(rows, 10)


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (100, [0.5, 0.25], 2), (7, [1.0, 1.9], 1), (1, [1.0, 1.9], 2),
        (2, [0.9, 1.9], 3), (None, [1.0, 1.95], 1), (None, [1.0, 1.95], 2), (3, None, 1), (4, [None, 1.0], 1), (5, [nan, 1.0], 1),
        (50, [inf, 0.0], 1), (6, [1.0, 2.0], None), (8, [], 1), (200, [], 2), (9, [1.0, 2.0, 3.0], 2), (10, [-1.0, -2.0], 1), (11, [0.0, 0.0], 1),
        (12, [1.0], 2), (300, [0.0, 0.0], 2), (400, [-1.0, -2.0], 2), (13, [0.001, -0.001], 5),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert top(df, 50) == plain_top(rows, 50)
    assert negatives(df, 100) == plain_negatives(rows, 100)
    more = df.selectExpr("*", "1 as id", "2 as row", "3 as score", "4 as rank", "5 as pair", "6 as norm", "true as asked", "0 as kind")
    assert top(more, 50) == plain_top(rows, 50)
    assert negatives(more, 100) == plain_negatives(rows, 100)
    for empty in (df.limit(0), df.where("vec_id = 3"), df.where("vec_id = 7")):
        assert top(empty, 50) == [] and negatives(empty, 100) == []


def test_huge_components(spark):
    """Products beyond doubles' whole numbers stay exact, beyond a long they stop at its ends."""
    big = float(1 << 40)
    rows = [(0, [big, 1.0], 1), (1, [big / 2**30, 3.0], 1), (2, [big, 2.0], 1), (3, [-big, 5.0], 2), (4, [1024.0, 1.0], 2), (5, [1024.0, 2.0], 2), (100, [2.0**20, 2.0], 1), (6, [1e300, 1.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert top(df, 50) == plain_top(rows, 50)
    assert negatives(df, 100) == plain_negatives(rows, 100)


def test_most_candidates_are_dropped_early():
    """Vectors of few strong directions: the scan scores a small share of the pairs."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    x = np.floor(256 * (rng.normal(size=(6000, 4)) @ rng.normal(size=(4, 64)) + 0.02 * rng.normal(size=(6000, 64))))
    turn = np.ascontiguousarray(np.linalg.eigh(x.T @ x)[1][:, ::-1])
    norm = np.linalg.norm(x, axis=1)

    def batch(at):
        packed = pa.array([x[i].astype(np.int16).tobytes() for i in at], pa.binary())
        columns = [pa.array(at), pa.array(at), pa.array(np.full(len(at), 64), pa.int32()), packed, pa.array(norm[at])]
        return pa.RecordBatch.from_arrays(columns, ["row", "id", "size", "vec", "norm"])

    scan = inner_topk.NormScan(turn, 5)
    scan.ask(batch(np.arange(0, 6000, 100)))
    order = np.argsort(-norm, kind="stable")
    scan.look(batch(order))
    found = scan.found().to_pandas()
    scores = x @ x.T
    for q, part in found.groupby("query_id"):
        others = np.delete(scores[q], q)
        assert part.score.tolist() == sorted(others.tolist(), reverse=True)[:5]
    assert scan.scored < 0.35 * 60 * 6000
