"""Targets against plain resharing, and the mix against its budgets."""

import random
from collections import defaultdict

import pytest

from lamina.llm import mixing


def reshared(sizes: dict, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            return capped
        level = (total - sum(capped.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return capped | {s: level * weight[s] for s in free}
        capped |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 100, 1000, 90000]) for i in range(rng.randrange(1, 12))}
    if seed % 2:
        sizes[None] = 77
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    want = reshared(sizes)
    assert got.keys() == want.keys()
    for s in got:
        assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def docs(spark, count=600):
    rng = random.Random(3)
    rows = []
    for i in range(count):
        source = rng.choice(["hot"] * 5 + ["b", "c", "d", None, "é"])
        text = rng.choice([None, "", " \n", "w " * rng.randrange(1, 200), "one"])
        rows.append((i, text, source, "extra"))
    rows += rows[:3]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, times string")


def mixed(rows):
    measured = mixing.measured(rows)
    return mixing.taken(measured, mixing.thresholds(measured.select("source", "size", "place"))).collect()


def test_budgets(spark):
    rows = docs(spark)
    got = mixed(rows)
    assert len(got) == rows.count()
    taken, target, largest, sizes = defaultdict(int), {}, defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r.times <= 3
        taken[r.source] += r["size"] * r.times
        sizes[r.source] += r["size"]
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
    for source, size in sizes.items():
        assert all(r.source_size == size for r in got if r.source == source)
        assert abs(taken[source] - target[source]) <= 2 * largest[source]
    again = mixed(rows.repartition(7))
    key = lambda r: (r.doc_id, r.times, r.place)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_thresholds_are_nested_and_refined(spark, monkeypatch):
    """With one bit a level the search refines again and again and finds the same rows."""
    rows = docs(spark, 200)
    want = sorted((r.doc_id, r.times) for r in mixed(rows))
    monkeypatch.setattr(mixing, "FIRST_BITS", 2)
    monkeypatch.setattr(mixing, "NEXT_BITS", 7)
    assert sorted((r.doc_id, r.times) for r in mixed(rows)) == want


def test_rows_of_the_mix(spark):
    rows = docs(spark)
    got = mixing.mix(rows)
    assert got.columns == rows.columns
    count = defaultdict(int)
    for r in got.collect():
        count[r.doc_id] += 1
    want = defaultdict(int)
    for r in mixed(rows):
        want[r.doc_id] += r.times
    assert count == {k: v for k, v in want.items() if v}


def test_empty_and_blank(spark):
    rows = docs(spark)
    assert mixed(rows.limit(0)) == []
    blank = mixed(rows.where("text is null"))
    assert blank and all(r.times == 1 and r.target == 0 and r["size"] == 0 for r in blank)
