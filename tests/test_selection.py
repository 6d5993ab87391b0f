import datetime
import decimal
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lamina.operators import selection
from lamina.operators.selection import quantiles, select_ranks, upper_fence

TINY = {"gathered": 20, "buckets": 8}


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(3)


def test_small_fixture(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 10.0])
    at = quantiles(df, {"x": [0.25, 0.5, 0.75]})["x"]
    assert at == {0.25: 1.75, 0.5: 2.5, 0.75: 4.75}
    assert upper_fence(at[0.25], at[0.75]) == 9.25
    by_index = quantiles(df, {"x": [0.25, 0.5, 0.75]}, rule="index")["x"]
    assert by_index == {0.25: 2.0, 0.5: 3.0, 0.75: 10.0}


def test_missing_values_are_left_out(spark):
    df = frame(spark, [None, float("nan"), 4.0, 2.0])
    assert quantiles(df, {"x": [0.5]})["x"][0.5] == 3.0
    assert quantiles(frame(spark, [None, float("nan")]), {"x": [0.5]})["x"][0.5] is None


def test_many_rounds_find_every_rank(spark):
    rng = random.Random(7)
    values = [rng.lognormvariate(0, 2) for _ in range(3000)]
    ranks = [0, 1, 749, 1500, 2250, 2998, 2999]
    got = select_ranks(frame(spark, values), {"x": ranks}, **TINY)["x"]
    expected = sorted(values)
    assert got == {r: expected[r] for r in ranks}


@pytest.mark.parametrize("hot", [-1.0, 0.5, 2.0])
def test_one_value_on_a_third_of_the_rows(spark, hot):
    rng = random.Random(11)
    values = [hot if i % 3 == 0 else rng.random() for i in range(1500)]
    ranks = list(range(0, 1500, 187)) + [499, 500, 999, 1000, 1499]
    got = select_ranks(frame(spark, values), {"x": ranks}, **TINY)["x"]
    expected = sorted(values)
    assert got == {r: expected[r] for r in set(ranks)}


def test_text_keys(spark):
    words = [f"k{i * 7919 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(w,) for w in words], "x string")
    got = select_ranks(df, {"x": [0, 400, 999]}, **TINY)["x"]
    assert got == {0: "k0000", 400: "k0400", 999: "k0999"}


def test_numbers_of_any_size_take_few_passes(spark, monkeypatch):
    """From the smallest to the largest double, both signs, zeros, infinities and neighbours one bit apart."""
    rng = random.Random(2)
    values = [rng.choice((-1, 1)) * math.ldexp(1 + rng.random(), rng.randrange(-1074, 1023)) for _ in range(600)]
    one = 1.0
    for _ in range(300):
        values += [one, -one]
        one = math.nextafter(one, 2)
    values += [0.0] * 50 + [5e-324, -5e-324, 1.7e308, -1.7e308, math.inf, math.inf, -math.inf]
    passes = []
    plain = selection._pass
    monkeypatch.setattr(selection, "_pass", lambda *a: passes.append(1) or plain(*a))
    ranks = list(range(0, len(values), 29))
    got = select_ranks(frame(spark, values), {"x": ranks}, gathered=2)["x"]
    expected = sorted(values)
    assert got == {r: expected[r] for r in ranks}
    assert len(passes) <= 5


def test_other_types_and_many_columns(spark):
    rng = random.Random(3)
    big = [(1 << 62) + rng.randrange(4000) for _ in range(500)]
    days = [datetime.date(1950, 1, 1) + datetime.timedelta(rng.randrange(40_000)) for _ in range(500)]
    times = [datetime.datetime(2001, 1, 1) + datetime.timedelta(microseconds=rng.randrange(1 << 50)) for _ in range(500)]
    cents = [decimal.Decimal(rng.randrange(-(10**6), 10**6)).scaleb(-2) for _ in range(500)]
    words = ["é" * rng.randrange(3) + "same start " * 3 + chr(rng.randrange(32, 3000)) for _ in range(500)]
    data = list(zip(big, days, times, cents, words, [i % 3 == 0 for i in range(500)]))
    df = spark.createDataFrame(data, "a bigint, b date, c timestamp, d decimal(12,2), e string, f boolean").repartition(3)
    ranks = [0, 1, 124, 250, 499]
    got = select_ranks(df, {n: ranks for n in "abcdef"}, **TINY)
    for i, n in enumerate("abcdef"):
        key = (lambda w: w.encode()) if n == "e" else None
        expected = sorted((row[i] for row in data), key=key)
        assert got[n] == {r: expected[r] for r in ranks}, n


def test_rank_outside(spark):
    with pytest.raises(IndexError):
        select_ranks(frame(spark, [1.0]), {"x": [1]})


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-3, 3).map(float), min_size=1, max_size=60), st.integers(0, 59))
def test_against_sorted(spark, values, rank):
    values = values * 8
    rank = min(8 * rank, len(values) - 1)
    got = select_ranks(frame(spark, values), {"x": [rank]}, gathered=20, buckets=8)["x"]
    assert got[rank] == sorted(values)[rank]


def test_approximate_is_opt_in(spark):
    df = frame(spark, [float(i) for i in range(101)])
    assert quantiles(df, {"x": [0.5]}, rule="approx")["x"][0.5] == 50.0
