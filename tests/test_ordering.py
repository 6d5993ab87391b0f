import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lamina import session
from lamina.operators import ordering


def test_ordinal_equals_global_row_number(spark):
    df = spark.range(5000).select("id", ((F.col("id") * 7919) % 97).alias("v")).repartition(8)
    got = ordering.with_ordinal(df, [F.asc("v"), F.asc("id")], "n", start=1)
    window = Window.orderBy("v", "id")
    assert got.withColumn("w", F.row_number().over(window)).filter("n <> w").count() == 0
    assert got.count() == 5000


def test_ordinal_of_nothing_and_of_one(spark):
    assert ordering.with_ordinal(spark.range(0), [F.asc("id")]).count() == 0
    assert [tuple(r) for r in ordering.with_ordinal(spark.range(1), [F.asc("id")]).collect()] == [(0, 0)]


@pytest.mark.parametrize("bound, window_rows", [(200_000, 100), (0, 100), (0, 5000)])
def test_rank_in_a_huge_group(spark, monkeypatch, bound, window_rows):
    monkeypatch.setattr(session, "BROADCAST_ROWS", bound)
    group = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("g"), F.col("id") % 50))
    df = spark.range(4000).select("id", group.alias("g"), (F.col("id") * 31 % 101).alias("v"))
    got = ordering.rank_within_group(df, "g", [F.desc("v"), F.asc("id")], "r", window_rows)
    window = Window.partitionBy("g").orderBy(F.desc("v"), "id")
    assert got.columns == ["id", "g", "v", "r"]
    assert got.withColumn("w", F.row_number().over(window)).filter("r <> w").count() == 0
    assert got.count() == 4000


@pytest.mark.parametrize("n, train", [(778, 622), (1, 0), (0, 0), (5, 4)])
def test_split_sizes(spark, n, train):
    df = spark.range(n).withColumn("k", F.reverse(F.lpad(F.col("id").cast("string"), 6, "0")))
    for limits in ({}, {"gathered": 20, "buckets": 8}):
        parts = ordering.with_ordered_split(df, "k", **limits)
        assert parts.filter("split = 'train'").count() == train
        assert parts.filter("split = 'test'").count() == n - train


def test_split_needs_a_key(spark):
    with pytest.raises(ValueError):
        ordering.with_ordered_split(spark.createDataFrame([(None,), (1,)], "k int"), "k")
    with pytest.raises(ValueError):
        ordering.with_ordered_split(spark.createDataFrame([(1,)] * 10, "k int"), "k")


def test_split_adds_no_shuffle(spark):
    parts = ordering.with_ordered_split(spark.range(100), "id")
    assert "Exchange" not in parts._jdf.queryExecution().executedPlan().toString()


def test_hash_split_is_stable(spark):
    first = {r[0]: r[1] for r in ordering.with_hash_split(spark.range(2000), "id").collect()}
    later = {r[0]: r[1] for r in ordering.with_hash_split(spark.range(4000).repartition(5), "id").collect()}
    assert all(later[k] == v for k, v in first.items())
    assert 0.75 < sum(v == "train" for v in later.values()) / 4000 < 0.85


def test_seeded_sample(spark):
    df = spark.range(1000)
    first = {r[0] for r in ordering.seeded_sample(df, "id", 100, seed=1).collect()}
    again = {
        r[0]
        for r in ordering.seeded_sample(df.repartition(7), "id", 100, seed=1, gathered=20, buckets=8).collect()
    }
    other = {r[0] for r in ordering.seeded_sample(df, "id", 100, seed=2).collect()}
    assert len(first) == 100 and first == again and first != other
    assert ordering.seeded_sample(df, "id", 5000).count() == 1000
    assert ordering.seeded_sample(df, "id", 0).count() == 0
