import math

import pytest
from pyspark.sql import functions as F

from lamina.operators import explore
from tests.conftest import rows


def test_groups_keep_null_and_break_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "g string")
    top = explore.top_groups_by_count(df, "g", 3)
    assert [r["g"] for r in top.collect()] == ["c", None, "a"]
    assert dict(rows(explore.group_counts(df, "g").select("g", "percent")))["c"] == 40.0
    assert explore.group_total(df, "g").first()[0] == 4


def test_top_per_group_ties_by_key(spark):
    df = spark.createDataFrame([(3, "g", 5.0), (1, "g", 5.0), (2, "g", 5.0), (4, "g", None), (5, "h", 1.0)], "k int, g string, v double")
    got = explore.top_per_group(df, "g", "v", "k", ["k"], n=2)
    assert [tuple(r) for r in got.collect()] == [("g", 1, 5.0, 1), ("g", 2, 5.0, 2), ("h", 5, 1.0, 1)]
    tally = explore.best_per_group_tally(df, "g", "v", "k", view="ranked_rows")
    assert [tuple(r) for r in tally.collect()] == [("g", 4, 1), ("h", 1, 1)]
    assert spark.sql("select max(rank_in_industry) from ranked_rows").first()[0] == 4


def test_rank_limit_is_applied_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("g"), F.rand(1).alias("v"))
    plan = explore.top_per_group(df, "g", "v", "id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_summary_and_outliers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,), (float("nan"),)], "v double")
    s = explore.measure_summary(df, "v").first()
    assert (s["count"], s["median"], s["q1"], s["q3"], s["upper_fence"]) == (4, 2.5, 1.75, 4.75, 9.25)
    assert math.isclose(s["std_pop"], 3.5355339059327378) and math.isclose(s["std_samp"], 4.08248290463863)
    assert [r[0] for r in explore.flag_outliers(df, "v").select("is_outlier").collect()].count(True) == 1
    share = explore.outlier_share(df, "v").first()
    assert (share["values"], share["outliers"], share["outlier_percent"]) == (4, 1, 25.0)
    assert explore.measure_summary(df.limit(1), "v").first()["std_samp"] is None


def test_histogram(spark):
    df = spark.createDataFrame([(0.0,), (50.0,), (100.0,), (None,)], "v double")
    counts = {r["bin"]: r["count"] for r in explore.histogram(df, "v").collect()}
    assert len(counts) == 25 and {b for b, n in counts.items() if n} == {1, 13, 25}
    flat = spark.createDataFrame([(5.0,)] * 4, "v double")
    counts = {r["bin"]: r["count"] for r in explore.histogram(flat, "v").collect()}
    assert counts[1] == 4 and sum(counts.values()) == 4
    empty = explore.histogram(df.filter("v > 1000"), "v")
    assert empty.count() == 25 and empty.agg(F.sum("count")).first()[0] == 0


def matrix(df, **options):
    return {(r["row_name"], r["col_name"]): r["r"] for r in explore.correlation_matrix(df, ["a", "b"], **options).collect()}


def test_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 5.0), (None, 1.0), (4.0, 7.0)], "a double, b double")
    pairs = matrix(df)
    assert math.isclose(pairs["a", "b"], 0.9971764649, abs_tol=1e-8)
    assert pairs["a", "b"] == pairs["b", "a"]
    assert pairs["a", "a"] == pytest.approx(1.0) and pairs["b", "b"] == pytest.approx(1.0)
    assert math.isclose(matrix(df, nulls="zero")["a", "b"], 0.81348921, abs_tol=1e-7)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert matrix(flat)["a", "b"] == 0.0 and matrix(flat)["a", "a"] == 0.0


def test_ordered_by_value(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 3.0), (3, None), (4, 3.0)], "k int, v double")
    assert rows(explore.ordered_by_value(df, "v", "k")) == [(1, 5.0, 2), (2, 3.0, 0), (4, 3.0, 1)]
