from pyspark.sql import functions as F

from lamina.functions import scalars


def one(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_ordinal_code_reads_text_numbers(spark):
    df = spark.createDataFrame([("3",), ("3.0",), (" 5 ",), ("x",), (None,)], "t string")
    assert [r[0] for r in one(df, scalars.ordinal_code(scalars.number_of(df, "t")))] == [3, 3, 5, 0, 0]


def test_parse_double_takes_whole_finite_numbers_only(spark):
    good = {"12": 12.0, "-1.5e3": -1500.0, "+.5": 0.5, " 7": 7.0, "\t3": 3.0, "8. ": 8.0, "1E2": 100.0}
    bad = ["$12", "", "NaN", "inf", "-Infinity", "1d", "30f", "nineteen", "1,5", "0x1p3", "1e", "1e999", ".", "--1"]
    df = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string")
    for text, value, rejected in one(df, "t", scalars.parse_double(F.col("t")), scalars.is_rejected(F.col("t"))):
        assert value == good.get(text) and rejected == (text not in good), text


def test_flags(spark):
    df = spark.createDataFrame([("true",), (" FALSE",), ("1",), (None,)], "t string")
    assert [r[0] for r in one(df, scalars.flag_of(F.col("t")))] == [True, False, None, None]


def test_clips_leave_null_alone(spark):
    df = spark.createDataFrame([(None,), (1.0,), (7.0,), (-7.0,)], "x double")
    assert [r[0] for r in one(df, scalars.clip_above(F.col("x"), 5.0))] == [None, 1.0, 5.0, -7.0]
    assert [r[0] for r in one(df, scalars.clip_between(F.col("x"), -5.0, 5.0))] == [None, 1.0, 5.0, -5.0]
    assert [r[0] for r in one(df, scalars.clip_above(F.col("x"), None))] == [None, 1.0, 7.0, -7.0]


def test_finite_or_zero(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (2.0,)], "x double")
    assert [r[0] for r in one(df, scalars.finite_or_zero(F.col("x")))] == [0.0, 0.0, 0.0, 0.0, 2.0]


def test_standardised_without_spread_is_zero(spark):
    df = spark.createDataFrame([(5.0,), (9.0,)], "x double")
    assert [r[0] for r in one(df, scalars.standardised(F.col("x"), 5.0, 0.0))] == [0.0, 0.0]
    assert [r[0] for r in one(df, scalars.standardised(F.col("x"), 5.0, 2.0))] == [0.0, 2.0]


def test_safe_ratio_and_words(spark):
    df = spark.createDataFrame([(1, 0, 1), (2, 4, 0)], "a int, b int, c int")
    assert [r[0] for r in one(df, scalars.safe_ratio(F.col("a"), F.col("b")))] == [0.0, 0.5]
    assert [r[0] for r in one(df, scalars.impact_word(F.col("c")))] == ["Alto", "Baixo"]
    assert [r[0] for r in one(df, scalars.hit_word(F.col("a"), F.col("c")))] == ["SIM", "NAO"]
