import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lamina import session
from lamina.domain import FeatureSpec
from lamina.operators import features
from lamina.operators.ordering import with_ordered_split
from tests.conftest import rows

SPEC = FeatureSpec()
SCHEMA = (
    "row_key int, company_revenue_usd double, employee_count double, is_public_company boolean,"
    " industry_primary string, attack_vector_primary string, data_type string,"
    " confidence_tier string, quality_score double, total_loss_usd double"
)


def refined(spark, n=50):
    data = [
        (
            i,
            None if i % 9 == 0 else float(i * i % 37),
            float(i % 7),
            i % 2 == 0,
            ["31-33", "51", None][i % 3],
            "a.b" if i % 4 else "c",
            "new" if i >= 45 else "old",
            ["1", "2.0", "bad", None][i % 4],
            None if i % 11 == 0 else float(i),
            float(i) if i != 3 else 1e6,
        )
        for i in range(n)
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_fit_sees_train_only(spark):
    df = refined(spark)
    _, params = features.build_features(df)
    changed = df.withColumn(
        "total_loss_usd", F.when(F.col("row_key") >= 40, -1e9).otherwise(F.col("total_loss_usd"))
    ).withColumn("industry_primary", F.when(F.col("row_key") >= 40, "zz").otherwise(F.col("industry_primary")))
    _, again = features.build_features(changed)
    assert params == again
    assert params.vocabulary["data_type"] == ("old",)
    assert params.vocabulary["industry_primary"] == ("31-33", "51")


def test_transform_effects(spark):
    table, params = features.build_features(refined(spark))
    assert "industry_primary_31-33" in table.columns
    assert "attack_vector_primary_a_b" in table.columns
    assert not set(SPEC.nominal) & set(table.columns)
    by_key = {r["row_key"]: r for r in table.collect()}
    assert len(by_key) == 50
    assert by_key[2]["industry_primary_31-33"] == 0 == by_key[2]["industry_primary_51"]
    assert by_key[49]["data_type_old"] == 0
    assert [by_key[i]["confidence_tier"] for i in range(4)] == [1, 2, 0, 0]
    assert by_key[3]["total_loss_usd"] == params.fence
    assert by_key[9]["company_revenue_usd"] == params.medians["company_revenue_usd"]
    mean, std = params.means["employee_count"], params.deviations["employee_count"]
    assert by_key[5]["employee_count_scaled"] == pytest.approx((5 - mean) / std)
    assert by_key[0]["split"] == "train" and by_key[49]["split"] == "test"


def test_transform_is_narrow(spark):
    df = refined(spark)
    params = features.fit(df)
    plan = features.transform(df, params)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_empty_and_single_row(spark):
    params = features.fit(refined(spark, 0))
    assert params.fence is None and params.medians["employee_count"] is None
    assert features.transform(refined(spark, 3), params).count() == 3
    assert features.build_features(refined(spark, 1))[0].count() == 1
    assert features.build_features(refined(spark, 0))[0].count() == 0


def test_no_spread_scales_to_zero(spark):
    df = refined(spark).withColumn("employee_count", F.when(F.col("row_key") < 40, 4.0).otherwise(9.0))
    table, _ = features.build_features(df)
    assert {r[0] for r in table.select("employee_count_scaled").collect()} == {0.0}


def test_params_survive_storage(spark):
    params = features.fit(refined(spark))
    assert features.read_params(features.params_table(spark, params)) == params
    names = {r["transformation"] for r in features.catalogue(spark, params).collect()}
    assert names == {
        "label_encoding", "one_hot", "missing_number", "scaling_mean", "scaling_deviation",
        "fence_cap", "z_clip_low", "z_clip_high",
    }


def test_names_that_fall_together(spark):
    assert features.dummy_names("c", ["a.b", "a_b"], set()) == ["c_a_b", "c_a_b_2"]


def test_names_that_differ_in_case(spark, tmp_path):
    assert features.dummy_names("c", ["SaaS", "saas"], set()) == ["c_SaaS", "c_saas_2"]
    df = refined(spark).withColumn("industry_primary", F.when(F.col("row_key") % 2 == 0, "SaaS").otherwise("saas"))
    table, _ = features.build_features(df)
    table.write.parquet(str(tmp_path / "layer"))
    assert spark.read.parquet(str(tmp_path / "layer")).count() == 50


def test_a_wide_nominal_column_is_refused(spark):
    df = refined(spark).withColumn("industry_primary", F.concat(F.lit("w"), F.col("row_key")))
    with pytest.raises(ValueError, match="industry_primary"):
        features.build_features(df, FeatureSpec(widest_vocabulary=10))


@pytest.mark.parametrize("categories", [3, 50])
def test_index_table_of_any_width(spark, monkeypatch, tmp_path, categories):
    word = F.concat(F.lit("w"), F.col("row_key") % categories)
    df = refined(spark).withColumn("industry_primary", word)
    spec = FeatureSpec(nominal=("attack_vector_primary", "data_type"), indexed=("industry_primary",))
    for bound in (100_000, 0):
        monkeypatch.setattr(session, "BROADCAST_ROWS", bound)
        table, params = features.build_features(df, spec)
        codes = {r["row_key"]: r["industry_primary_code"] for r in table.collect()}
        words = sorted({f"w{i % categories}" for i in range(40)})
        for i in range(50):
            name = f"w{i % categories}"
            assert codes[i] == (words.index(name) if name in words else len(words))
        # Stored and read again, the parameters give the layer for any frame.
        path = str(tmp_path / f"params-{bound}")
        features.params_table(spark, params).write.parquet(path)
        again = features.transform(df, features.read_params(spark.read.parquet(path)), spec)
        assert {r["row_key"]: r["industry_primary_code"] for r in again.collect()} == codes
        assert set(table.columns) - {"split"} <= set(again.columns)
    vectors, _ = features.one_hot_vector(table, "industry_primary_code", "v")
    assert vectors.count() == 50


@pytest.mark.parametrize("hot_rows", [0, 4, 100])
def test_a_large_stored_index_is_not_sent_to_the_driver(spark, monkeypatch, tmp_path, hot_rows):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(features, "HOT_ROWS", hot_rows)
    words = ["a"] * 9 + ["b", "c", "c", None, None, "new"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "row_key int, word string")
    spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "word string, code bigint").write.parquet(str(tmp_path / "index"))
    looked = features.look_up(df, spark.read.parquet(str(tmp_path / "index")), "word", "row_key", "code")
    # The join with the index is no broadcast, however small its file is; only frequent words are.
    assert "SortMergeJoin [word" in looked._jdf.queryExecution().sparkPlan().toString()
    places = {"a": 0, "b": 1, "c": 2, "new": 3, None: None}
    assert {r["row_key"]: r["code"] for r in looked.collect()} == {i: places[w] for i, w in enumerate(words)}


def test_numbers_that_are_not_finite(spark, tmp_path):
    odd = {1: "inf", 2: "-Infinity", 3: "NaN", 4: "12d", 5: "30f", 6: "1e3", 7: "1e999"}
    cell = F.create_map(*[F.lit(x) for pair in odd.items() for x in pair])
    text = F.coalesce(F.element_at(cell, F.col("row_key").cast("int")), F.col("company_revenue_usd").cast("string"))
    df = refined(spark).withColumn("company_revenue_usd", text)
    table, params = features.build_features(df)
    table.write.parquet(str(tmp_path / "layer"))
    got = {r["row_key"]: r for r in spark.read.parquet(str(tmp_path / "layer")).collect()}
    assert all(math.isfinite(r["company_revenue_usd"]) and math.isfinite(r["company_revenue_usd_scaled"]) for r in got.values())
    assert all(math.isfinite(v) for v in (params.z_low, params.z_high, params.means["company_revenue_usd"]))
    assert all(got[i]["company_revenue_usd"] == got[1]["company_revenue_usd"] for i in (2, 3, 4, 5, 7))


def test_alphabetical_codes(spark):
    df = refined(spark)
    train = df.filter("row_key < 40")
    for widest in (1000, 1):
        coded = features.alphabetical_codes(df, train, ["industry_primary", "data_type"], "row_key", widest=widest)
        got = {r["row_key"]: (r["industry_primary"], r["data_type"]) for r in coded.collect()}
        assert got[0] == (0, 0) and got[1] == (1, 0) and got[2] == (2, 0) and got[49][1] == 1


def test_detection_threshold(spark):
    data = [(i, "1" if i < 6 else "x", "1" if i < 5 else "x", True, float(i)) for i in range(10)]
    df = spark.createDataFrame(data, "row_key int, t60 string, t50 string, flag boolean, total_loss_usd double")
    assert features.detect_features(df) == ["t60", "flag"]
    assert features.detect_features(df.limit(0)) == []


def test_matrix_has_no_missing(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, float("nan"), "4"), (3, float("inf"), None)], "k int, a double, `b.c` string")
    got = features.assemble(df, ["a", "b.c"], ["k"]).select("k", vector_to_array("features").alias("v"))
    assert rows(got) == [(1, [0.0, 0.0]), (2, [0.0, 4.0]), (3, [0.0, 0.0])]


def test_clip_effect(spark):
    df = spark.createDataFrame([(100.0, 5.0), (1.0, -50.0), (None, None)], "total_loss_usd double, company_revenue_usd double")
    params = features.FitParams(fence=10.0, z_low=-10.0, z_high=10.0)
    got = {r["clip"]: r["changed"] for r in features.clip_effect(df, params).collect()}
    assert got == {"fence_cap": 1, "z_clip": 1}
    assert {r["changed"] for r in features.clip_effect(df, features.FitParams()).collect()} == {0}


def test_leakage_audit(spark):
    table, _ = features.build_features(refined(spark))
    assert all(r["passed"] for r in features.leakage_audit(table).collect())
    source = with_ordered_split(refined(spark), "row_key").withColumn("review_flag", F.col("employee_count"))
    _, params = features.build_features(refined(spark))
    found = features.leakage_audit(table, source=source.drop("review_flag"), params=params)
    assert found.count() == 9 and all(r["passed"] for r in found.collect())
    twin = table.withColumn("hidden", F.col("employee_count"))
    source = twin.select("row_key", F.col("hidden").alias("review_flag")).join(source.drop("review_flag"), "row_key")
    mixed = twin.withColumn("split", F.when(F.col("row_key") % 2 == 0, "train").otherwise("test"))
    wrong = features.leakage_audit(mixed, source=source, params=features.FitParams(fence=1.0))
    failed = {r["rule"]: r["offending"] for r in wrong.filter("not passed").collect()}
    assert set(failed) == {"no_train_key_after_the_cut", "no_dropped_column_under_another_name", "parameters_are_those_of_train"}
    assert "review_flag=hidden" in failed["no_dropped_column_under_another_name"]
    leaking = features.leakage_audit(table.withColumn("notes", F.lit("x")))
    assert [r["offending"] for r in leaking.filter("not passed").collect()] == ["notes"]


def plain_kind(rows, numeric):
    """Kind of the pairs (dropped, feature) by plain comparison."""
    held = [(d, f) for d, f in rows if d is not None]
    if held and all(str(d) == str(f) for d, f in rows):
        return "equal"
    both = set(held)
    if len({d for d, _ in both}) < 2 or len(both) != len({d for d, _ in both}) or len(both) != len({f for _, f in both}):
        return None
    if any(f is None for _, f in held):
        return None
    line = sorted(both)
    if numeric and len(line) >= 3:
        steps = [b[1] - a[1] for a, b in zip(line, line[1:])]
        slopes = [s / (b[0] - a[0]) for s, a, b in zip(steps, line, line[1:])]
        if max(slopes) - min(slopes) < 1e-9:
            return "affine"
        if all(s > 0 for s in steps) or all(s < 0 for s in steps):
            return "monotone"
    return "recoded" if 2 * len(both) <= len(held) else None


def test_hidden_dependencies_against_plain_comparison(spark):
    hours = [None if i % 17 == 0 else (i * 37) % 5000 / 4 for i in range(5000)]
    held = [h or 0.0 for h in hours]
    columns = {
        "same": hours,
        "line": [-3 * h + 2 for h in held],
        "cubed": [h**3 for h in held],
        "falling": [1 / (1 + h) for h in held],
        # in order among the first probes, not in all rows
        "late": [h**2 if h != 611.25 else 1.5 for h in held],
        "rounded": [float(int(h)) for h in held],
        "gaps": [h if h != 100.5 else None for h in held],
        "code": [i % 3 for i in range(5000)],
        "turned": [(i + 2) % 3 for i in range(5000)],
        "word": ["xyz"[i % 3] for i in range(5000)],
    }
    gone = {"downtime_hours": hours, "notes": ["abc"[i % 3] for i in range(5000)], "review_flag": [None] * 5000}
    names = ", ".join(f"{c} {'string' if c == 'word' else 'int' if c in ('code', 'turned') else 'double'}" for c in columns)
    table = spark.createDataFrame(list(zip(range(5000), *columns.values())), "row_key long, " + names)
    kinds = {"downtime_hours": "double", "notes": "string", "review_flag": "string"}
    source = spark.createDataFrame(
        list(zip(range(5000), *gone.values())), "row_key long, " + ", ".join(f"{c} {t}" for c, t in kinds.items())
    )
    want = {
        (d, f, kind)
        for d, x in gone.items()
        for f, y in columns.items()
        if (kind := plain_kind(list(zip(x, y)), d == "downtime_hours" and f != "word"))
    }
    for parts in (1, 7):
        found = features.hidden_dependencies(table.repartition(parts), source, "row_key")
        assert {tuple(r) for r in found.collect()} == want
    assert {k for _, _, k in want} == {"equal", "affine", "monotone", "recoded"}
    assert features.hidden_dependencies(table.limit(0), source, "row_key").count() == 0
    assert features.hidden_dependencies(table.select("row_key"), source, "row_key").count() == 0


def test_transform_runs_on_a_stream(spark, tmp_path):
    df = refined(spark)
    params = features.fit(df)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (
        features.transform(stream, params).writeStream.format("memory").queryName("featured").start()
    )
    query.processAllAvailable()
    query.stop()
    assert spark.table("featured").count() == 50


def test_dependencies_group_by_one_column_at_a_time(spark, monkeypatch):
    """Several distinct counts in one aggregate would write a row for each pair of columns and row."""
    def refused(*columns):
        raise AssertionError("distinct counts of many columns in one aggregate")

    monkeypatch.setattr(features.F, "count_distinct", refused)
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 50).cast("int"))
    df = spark.range(400).select(F.col("id").alias("row_key"), (F.col("id") % 50).alias("n"), day.cast("string").alias("day"))
    source = df.select("row_key", F.when(F.col("row_key") % 3 > 0, F.col("day")).alias("disclosure_date"), F.lit(None).alias("review_flag"))
    table = df.select("row_key", "n", "day", F.lit(None).alias("none"), (F.col("n") * 0 + F.col("row_key") % 49).alias("other"))
    found = features.hidden_dependencies(table, source, "row_key", ("disclosure_date", "review_flag")).collect()
    assert {(r.dropped, r.feature, r.kind) for r in found} == {("disclosure_date", "n", "recoded"), ("disclosure_date", "day", "recoded")}
