"""Registered queries: each takes (spark, folder) and returns a DataFrame.

Floats are rounded and row numbers widened so that another engine can check
the values; the operators themselves do neither.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import domain
from lamina.functions import scalars
from lamina.functions.scalars import col
from lamina.operators import evaluate, explore, features, fit_state, ordering, refine, trees
from lamina.operators.selection import quantiles
from lamina.plans import stages, testbed
from lamina.session import cut_lineage, fresh_path
from lamina.sources import ingest, layers

Query = Callable[[SparkSession, str], DataFrame]
TARGET, KEY = domain.TARGET, domain.ROW_KEY
REVENUE = "company_revenue_usd"


def rounded(df: DataFrame, places: dict[str, int]) -> DataFrame:
    return df.withColumns({n: F.round(col(n), d) for n, d in places.items()})


def widened(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: col(n).cast("bigint") for n in names})


# -- raw layer ---------------------------------------------------------------


def _csv_copy(spark: SparkSession, folder: str, name: str) -> str:
    path = f"{fresh_path(spark, 'csv')}/{name}.csv"
    return layers.write_csv(testbed.table(spark, folder, name), path)


def raw_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Three CSV files to the raw layer; key, origin and count of every row."""
    names = ("customer", "supplier", "nation")
    raw = fresh_path(spark, "raw")
    paths = ingest.ingest_all(spark, [_csv_copy(spark, folder, n) for n in names], raw)
    origin, size, batch, loaded = domain.AUDIT_COLUMNS
    parts = None
    for name, path in paths.items():
        rows = ingest.read_raw(spark, path)
        part = rows.select(
            F.lit(name).alias("table_name"),
            col(rows.columns[0]).alias("first_column"),
            origin,
            size,
            (col(batch).isNotNull() & col(loaded).isNotNull()).alias("tagged"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def committed_layer(spark: SparkSession, folder: str) -> DataFrame:
    """A layer overwritten with what was read from it, twice; versions and counts come from its commits."""
    path = fresh_path(spark, "committed")
    layers.write_layer(testbed.refined(spark, folder), path, counted=True)
    first = layers.read_layer(spark, path)
    layers.write_layer(first.filter(col(REVENUE).isNotNull()), path, counted=True)
    second = layers.read_layer(spark, path)
    layers.write_layer(second.withColumn(REVENUE, col(REVENUE) * 2), path, counted=True)
    counts = {v.number: v.rows for v in layers.versions(spark, path)}
    last = layers.read_layer(spark, path)
    return last.select(
        "row_key", F.round(REVENUE, 4).alias("doubled"), F.lit(max(counts)).cast("long").alias("version"),
        F.lit(counts[max(counts)]).cast("long").alias("rows"), F.lit(len(counts)).cast("long").alias("versions_kept"),
    )


def raw_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every column of the orders through CSV text and the raw layer, typed again."""
    source = testbed.table(spark, folder, "orders")
    path = ingest.ingest(spark, _csv_copy(spark, folder, "orders"), fresh_path(spark, "raw"))
    rows = ingest.read_raw(spark, path)
    return rows.select(*[col(n).cast(kind).alias(n) for n, kind in source.dtypes], domain.AUDIT_COLUMNS[1])


# Limits that make the search for ranks narrow its spans even on small tables.
NARROW = {"gathered": 400, "buckets": 64}


def quartiles_narrowed(spark: SparkSession, folder: str) -> DataFrame:
    events = testbed.table(spark, folder, "events")
    at = quantiles(events, {"value": [0.25, 0.5, 0.75]}, **NARROW)["value"]
    row = [(at[0.25], at[0.5], at[0.75])]
    return rounded(spark.createDataFrame(row, "q1 double, q2 double, q3 double"), {"q1": 6, "q2": 6, "q3": 6})


def split_narrowed(spark: SparkSession, folder: str) -> DataFrame:
    rows = ordering.with_ordered_split(testbed.refined(spark, folder), KEY, **NARROW)
    return rows.select(KEY, "split")


def typed_csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The customer table through CSV with inferred types."""
    path = ingest.ingest(
        spark, _csv_copy(spark, folder, "customer"), fresh_path(spark, "raw"), infer=True
    )
    df = ingest.read_raw(spark, path)
    kinds = dict(df.dtypes)
    return df.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
        "c_acctbal",
        "c_mktsegment",
        F.lit(kinds["c_acctbal"]).alias("balance_type"),
        F.lit(kinds["c_name"]).alias("name_type"),
    )


def layer_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.layer_inventory({n: testbed.table(spark, folder, n) for n in testbed.TABLES})


# -- refined layer -----------------------------------------------------------


def refined_join(spark: SparkSession, folder: str) -> DataFrame:
    return testbed.refined_rows(spark, folder)


def full_join_count(spark: SparkSession, folder: str) -> DataFrame:
    left = ingest.with_audit(testbed.incidents(spark, folder), "incidents_master.csv", 0)
    right = ingest.with_audit(testbed.financial(spark, folder), "financial_impact.csv", 0)
    return refine.inner_join_all(left, right).agg(F.count("*").alias("rows"))


def join_coverage(spark: SparkSession, folder: str) -> DataFrame:
    tables = (testbed.incidents, testbed.financial, testbed.market)
    result = refine.join_coverage(*[t(spark, folder) for t in tables])
    return rounded(result, {"market_coverage": 8})


def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    profile = refine.null_profile(testbed.refined(spark, folder), only_with_nulls=False)
    return rounded(profile, {"null_percent": 6})


def null_profile_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Before the fills; only columns that have NULLs."""
    return rounded(refine.null_profile(testbed.incidents(spark, folder)), {"null_percent": 6})


def rejected_values(spark: SparkSession, folder: str) -> DataFrame:
    names = [n for n in domain.TYPED_COLUMNS if n != TARGET]
    left = refine.rejected_values(testbed.incidents(spark, folder), names)
    right = refine.rejected_values(testbed.financial(spark, folder), [TARGET])
    return left.unionByName(right)


# -- exploration -------------------------------------------------------------


def group_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = explore.group_counts(testbed.incidents(spark, folder), "data_type")
    return rounded(counts, {"percent": 6})


def top_groups_by_count(spark: SparkSession, folder: str) -> DataFrame:
    top = explore.top_groups_by_count(testbed.refined(spark, folder), "country_hq", 10)
    return rounded(top, {"percent": 6})


def top_groups_by_mean(spark: SparkSession, folder: str) -> DataFrame:
    top = explore.top_groups_by_mean(testbed.refined(spark, folder), "country_hq", TARGET, 10)
    return rounded(top, {"mean": 4})


def group_profile(spark: SparkSession, folder: str) -> DataFrame:
    profile = explore.group_profile(
        testbed.refined(spark, folder), "industry_primary", TARGET, REVENUE
    )
    return rounded(profile, {"perda_media": 4, "receita_media": 4})


def group_total(spark: SparkSession, folder: str) -> DataFrame:
    return explore.group_total(testbed.refined(spark, folder), "industry_primary")


def top3_per_group(spark: SparkSession, folder: str) -> DataFrame:
    top = explore.top_per_group(
        testbed.refined(spark, folder), "industry_primary", TARGET, KEY, ["country_hq"]
    )
    return widened(top, "rank_in_industry")


def best_per_group_tally(spark: SparkSession, folder: str) -> DataFrame:
    return explore.best_per_group_tally(
        testbed.refined(spark, folder), "industry_primary", TARGET, KEY
    )


def sql_over_view(spark: SparkSession, folder: str) -> DataFrame:
    """Every ranked row as a view, and SQL on it."""
    ranked = explore.ranked_rows(testbed.refined(spark, folder), "industry_primary", TARGET, KEY)
    layers.register_view(ranked, "incidentes_com_rank")
    return spark.sql(
        """
        SELECT industry_primary,
               COUNT(*) AS listed,
               COUNT_IF(is_public_company) AS listed_public,
               COUNT_IF(rank_in_industry = 1) AS leaders,
               MAX(rank_in_industry) AS last_rank
        FROM incidentes_com_rank
        GROUP BY industry_primary
        ORDER BY listed DESC, industry_primary
        LIMIT 10
        """
    )


def rank_all_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = testbed.table(spark, folder, "events").select("event_id", "event_type", "value")
    order = [F.desc("value"), F.asc("event_id")]
    return ordering.rank_within_group(events, "event_type", order, "rank", window_rows=5_000_000)


def rank_all_rows_ranged(spark: SparkSession, folder: str) -> DataFrame:
    """The same ranks by the way taken for groups too large for one task."""
    events = testbed.table(spark, folder, "events").select("event_id", "event_type", "value")
    order = [F.desc("value"), F.asc("event_id")]
    return ordering.rank_within_group(events, "event_type", order, "rank")


def measure_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = explore.measure_summary(testbed.table(spark, folder, "events"), "value")
    return rounded(
        summary,
        {n: 6 for n in ("mean", "std_pop", "std_samp", "q1", "median", "q3", "upper_fence")},
    )


def loss_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = explore.measure_summary(testbed.refined(spark, folder), TARGET)
    places = {n: 4 for n in ("mean", "std_pop", "std_samp")}
    return rounded(summary, places | {n: 8 for n in ("q1", "median", "q3", "upper_fence")})


def index_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles by the element rule instead of interpolation."""
    df = testbed.table(spark, folder, "events")
    at = quantiles(df, {"value": [0.25, 0.5, 0.75]}, rule="index")["value"]
    return df.agg(
        F.count("value").alias("count"),
        *[F.lit(at[p]).cast("double").alias(n) for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))],
    )


def iqr_outliers(spark: SparkSession, folder: str) -> DataFrame:
    events = testbed.table(spark, folder, "events").select("event_id", "value")
    return rounded(explore.flag_outliers(events, "value"), {"upper_fence": 6})


def outlier_share(spark: SparkSession, folder: str) -> DataFrame:
    share = explore.outlier_share(testbed.refined(spark, folder), TARGET)
    return rounded(share, {"upper_fence": 8, "outlier_percent": 6})


def histogram25(spark: SparkSession, folder: str) -> DataFrame:
    bins = explore.histogram(testbed.refined(spark, folder), TARGET, 25)
    return rounded(bins, {"bin_low": 6, "bin_high": 6})


def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    matrix = explore.correlation_matrix(testbed.refined(spark, folder), domain.CORRELATED)
    return rounded(matrix, {"r": 6})


def correlation_zero_filled(spark: SparkSession, folder: str) -> DataFrame:
    matrix = explore.correlation_matrix(
        testbed.refined(spark, folder), domain.CORRELATED, nulls="zero"
    )
    return rounded(matrix, {"r": 6})


# -- order -------------------------------------------------------------------


def dense_row_id(spark: SparkSession, folder: str) -> DataFrame:
    orders = testbed.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ordering.with_ordinal(orders, [F.asc("o_orderkey")], "row_id")


def ordered_by_value(spark: SparkSession, folder: str) -> DataFrame:
    return explore.ordered_by_value(testbed.refined(spark, folder), TARGET, KEY)


def ordered_split(spark: SparkSession, folder: str) -> DataFrame:
    return testbed.split_rows(spark, folder).select(KEY, "split")


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    orders = testbed.table(spark, folder, "orders").select("o_orderkey")
    return ordering.with_hash_split(orders, "o_orderkey")


def seeded_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the events without replacement, the same half every time."""
    events = testbed.table(spark, folder, "events").select("event_id", "value")
    return ordering.seeded_sample(events, "event_id", events.count() // 2)


# -- features ----------------------------------------------------------------


def category_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    params = testbed.fitted(spark, folder)
    table = features.params_table(spark, params).filter("kind = 'category'")
    return table.select("column_name", F.col("position").cast("bigint").alias("position"), "word")


def wide_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """The index table of a nominal column of any width: the customer's name among train rows."""
    return features.word_index(_named_rows(spark, folder).filter("split = 'train'"), "company_name")


def wide_transform(spark: SparkSession, folder: str) -> DataFrame:
    """Rows coded by stored parameters that hold an index table."""
    rows = _named_rows(spark, folder)
    spec = domain.FeatureSpec(nominal=(), indexed=("company_name",))
    fitted = features.fit(rows.filter("split = 'train'"), spec)
    path = layers.write_layer(features.params_table(spark, fitted), fresh_path(spark, "params"))
    params = features.read_params(layers.read_layer(spark, path))
    return features.transform(rows, params, spec).select(KEY, "company_name_code")


def _named_rows(spark: SparkSession, folder: str) -> DataFrame:
    names = testbed.incidents(spark, folder).select(F.col("incident_id").alias(KEY), "company_name")
    return testbed.split_rows(spark, folder).select(KEY, "split").join(names, KEY)


def fit_params(spark: SparkSession, folder: str) -> DataFrame:
    table = features.params_table(spark, testbed.fitted(spark, folder))
    numbers = table.filter("kind <> 'category'")
    return rounded(numbers.select("kind", "column_name", "number"), {"number": 4})


def _merged_state(spark: SparkSession, folder: str) -> DataFrame:
    """The state of train rows that arrive in three batches; each is read once."""
    train = testbed.split_rows(spark, folder).filter(F.col("split") == "train")
    batch = F.pmod(F.xxhash64(KEY), F.lit(3))
    first, second, third = (fit_state.state_for(train.filter(batch == i)) for i in range(3))
    return cut_lineage(fit_state.merge_states(fit_state.merge_states(first, second), third))


def merged_fit(spark: SparkSession, folder: str) -> DataFrame:
    """The learned numbers from merged states."""
    params = fit_state.params_of(_merged_state(spark, folder))
    numbers = features.params_table(spark, params).filter("kind <> 'category'")
    return rounded(numbers.select("kind", "column_name", "number"), {"number": 4})


def merged_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """Every category with its train rows, from merged states."""
    return fit_state.vocabulary_counts(_merged_state(spark, folder))


def transformation_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    result = features.catalogue(spark, testbed.fitted(spark, folder))
    return rounded(result.select("transformation", "column_name", "learned"), {"learned": 4})


def feature_layer(spark: SparkSession, folder: str) -> DataFrame:
    table, _ = features.build_features(testbed.refined(spark, folder))
    return _checkable_features(table)


def stacked_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The feature layer from train and test rows held apart."""
    spec = domain.FeatureSpec()
    rows = testbed.split_rows(spark, folder).select(KEY, *spec.kept, "split")
    train, test = (rows.filter(F.col("split") == part) for part in ("train", "test"))
    return _checkable_features(features.stack_parts(train, test, features.fit(train)))


def _checkable_features(table: DataFrame) -> DataFrame:
    whole = [n for n, t in table.dtypes if t == "int"]
    places = {n: 6 for n in table.columns if n.endswith("_scaled")} | {REVENUE: 4, TARGET: 6}
    return rounded(widened(table, *whole), places)


def clip_one_sided(spark: SparkSession, folder: str) -> DataFrame:
    df, params = testbed.refined(spark, folder), testbed.fitted(spark, folder)
    capped = scalars.clip_above(col(TARGET), params.fence)
    return df.select(KEY, F.round(capped, 6).alias("capped"))


def clip_two_sided(spark: SparkSession, folder: str) -> DataFrame:
    df, params = testbed.refined(spark, folder), testbed.fitted(spark, folder)
    clipped = scalars.clip_between(col(REVENUE), params.z_low, params.z_high)
    return df.select(KEY, F.round(clipped, 4).alias("clipped"))


def clip_effect(spark: SparkSession, folder: str) -> DataFrame:
    df, params = testbed.refined(spark, folder), testbed.fitted(spark, folder)
    return rounded(features.clip_effect(df, params), {"changed_percent": 6})


def feature_detection(spark: SparkSession, folder: str) -> DataFrame:
    df = ingest.with_audit(testbed.incidents(spark, folder), "incidents_master.csv", 0)
    df = refine.drop_existing(df, (*domain.AUDIT_COLUMNS, "company_name"))
    return rounded(
        features.feature_report(df, technical=("incident_id",)), {"numeric_share": 6}
    )


def alpha_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = testbed.split_rows(spark, folder)
    train = rows.filter(F.col("split") == "train")
    names = ["industry_primary", "attack_vector_primary", "country_hq"]
    coded = features.alphabetical_codes(rows, train, names, KEY)
    return coded.select(KEY, *names)


def wide_index(spark: SparkSession, folder: str) -> DataFrame:
    """Index of a text column with very many values: the customer name."""
    orders, customers = (testbed.table(spark, folder, n) for n in ("orders", "customer"))
    named = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name"
    )
    return features.encode_wide(
        named, customers.select("c_name"), "c_name", "o_orderkey", "name_code"
    )


def leakage_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The audit by schema and by rows; the columns that refining drops are joined back by key."""
    table = testbed.feature_layer(spark, folder)
    dropped = testbed.incidents(spark, folder).select(F.col("incident_id").alias(KEY), "company_name", "review_flag")
    source = testbed.split_rows(spark, folder).join(dropped, KEY)
    return features.leakage_audit(table, source=source, params=testbed.fitted(spark, folder))


def leakage_found(spark: SparkSession, folder: str) -> DataFrame:
    """The same audit of a layer with planted leaks: parameters of all rows, a hidden column, mixed keys."""
    table = testbed.feature_layer(spark, folder)
    dropped = testbed.incidents(spark, folder).select(F.col("incident_id").alias(KEY), "company_name", "review_flag")
    source = testbed.split_rows(spark, folder).join(dropped, KEY)
    planted = table.join(dropped.select(KEY, F.col("review_flag").alias("status")), KEY)
    planted = planted.withColumn("split", F.when(F.col(KEY) % 5 == 0, "test").otherwise("train"))
    found = features.leakage_audit(planted, source=source, params=features.fit(source))
    return found.filter(~F.col("passed")).select(
        "rule", F.when(F.col("rule") == "no_dropped_column_under_another_name", F.col("offending")).alias("column_pair")
    )


def hidden_dependencies(spark: SparkSession, folder: str) -> DataFrame:
    """Columns that refining drops, and the features that say the same: as it is, on a line, in order, recoded."""
    orders = testbed.table(spark, folder, "orders").withColumnRenamed("o_orderkey", KEY)
    price, day = F.col("o_totalprice"), F.col("o_orderdate")
    gone = orders.select(
        KEY, price.alias("downtime_hours"), day.cast("string").alias("disclosure_date"), F.col("o_orderstatus").alias("review_flag")
    )
    status = F.when(F.col("o_orderstatus") == "O", 7).when(F.col("o_orderstatus") == "F", 3).otherwise(5)
    planted = orders.select(
        KEY, ((price - 100000) / 50000).alias("hours_scaled"), F.pow(price / 1000, 3).alias("hours_cubed"),
        (-F.sqrt(price)).alias("hours_falling"), F.datediff(day, F.lit("1992-01-01")).alias("day_number"),
        F.col("o_orderstatus").alias("state"), status.alias("state_code"), F.floor(price / 10).alias("hours_rounded"),
    )
    table = testbed.refined(spark, folder).withColumnRenamed("row_key", KEY)
    source = table.select(KEY).join(gone, KEY)
    named = table.select(KEY, REVENUE, "employee_count", "is_public_company", "industry_primary", "data_type", "quality_score")
    return features.hidden_dependencies(named.join(planted, KEY), source, KEY)


def feature_matrix(spark: SparkSession, folder: str) -> DataFrame:
    df = testbed.refined(spark, folder)
    names = [REVENUE, "employee_count", "is_public_company", "confidence_tier", "quality_score"]
    return features.numeric_matrix(df, names, [KEY])


def scalar_suite(spark: SparkSession, folder: str) -> DataFrame:
    """One column per scalar function over the raw incidents."""
    df = testbed.incidents(spark, folder)
    revenue = scalars.number_of(df, REVENUE)
    return df.select(
        "incident_id",
        F.lit("constant").alias("literal"),
        F.round(revenue, 4).alias("as_double"),
        scalars.is_rejected(col(REVENUE)).alias("rejected"),
        F.coalesce(revenue, F.lit(-1.0)).alias("filled"),
        scalars.ordinal_code(scalars.number_of(df, "confidence_tier")).cast("bigint").alias("tier"),
        scalars.ordinal_code(revenue).cast("bigint").alias("revenue_code"),
        scalars.dummy(col("industry_primary"), "BUILDING").cast("bigint").alias("is_building"),
        F.round(scalars.standardised(revenue, 4500.0, 3200.0), 10).alias("scaled"),
        F.round(scalars.clip_above(revenue, 8000.0), 4).alias("capped"),
        F.round(scalars.clip_between(revenue, 500.0, 8000.0), 4).alias("clipped"),
        F.round(F.sqrt(F.pow(revenue, 2)), 4).alias("magnitude"),
        F.round(scalars.safe_ratio(revenue, revenue - revenue), 6).alias("undefined_ratio"),
        scalars.finite_or_zero(revenue).alias("finite"),
        scalars.impact_word(F.when(revenue > 5000, 1).otherwise(0)).alias("word"),
        scalars.hit_word(col("data_type"), col("review_flag")).alias("hit"),
    )


# -- models ------------------------------------------------------------------


def _shallow(spark: SparkSession, folder: str, layer: str = "refined") -> stages.Scored:
    """Labelled rows with the predictions of two trees of depth two, which SQL can grow as well."""
    return testbed.scored(spark, folder, testbed.SHALLOW, layer)


def shallow_scored(spark: SparkSession, folder: str) -> tuple[DataFrame, float | None]:
    scored = _shallow(spark, folder)
    return scored.rows, scored.threshold


GINI, ENTROPY = (spec.name for spec in testbed.SHALLOW)
RULES = {GINI: GINI, ENTROPY: ENTROPY}
ROUND_METRICS = {m: 6 for m in evaluate.METRICS}


def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = shallow_scored(spark, folder)
    return widened(evaluate.class_balance(rows, by=["split"]), "label")


def confusion_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = shallow_scored(spark, folder)
    return rounded(evaluate.evaluate_models(rows, "label", RULES, ["split"]), ROUND_METRICS)


def _test_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = shallow_scored(spark, folder)
    return evaluate.evaluate_models(rows.filter(F.col("split") == "test"), "label", RULES)


def metrics_table(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.metrics_table(_test_metrics(spark, folder))


def overfit_gap(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = shallow_scored(spark, folder)
    gap = evaluate.overfit_gap(evaluate.evaluate_models(rows, "label", RULES, ["split"]))
    return rounded(gap, {n: 6 for n in gap.columns if n != "model"})


def best_model(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.best_model(_test_metrics(spark, folder)), {"f1": 6})


def prediction_table(spark: SparkSession, folder: str) -> DataFrame:
    rows, threshold = shallow_scored(spark, folder)
    test = rows.filter(F.col("split") == "test")
    table = evaluate.prediction_table(test, KEY, "label", GINI, threshold, digits=4)
    return rounded(table, {"threshold": 8})


def model_compare(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = shallow_scored(spark, folder)
    test = rows.filter(F.col("split") == "test")
    return evaluate.side_by_side(test, KEY, "label", GINI, ENTROPY, digits=4)


def model_compare_flags(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = shallow_scored(spark, folder)
    test = rows.filter(F.col("split") == "test")
    table = evaluate.side_by_side(test, KEY, "label", GINI, ENTROPY, words=False, digits=4)
    return widened(
        table, "real", "modelo1_gini", "modelo2_entropy", "acertou_1?", "acertou_2?"
    )


def layer_verdict(spark: SparkSession, folder: str) -> DataFrame:
    """The shallow entropy tree on refined and on feature rows, judged per metric."""
    before, after = (
        evaluate.evaluate(_shallow(spark, folder, layer).rows.filter(F.col("split") == "test"), "label", ENTROPY)
        for layer in ("refined", "feature")
    )
    result = evaluate.layer_verdict(before, after, evaluate.METRICS)
    return rounded(result, {"refined": 6, "feature": 6, "delta": 6})


def shallow_splits(spark: SparkSession, folder: str) -> DataFrame:
    """The inner nodes of both shallow trees."""
    scored = _shallow(spark, folder)
    parts = [trees.tree_nodes(spark, tree).withColumn("model", F.lit(tree.spec.name)) for tree in scored.trees]
    inner = parts[0].union(parts[1]).filter("feature is not null")
    return rounded(inner.select("model", "depth", "feature", "threshold", "gain"), {"threshold": 6, "gain": 6})


def _trees(spark: SparkSession, folder: str, specs: Sequence[trees.TreeSpec]) -> stages.Scored:
    """The two compared models are trained together, once; a query takes what it asks for."""
    scored = testbed.scored(spark, folder, (trees.GINI, trees.ENTROPY))
    return replace(scored, trees=tuple(t for t in scored.trees if t.spec in specs))


def tree_gini5(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stages.model_metrics(_trees(spark, folder, [trees.GINI])), ROUND_METRICS)


def tree_entropy10(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(stages.model_metrics(_trees(spark, folder, [trees.ENTROPY])), ROUND_METRICS)


def impurity_importance(spark: SparkSession, folder: str) -> DataFrame:
    scored = _trees(spark, folder, [trees.GINI])
    return rounded(trees.impurity_importance(spark, scored.trees[0]), {"importance": 8})


def permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    scored = _trees(spark, folder, [trees.GINI])
    test = scored.rows.filter(F.col("split") == "test")
    return rounded(trees.permutation_importance(test, scored.trees[0], KEY), {"importance": 8})


def tree_dump(spark: SparkSession, folder: str) -> DataFrame:
    nodes = trees.tree_nodes(spark, _trees(spark, folder, [trees.GINI]).trees[0])
    return widened(rounded(nodes, {"threshold": 6, "impurity": 8, "gain": 8}), "prediction")


def tree_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = trees.leaf_rules(spark, _trees(spark, folder, [trees.GINI]).trees[0])
    return widened(rounded(rules, {"above": 6, "up_to": 6}), "prediction")


def model_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary record; of its importances, read back from the record, the leading one."""
    scored = _trees(spark, folder, [trees.GINI])
    gap = evaluate.overfit_gap(stages.model_metrics(scored))
    importances = trees.impurity_importance(spark, scored.trees[0])
    summary = trees.model_summary(scored.rows, scored.trees[0], gap, importances)
    listed = F.from_json("feature_importances", "array<struct<importance:double, feature:string>>")
    first = F.array_min(F.transform(listed, lambda x: F.struct((-x["importance"]).alias("importance"), x["feature"].alias("feature"))))
    table = summary.withColumn("first", first).select(
        "modelo", "model", "criterion", "max_depth", F.array_join("features", ",").alias("features"),
        F.col("first.feature").alias("leading_feature"), F.round(-F.col("first.importance"), 8).alias("leading_importance"),
        "acuracia_treino", "f1_treino", "acuracia_teste", "f1_teste", "n_treino", "n_teste",
    )
    return widened(table, "max_depth")


def layer_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """The deeper tree on refined and on feature rows, judged per metric."""
    after = testbed.scored(spark, folder, (trees.ENTROPY,), "feature")
    before = _trees(spark, folder, [trees.ENTROPY])
    metrics = [stages.model_metrics(s).filter(F.col("split") == "test") for s in (before, after)]
    return rounded(evaluate.layer_verdict(*metrics), {"refined": 6, "feature": 6, "delta": 6})


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        raw_audit,
        typed_csv_ingest,
        layer_inventory,
        refined_join,
        full_join_count,
        join_coverage,
        null_profile,
        null_profile_raw,
        rejected_values,
        group_counts,
        top_groups_by_count,
        top_groups_by_mean,
        group_profile,
        group_total,
        top3_per_group,
        best_per_group_tally,
        sql_over_view,
        rank_all_rows,
        rank_all_rows_ranged,
        measure_summary,
        loss_summary,
        index_quartiles,
        iqr_outliers,
        outlier_share,
        histogram25,
        correlation_matrix,
        correlation_zero_filled,
        dense_row_id,
        ordered_by_value,
        ordered_split,
        hash_split,
        seeded_sample,
        category_vocabulary,
        wide_vocabulary,
        wide_transform,
        raw_round_trip,
        committed_layer,
        quartiles_narrowed,
        split_narrowed,
        fit_params,
        merged_fit,
        merged_vocabulary,
        transformation_catalogue,
        feature_layer,
        stacked_parts,
        clip_one_sided,
        clip_two_sided,
        clip_effect,
        feature_detection,
        alpha_index,
        wide_index,
        leakage_audit,
        leakage_found,
        hidden_dependencies,
        feature_matrix,
        scalar_suite,
        class_balance,
        confusion_metrics,
        metrics_table,
        overfit_gap,
        best_model,
        prediction_table,
        model_compare,
        model_compare_flags,
        layer_verdict,
        shallow_splits,
        tree_gini5,
        tree_entropy10,
        impurity_importance,
        permutation_importance,
        tree_dump,
        tree_rules,
        model_summary,
        layer_comparison,
    )
}
