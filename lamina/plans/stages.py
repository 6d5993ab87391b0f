"""The five stages from CSV files to model reports.

Stages talk through Parquet tables, so each can be run again on its own and
later passes read only the columns they use. The driver sees learned
parameters, metric rows and importances, never table rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import domain
from lamina.domain import FeatureSpec, RefineSpec
from lamina.operators import evaluate, explore, features, refine, trees
from lamina.operators.ordering import with_ordered_split, with_ordinal
from lamina.sources import ingest, layers


@dataclass(frozen=True)
class Folders:
    """Where the layers and reports of one run live."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def refined(self) -> str:
        return f"{self.root}/refined/dataset_ml.parquet"

    @property
    def features(self) -> str:
        return f"{self.root}/feature/dataset_ml_ready.parquet"

    @property
    def params(self) -> str:
        return f"{self.root}/feature/fit_params.parquet"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    @property
    def models(self) -> str:
        return f"{self.root}/models"


def raw_stage(spark: SparkSession, csv_files: Sequence[str], to: Folders) -> DataFrame:
    """Ingest every CSV; returns the inventory of the raw layer."""
    tables = ingest.ingest_all(spark, list(csv_files), to.raw)
    return ingest.layer_inventory({n: ingest.read_raw(spark, p) for n, p in tables.items()})


def refined_stage(spark: SparkSession, to: Folders, spec: RefineSpec | None = None) -> DataFrame:
    """Join and clean; returns the null profile of the written layer."""
    incidents = ingest.read_raw(spark, f"{to.raw}/incidents_master.parquet")
    financial = ingest.read_raw(spark, f"{to.raw}/financial_impact.parquet")
    layers.write_layer(refine.refine(incidents, financial, spec), to.refined)
    return refine.null_profile(layers.read_layer(spark, to.refined))


def explore_stage(spark: SparkSession, to: Folders) -> dict[str, DataFrame]:
    """The exploratory reports over the refined layer, by name."""
    df = layers.read_layer(spark, to.refined)
    target, revenue = domain.TARGET, "company_revenue_usd"
    return {
        "top_industries": explore.top_groups_by_count(df, "industry_primary"),
        "loss_by_vector": explore.top_groups_by_mean(df, "attack_vector_primary", target),
        "data_types": explore.top_groups_by_count(df, "data_type"),
        "loss_histogram": explore.histogram(df, target),
        "loss_summary": explore.measure_summary(df, target),
        "loss_outliers": explore.outlier_share(df, target),
        "correlations": explore.correlation_matrix(df, domain.CORRELATED),
        "industry_profile": explore.group_profile(df, "industry_primary", target, revenue),
        "top3_per_industry": explore.top_per_group(
            df, "industry_primary", target, domain.ROW_KEY, ["country_hq"] if "country_hq" in df.columns else []
        ),
        "best_per_industry": explore.best_per_group_tally(
            df, "industry_primary", target, domain.ROW_KEY, view="incidentes_com_rank"
        ),
    }


def feature_stage(
    spark: SparkSession, to: Folders, spec: FeatureSpec | None = None
) -> features.FitParams:
    """Split, fit on train, transform all; writes layer and parameters."""
    refined = layers.read_layer(spark, to.refined)
    table, params = features.build_features(refined, spec)
    layers.write_layer(table, to.features)
    layers.write_layer(features.params_table(spark, params).coalesce(1), to.params)
    return params


@dataclass(frozen=True)
class Scored:
    """One layer with both models' predictions, and the models."""

    rows: DataFrame
    trees: tuple[trees.FittedTree, ...]
    threshold: float | None


def score_layer(
    df: DataFrame,
    names: Sequence[str],
    specs: Sequence[trees.TreeSpec],
    key: str = domain.ROW_KEY,
    target: str = domain.TARGET,
) -> Scored:
    """Label by the median, train each model on train, predict every row."""
    threshold = evaluate.label_threshold(df, target)
    labelled = evaluate.with_label(df, threshold, target)
    rows = features.numeric_matrix(labelled, names, [key, "split", target, "label"])
    train = rows.filter(F.col("split") == "train")
    fitted = trees.fit_trees(train, names, specs)
    for tree in fitted:
        rows = trees.predict(rows, tree, tree.spec.name)
    return Scored(rows, fitted, threshold)


def model_metrics(scored: Scored) -> DataFrame:
    """Metrics per model and split, from one pass over the scored rows."""
    names = {t.spec.name: t.spec.name for t in scored.trees}
    return evaluate.evaluate_models(scored.rows, "label", names, ["split"])


def stored_scores(scored: Scored, path: str) -> Scored:
    """The same with its rows written, so that no report computes predictions again."""
    return replace(scored, rows=_stored(scored.rows, path))


def _stored(df: DataFrame, path: str) -> DataFrame:
    return layers.read_layer(df.sparkSession, layers.write_layer(df, path))


def model_stage(
    spark: SparkSession, to: Folders, repeats: int = 5
) -> dict[str, DataFrame]:
    """Two trees on the refined layer, one on the feature layer; all reports."""
    refined, feature_rows = layers.read_for_model(spark, to.refined, to.features)
    split = with_ordered_split(refined, domain.ROW_KEY)
    scored = score_layer(
        split, features.detect_features(split), (trees.GINI, trees.ENTROPY)
    )
    prepared = score_layer(
        feature_rows, features.detect_features(feature_rows), (trees.ENTROPY,)
    )
    scored = stored_scores(scored, f"{to.models}/scored_refined.parquet")
    prepared = stored_scores(prepared, f"{to.models}/scored_feature.parquet")
    gini, entropy = scored.trees
    # small tables used by several reports: computed once, then read
    metrics = _stored(model_metrics(scored), f"{to.reports}/metrics_by_split.parquet")
    test_metrics = metrics.filter(F.col("split") == "test")
    gap = evaluate.overfit_gap(metrics)
    test = _stored(
        with_ordinal(scored.rows.filter(F.col("split") == "test"), [F.asc(domain.ROW_KEY)], "id"),
        f"{to.models}/scored_test.parquet",
    )
    reports = {
        "metrics": evaluate.metrics_table(test_metrics),
        "overfit_gap": gap,
        "best_model": evaluate.best_model(test_metrics),
        "layer_verdict": evaluate.layer_verdict(
            test_metrics.filter(F.col("model") == entropy.spec.name),
            model_metrics(prepared).filter(F.col("split") == "test"),
        ),
        "comparacao_modelos": evaluate.side_by_side(
            test, domain.ROW_KEY, "label", gini.spec.name, entropy.spec.name
        ),
    }
    for tree in scored.trees:
        name = tree.spec.name
        importance = _stored(
            trees.permutation_importance(test, tree, domain.ROW_KEY, repeats=repeats),
            f"{to.reports}/permutation_{name}.parquet",
        )
        reports[f"previsoes_{name}"] = evaluate.prediction_table(
            test, domain.ROW_KEY, "label", name, scored.threshold
        )
        reports[f"impurity_importance_{name}"] = trees.impurity_importance(spark, tree)
        reports[f"permutation_importance_{name}"] = trees.sorted_importance(importance)
        reports[f"summary_{name}"] = trees.model_summary(scored.rows, tree, gap, importance)
        reports[f"rules_{name}"] = trees.leaf_rules(spark, tree)
        trees.save_model(spark, tree, f"{to.models}/{name}")
    for name, report in reports.items():
        if name.startswith("summary_"):
            layers.write_json(report, f"{to.reports}/{name}")
        else:
            layers.write_csv(report, f"{to.reports}/{name}")
    return reports


def run(spark: SparkSession, csv_files: Sequence[str], root: str) -> dict[str, DataFrame]:
    """All stages in order; the reports by name."""
    to = Folders(root)
    reports = {"raw_inventory": raw_stage(spark, csv_files, to)}
    reports["null_profile"] = refined_stage(spark, to)
    reports.update(explore_stage(spark, to))
    for name, report in reports.items():
        layers.write_csv(report, f"{to.reports}/{name}")
    params = feature_stage(spark, to)
    reports["catalogue"] = features.catalogue(spark, params)
    refined = with_ordered_split(layers.read_layer(spark, to.refined), domain.ROW_KEY)
    raw = ingest.read_raw(spark, f"{to.raw}/incidents_master.parquet")
    dropped = [n for n in raw.columns if n in domain.LEAKING_COLUMNS]
    gone = raw.select(F.col(domain.KEY).alias(domain.ROW_KEY), *[F.col(n) for n in dropped])
    reports["leakage_audit"] = features.leakage_audit(
        layers.read_layer(spark, to.features), source=refined.join(gone, domain.ROW_KEY), params=params
    )
    reports.update(model_stage(spark, to))
    return reports
