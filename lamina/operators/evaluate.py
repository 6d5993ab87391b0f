"""Labels, confusion counts, metrics and the comparison of models and layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina import domain
from lamina.functions.scalars import col, hit_word, impact_word, safe_ratio
from lamina.operators.ordering import with_ordinal
from lamina.operators.selection import quantiles

METRICS = ("acuracia", "precisao", "recall", "f1")
TOLERANCE = 0.001


def label_threshold(
    df: DataFrame, target: str = domain.TARGET, scope: str = "all", rule: str = "linear", **limits: int
) -> float | None:
    """Median of the target over all rows, or over the train rows only."""
    rows = df.filter(F.col("split") == "train") if scope == "train" else df
    return quantiles(rows, {target: [0.5]}, rule, **limits)[target][0.5]


def with_label(
    df: DataFrame, threshold: float | None, target: str = domain.TARGET, name: str = "label"
) -> DataFrame:
    """1 where the target is strictly above the threshold, else 0."""
    above = F.coalesce(col(target) > F.lit(threshold).cast("double"), F.lit(False))
    return df.withColumn(name, above.cast("int"))


def class_balance(df: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, col(label)).agg(F.count("*").alias("rows"))


def confusion_counts(
    df: DataFrame, real: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """tp, tn, fp, fn with 1 as the positive class, in one aggregate."""
    y, p = col(real) == 1, col(predicted) == 1
    counts = [
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
    ]
    return df.groupBy(*by).agg(*counts) if by else df.agg(*counts)


def with_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class; 0 if undefined."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return counts.withColumns(
        {
            "acuracia": safe_ratio(tp + tn, tp + tn + fp + fn),
            "precisao": safe_ratio(tp, tp + fp),
            "recall": safe_ratio(tp, tp + fn),
            "f1": safe_ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def evaluate(df: DataFrame, real: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    return with_metrics(confusion_counts(df, real, predicted, by))


def evaluate_models(
    df: DataFrame, real: str, predictions: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """One metrics row per model, from one pass over rows that hold all predictions."""
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("model"), col(p).cast("int").alias("predicted"))
                for m, p in predictions.items()
            ]
        )
    )
    rows = df.select(*[col(b) for b in by], col(real).alias("real"), cells.alias("cell"))
    flat = rows.select(*by, "real", "cell.model", "cell.predicted")
    return evaluate(flat, "real", "predicted", ["model", *by])


def metrics_table(metrics: DataFrame, digits: int = 4) -> DataFrame:
    """Model and its four rounded metrics."""
    return metrics.select("model", *[F.round(m, digits).alias(m) for m in METRICS])


def overfit_gap(metrics: DataFrame) -> DataFrame:
    """Train against test accuracy and F1 per model, from rows with ``split``."""
    def of(split: str, metric: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(metric)))

    return metrics.groupBy("model").agg(
        of("train", "acuracia").alias("acuracia_treino"),
        of("test", "acuracia").alias("acuracia_teste"),
        of("train", "f1").alias("f1_treino"),
        of("test", "f1").alias("f1_teste"),
        (of("train", "acuracia") - of("test", "acuracia")).alias("acuracia_gap"),
        (of("train", "f1") - of("test", "f1")).alias("f1_gap"),
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the highest F1; on a tie the later name wins."""
    best = F.max_by("model", F.struct("f1", "model"))
    return metrics.agg(best.alias("best_model"), F.max("f1").alias("f1"))


def _numbered(test: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    if "id" in test.columns and key != "id":
        return test
    return with_ordinal(test.select(col(key), *[col(n) for n in names]), [F.asc(key)], "id")


def prediction_table(
    test: DataFrame,
    key: str,
    real: str,
    predicted: str,
    threshold: float,
    target: str = domain.TARGET,
    digits: int = 2,
) -> DataFrame:
    """Predictions in words, numbered 0.. in key order, with the threshold.

    Rows that have an ``id`` are numbered already.
    """
    numbered = _numbered(test, key, [real, predicted, target])
    return numbered.select(
        "id",
        impact_word(col(real)).alias("real"),
        impact_word(col(predicted)).alias("previsto"),
        hit_word(col(real), col(predicted)).alias("acertou?"),
        F.round(col(target), digits).alias("total_loss_usd"),
        F.lit(threshold).cast("double").alias("threshold"),
    )


def side_by_side(
    test: DataFrame,
    key: str,
    real: str,
    first: str,
    second: str,
    target: str = domain.TARGET,
    words: bool = True,
    digits: int = 2,
) -> DataFrame:
    """Two models' predictions for the same rows; flags as words or as 0/1.

    Both predictions are columns of one frame already, so no join is needed.
    """
    numbered = _numbered(test, key, [real, first, second, target])

    def label(name: str) -> Column:
        return impact_word(col(name)) if words else col(name).cast("int")

    def hit(name: str) -> Column:
        if words:
            return hit_word(col(real), col(name))
        return (col(real) == col(name)).cast("int")

    return numbered.select(
        "id",
        label(real).alias("real"),
        label(first).alias("modelo1_gini"),
        label(second).alias("modelo2_entropy"),
        hit(first).alias("acertou_1?"),
        hit(second).alias("acertou_2?"),
        F.round(col(target), digits).alias("total_loss_usd"),
    )


def join_predictions(first: DataFrame, second: DataFrame) -> DataFrame:
    """Side-by-side table from two stored prediction tables, joined on id."""
    other = second.select(
        "id", F.col("previsto").alias("modelo2_entropy"), F.col("`acertou?`").alias("acertou_2?")
    )
    return first.join(other, "id").select(
        "id",
        "real",
        F.col("previsto").alias("modelo1_gini"),
        "modelo2_entropy",
        F.col("`acertou?`").alias("acertou_1?"),
        F.col("`acertou_2?`").alias("acertou_2?"),
        "total_loss_usd",
    )


def layer_verdict(
    refined_metrics: DataFrame,
    feature_metrics: DataFrame,
    metrics: Sequence[str] = ("f1", "acuracia"),
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Per metric: value on each layer and whether preparation improved it.

    Both inputs are one-row metric tables; their rows are put under each other
    and folded per metric.
    """
    def cells(df: DataFrame, layer: str) -> DataFrame:
        pairs = [
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
            for m in metrics
        ]
        return df.select(F.explode(F.array(*pairs)).alias("cell")).select(
            "cell.*", F.lit(layer).alias("layer")
        )

    both = cells(refined_metrics, "refined").unionByName(cells(feature_metrics, "feature"))
    wide = both.groupBy("metric").agg(
        F.max(F.when(F.col("layer") == "refined", F.col("value"))).alias("refined"),
        F.max(F.when(F.col("layer") == "feature", F.col("value"))).alias("feature"),
    )
    return wide.select(
        "*",
        (F.col("feature") - F.col("refined")).alias("delta"),
        verdict(F.col("feature") - F.col("refined"), tolerance).alias("improved"),
    )


def verdict(delta: Column, tolerance: float = TOLERANCE) -> Column:
    return (
        F.when(delta > tolerance, F.lit(domain.YES))
        .when(delta >= 0, F.lit(domain.EQUAL))
        .otherwise(F.lit(domain.NO))
    )
