"""Classifier metrics as DataFrames."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.operators.running import running_totals
from ontime.staging import owner

# Metrics of one evaluated model, in report order.
METRICS = ["auc", "accuracy", "precision", "recall", "f1"]


def score_counts(scored: DataFrame, label: str, score: Column, *by: str, rows: Column | None = None) -> DataFrame:
    """Rows per label, prediction and distinct score: all that the metrics below need.

    Equal scores are combined before anything is shuffled. ``rows`` tells how many rows each one stands for.
    """
    keys = [*by, F.col(label).alias("label"), F.col("prediction"), score.alias("score")]
    return scored.groupBy(*keys).agg((F.count(F.lit(1)) if rows is None else F.sum(rows)).alias("n"))


def exact_auc(counts: DataFrame, *by: str) -> DataFrame:
    """The area under the ROC curve of :func:`score_counts`, exactly: ``(*by, auc)``.

    It is the share of pairs of a late and an on-time row in which the late one has the higher score,
    ties counting half. Sums of on-time rows below each distinct score are running totals over all
    groups in one order, so neither a group nor a range of scores is one task's work. Without rows of
    both classes it is 0. Sums are whole numbers, so the result does not depend on the layout.
    """
    late = F.col("label") == 1
    zero = F.lit(0).cast("bigint")
    steps = counts.groupBy(*by, "score").agg(
        F.coalesce(F.sum(F.when(late, F.col("n"))), zero).alias("late"),
        F.coalesce(F.sum(F.when(~late, F.col("n"))), zero).alias("on_time"),
    )
    below = running_totals(steps, [F.asc(c) for c in (*by, "score")], {"before": F.col("on_time")})
    wide = "decimal(38,0)"
    # Twice the pairs won. Groups follow one another, so what came before a group is taken off again.
    summed = below.groupBy(*by).agg(
        F.sum(F.col("late").cast("decimal(19,0)") * (2 * F.col("before") + F.col("on_time")).cast("decimal(19,0)")).cast(wide).alias("won"),
        F.sum("late").cast("decimal(19,0)").alias("late"), F.sum("on_time").cast("decimal(19,0)").alias("on_time"),
        F.min("before").cast("decimal(19,0)").alias("base"),
    )
    pairs = (F.col("late") * F.col("on_time")).cast(wide)
    won = (F.col("won") - (2 * F.col("base") * F.col("late")).cast(wide)).cast("double") / 2
    return summed.select(*by, F.when(pairs == 0, F.lit(0.0)).otherwise(won / F.nullif(pairs, F.lit(0)).cast("double")).alias("auc"))


def area_under_roc(counts: DataFrame, bins: int = 0) -> float:
    """Area under the ROC curve of :func:`score_counts`: exact, or over at most ``bins`` thresholds."""
    if not bins:
        with owner(counts.sparkSession):
            return exact_auc(counts).first()["auc"]
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="score", weightCol="n", metricName="areaUnderROC", numBins=bins
    ).evaluate(counts)


def confusion(counts: DataFrame, *by: str) -> DataFrame:
    """The four cells of the confusion matrix of :func:`score_counts`, in one pass."""
    actual, predicted = F.col("label") == 1, F.col("prediction") == 1

    def cell(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)

    return counts.groupBy(*by).agg(
        cell(actual & predicted, "tp"),
        cell(~actual & predicted, "fp"),
        cell(~actual & ~predicted, "tn"),
        cell(actual & ~predicted, "fn"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / F.nullif(whole, F.lit(0)))


def confusion_metrics(cells: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 weighted by how often each class occurs."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    total = tp + fp + tn + fn

    def weighted(late: Column, on_time: Column) -> Column:
        return _ratio(late * (tp + fn) + on_time * (tn + fp), total)

    precision = _ratio(tp, tp + fp), _ratio(tn, tn + fn)
    recall = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    f1 = [_ratio(2 * p * r, p + r) for p, r in zip(precision, recall)]
    return cells.withColumns(
        {
            "accuracy": _ratio(tp + tn, total),
            "precision": weighted(*precision),
            "recall": weighted(*recall),
            "f1": weighted(*f1),
        }
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the highest AUC per target; of equals, the one listed first (``position``)."""
    rank = F.struct(F.col("auc"), -F.col("position"))
    return metrics.groupBy("target").agg(
        F.max_by("model", rank).alias("model"), F.max("auc").alias("auc")
    )


def metrics_long(metrics: DataFrame, names: list[str] = METRICS) -> DataFrame:
    """One row per target, model and metric."""
    return metrics.unpivot(["target", "model"], names, "metric", "value")
