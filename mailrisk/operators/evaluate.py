"""Confusion counts, rates, ranking metrics, curves, samples and holdout rows.

Predictions are rows of ``model, row_key, label, predicted_label, score``, best a
written table: ranking metrics read them a few times.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailrisk.functions.risk import risk_level, risk_score
from mailrisk.session import write_stage

# Sample sizes and the named source-holdout experiments.
ERROR_SAMPLES = 10
PREDICTION_SAMPLES = 20
HOLDOUT_EXPERIMENTS = (
    ("ceas_enron_to_nazario", ("ceas", "enron"), ("nazario",)),
    ("ceas_to_enron", ("ceas",), ("enron",)),
    ("enron_to_ceas", ("enron",), ("ceas",)),
)
CELLS = ("true_negative", "false_positive", "false_negative", "true_positive")
METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")

# Distinct scores that one task sums up in order.
_RANGE_ROWS = 500_000


def _ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is 0 for an empty denominator."""
    return F.when(denominator == 0, 0.0).otherwise(numerator / denominator)


def confusion_counts(predictions: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Four cells per key, zero where a class or a prediction does not occur."""
    cells = {"true_negative": (0, 0), "false_positive": (0, 1), "false_negative": (1, 0), "true_positive": (1, 1)}
    return predictions.groupBy(*keys).agg(
        *(
            F.count_if((F.col("label") == truth) & (F.col("predicted_label") == guess)).alias(name)
            for name, (truth, guess) in cells.items()
        )
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Append accuracy, precision, recall and F1 to confusion counts."""
    tn, fp, fn, tp = (F.col(name) for name in CELLS)
    return counts.withColumns(
        {
            "accuracy": _ratio(tn + tp, tn + fp + fn + tp),
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def cumulative_counts(predictions: DataFrame) -> DataFrame:
    """Per model and distinct score: ``positives, negatives`` and, counted from
    the highest score down to it, ``tp, fp``.

    Equal scores are merged before anything is ordered. A running sum over all
    scores would need one task, so they are dealt into ranges, as many as their
    number asks for; each range is summed on its own and shifted by the totals
    of the ranges above it, one row each.
    """
    scored = predictions.where(F.col("score").isNotNull())
    counts = write_stage(
        scored.groupBy("model", "score").agg(
            F.count_if(F.col("label") == 1).alias("positives"),
            F.count_if(F.col("label") == 0).alias("negatives"),
        ),
        "score-counts",
    )
    ranges = max(1, math.ceil(counts.count() / _RANGE_ROWS))
    ranged = write_stage(
        counts.repartitionByRange(ranges, "model", F.desc("score")).withColumn("range", F.spark_partition_id()), "score-ranges"
    )
    above = Window.partitionBy("model").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy("model", "range")
        .agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
        .select(
            "model", "range",
            F.coalesce(F.sum("p").over(above), F.lit(0)).alias("p_above"),
            F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        )
    )
    inside = Window.partitionBy("model", "range").orderBy(F.desc("score"))
    return ranged.join(shifts, ["model", "range"]).select(
        "model", "score", "positives", "negatives",
        (F.sum("positives").over(inside) + F.col("p_above")).alias("tp"),
        (F.sum("negatives").over(inside) + F.col("n_above")).alias("fp"),
    )


def class_totals(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("model").agg(
        F.count_if(F.col("label") == 1).alias("all_positives"),
        F.count_if(F.col("label") == 0).alias("all_negatives"),
    )


def _cumulative_with_totals(predictions: DataFrame) -> DataFrame:
    totals = class_totals(predictions)  # one row per model
    return cumulative_counts(predictions).join(F.broadcast(totals), "model")


def ranking_metrics(predictions: DataFrame) -> DataFrame:
    """ROC-AUC with ties counted half, and average precision; null for one class."""
    p, n = F.col("all_positives"), F.col("all_negatives")
    below = n - F.col("fp") + F.col("negatives") / 2
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return (
        _cumulative_with_totals(predictions)
        .groupBy("model", "all_positives", "all_negatives")
        .agg(
            F.sum(F.col("positives") * below).alias("ordered_pairs"),
            F.sum(F.col("positives") * precision).alias("precision_steps"),
        )
        .select(
            "model",
            F.when((p > 0) & (n > 0), F.col("ordered_pairs") / p / n).alias("roc_auc"),
            F.when((p > 0) & (n > 0), F.col("precision_steps") / p).alias("pr_auc"),
        )
    )


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row of metrics per model."""
    counted = with_rates(confusion_counts(predictions))
    return counted.join(ranking_metrics(predictions), "model", "left").select("model", *METRICS, *CELLS)


def roc_points(predictions: DataFrame) -> DataFrame:
    """ROC curve per model: one point per distinct score and the origin."""
    points = _cumulative_with_totals(predictions).select(
        "model",
        F.col("score").alias("threshold"),
        _ratio(F.col("fp"), F.col("all_negatives")).alias("fpr"),
        _ratio(F.col("tp"), F.col("all_positives")).alias("tpr"),
    )
    origin = predictions.select("model").distinct().select(
        "model", F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(origin)


def pr_points(predictions: DataFrame) -> DataFrame:
    """Precision-recall curve per model, its end point and the class balance."""
    joined = _cumulative_with_totals(predictions)
    p, n = F.col("all_positives"), F.col("all_negatives")
    points = joined.select(
        "model",
        F.col("score").alias("threshold"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), p).alias("recall"),
        (p / (p + n)).alias("baseline"),
    )
    end = class_totals(predictions).select(
        "model", F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        (p / (p + n)).alias("baseline"),
    )
    return points.unionByName(end)


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the highest F1; ties go to the smaller name."""
    return metrics.orderBy(F.desc("f1"), "model").limit(1).select("model", "f1")


def error_samples(predictions: DataFrame, n: int = ERROR_SAMPLES) -> DataFrame:
    """The first ``n`` false positives and false negatives, by row key."""
    kind = F.when(F.col("label") == 0, "false_positive").otherwise("false_negative")
    first = Window.partitionBy("error_type").orderBy("row_key")
    return (
        predictions.where(F.col("label") != F.col("predicted_label"))
        .withColumn("error_type", kind)
        .withColumn("position", F.row_number().over(first))
        .where(F.col("position") <= n)
        .select(
            "row_key", "text_combined", F.col("label").alias("true_label"), "predicted_label",
            F.col("score").alias("phishing_probability"), "error_type",
        )
    )


def sample_predictions(predictions: DataFrame, n: int = PREDICTION_SAMPLES) -> DataFrame:
    """The first ``n`` predictions with score and level."""
    score = risk_score(F.col("score"))
    return predictions.orderBy("row_key").limit(n).select(
        "row_key", "text_combined", F.col("label").alias("true_label"), "predicted_label",
        F.col("score").alias("phishing_probability"),
        score.alias("risk_score"), risk_level(score).alias("risk_level"),
    )


def source_mask(keywords: Sequence[str], source: str = "source_file") -> Column:
    """True where the source contains any keyword, ignoring case."""
    name = F.lower(F.coalesce(F.col(source), F.lit("unknown")))
    mask = F.lit(False)
    for keyword in keywords:
        mask = mask | name.contains(keyword.lower())
    return mask


def holdout_counts(mails: DataFrame, experiments=HOLDOUT_EXPERIMENTS) -> DataFrame:
    """Row and class counts of every experiment, and whether it can run; one pass."""
    sides = []
    for i, (_, train, test) in enumerate(experiments):
        for side, keywords in (("train", train), ("test", test)):
            inside = source_mask(keywords)
            for label, name in ((0, "legitimate"), (1, "phishing")):
                sides.append(F.count_if(inside & (F.col("label") == label)).alias(f"{side}_{name}_{i}"))
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("experiment"),
                *(
                    F.col(f"{column}_{i}").alias(column)
                    for column in ("train_legitimate", "train_phishing", "test_legitimate", "test_phishing")
                ),
            )
            for i, (name, _, _) in enumerate(experiments)
        )
    )
    counted = mails.agg(*sides).select(F.inline(rows))
    train_rows = F.col("train_legitimate") + F.col("train_phishing")
    test_rows = F.col("test_legitimate") + F.col("test_phishing")
    empty = (train_rows == 0) | (test_rows == 0)
    too_few = F.least("train_legitimate", "train_phishing") < 2
    # Status and notes.
    return counted.select(
        "experiment",
        F.when(empty | too_few, "skipped").otherwise("ok").alias("status"),
        F.when(empty, "empty train or test split")
        .when(too_few, "training split does not contain at least two examples per class")
        .otherwise("")
        .alias("note"),
        train_rows.alias("train_rows"),
        test_rows.alias("test_rows"),
        "train_legitimate", "train_phishing", "test_legitimate", "test_phishing",
    )


def holdout_metrics(counts: DataFrame, predictions: DataFrame, model: str) -> DataFrame:
    """Complete holdout rows. ``predictions`` has the experiment name as ``model``.

    With one class in the test side only recall (phishing) or accuracy
    (legitimate) is defined; the other metrics are null.
    """
    measured = evaluate(predictions).withColumnRenamed("model", "experiment")
    both = (F.col("test_legitimate") > 0) & (F.col("test_phishing") > 0)
    phishing_only = (F.col("test_legitimate") == 0) & (F.col("test_phishing") > 0)
    ran = F.col("status") == "ok"
    note = (
        F.when(~ran, F.col("note"))
        .when(both, "two-class external test set")
        .when(phishing_only, "single-class phishing test set; reporting phishing recall")
        .otherwise("single-class legitimate test set; full binary metrics are not defined")
    )
    recall = F.when(both | phishing_only, F.col("recall"))
    return counts.join(measured, "experiment", "left").select(
        "experiment", F.lit(model).alias("model"), "status", note.alias("note"),
        "train_rows", "test_rows",
        "train_legitimate", "train_phishing", "test_legitimate", "test_phishing",
        "accuracy",
        F.when(both, F.col("precision")).alias("precision"),
        recall.alias("recall"),
        F.when(both, F.col("f1")).alias("f1"),
        F.when(both, F.col("roc_auc")).alias("roc_auc"),
        F.when(both, F.col("pr_auc")).alias("pr_auc"),
        recall.alias("phishing_recall"),
        *(F.coalesce(F.col(name), F.lit(0)).alias(name) for name in CELLS),
    )
