"""Classifier evaluation from aggregated counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.binning import equal_width_bin, ladder
from .ranks import running_totals

CLASS_NAMES = ("No Default", "Default")


def _ratio(part: Column, whole: Column) -> Column:
    """0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )


def binary_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """accuracy, precision, recall and F1 of class 1, in one pass."""
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    return confusion_counts(df, label, prediction).select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return (
        df.groupBy(F.col(label).alias("actual"))
        .pivot(prediction, [0, 1])
        .count()
        .select(
            "actual",
            F.coalesce(F.col("0"), F.lit(0)).alias("predicted_0"),
            F.coalesce(F.col("1"), F.lit(0)).alias("predicted_1"),
        )
        .orderBy("actual")
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    negatives, positives, total = tn + fp, tp + fn, tp + fp + fn + tn
    by_class = {
        CLASS_NAMES[0]: (_ratio(tn, tn + fn), _ratio(tn, negatives), _ratio(2 * tn, 2 * tn + fn + fp), negatives),
        CLASS_NAMES[1]: (_ratio(tp, tp + fp), _ratio(tp, positives), _ratio(2 * tp, 2 * tp + fp + fn), positives),
    }

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1_score"), support.cast("bigint").alias("support"),
        )

    neg, pos = by_class.values()
    macro = [(neg[i] + pos[i]) / 2 for i in range(3)]
    weighted = [_ratio(neg[i] * negatives + pos[i] * positives, total) for i in range(3)]
    accuracy = _ratio(tp + tn, total)
    return confusion_counts(df, label, prediction).select(
        F.inline(
            F.array(
                row(CLASS_NAMES[0], *neg),
                row(CLASS_NAMES[1], *pos),
                row("accuracy", accuracy, accuracy, accuracy, total),
                row("macro avg", *macro, total),
                row("weighted avg", *weighted, total),
            )
        )
    )


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score: shuffles distinct scores, not rows."""
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )


def auc_roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Rank-sum AUC, ties counted half; NULL when a class is absent."""
    ranked = running_totals(_score_counts(df, label, score), [F.col("score")], ["neg"])
    wins = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(wins, pairs).alias("auc_roc"))


def roc_curve(df: DataFrame, label: str, score: str, origin: bool = True) -> DataFrame:
    """``fpr, tpr, threshold`` for every distinct score, from the highest down.

    ``origin`` adds the point (0, 0) at an infinite threshold.
    """
    ranked = running_totals(_score_counts(df, label, score), [F.desc("score")], ["pos", "neg"])
    points = ranked.select(
        F.try_divide(F.col("cum_neg").cast("double"), F.col("all_neg")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("all_pos")).alias("tpr"),
        F.col("score").cast("double").alias("threshold"),
    )
    if not origin:
        return points
    start = df.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return start.unionAll(points)


def calibrate_probability_bins(df: DataFrame, label: str, probability: str, n_bins: int = 10) -> DataFrame:
    """Observed default rate and count per equal-width probability bin, empty bins included."""
    low, high = df.agg(F.min(probability), F.max(probability)).first()
    low, high = F.lit(low).cast("double"), F.lit(high).cast("double")
    number = equal_width_bin(probability, low, high, n_bins)
    found = (
        df.select(number.alias("bin"), F.col(label).alias("label"))
        .where("bin IS NOT NULL")
        .groupBy("bin")
        .agg(F.avg("label").alias("actual_default_rate"), F.count("label").alias("count"))
    )
    spine = df.sparkSession.range(1, n_bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / float(n_bins)
    return (
        spine.join(found, "bin", "left")
        .select(
            "bin",
            (low + (F.col("bin") - 1) * width).alias("bin_low"),
            (low + F.col("bin") * width).alias("bin_high"),
            "actual_default_rate",
            F.coalesce("count", F.lit(0)).alias("count"),
        )
        .orderBy("bin")
    )


def risk_rating(probability: str = "default_probability") -> Column:
    """Rating of a default probability; NULL stays NULL."""
    _, comparison, steps, otherwise = V.LADDERS["risk_rating"]
    value = F.col(probability)
    return F.when(value.isNotNull(), ladder(value, comparison, steps, otherwise))
