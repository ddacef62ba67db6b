"""Metrics of scored rows: everything derives from four counts and score groups.

Input frames have ``true_label`` and ``predicted_label`` (0/1), usually
``churn_probability`` and a ``dataset`` column with a handful of values.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import clamp_score
from tidewatch.operators.ranked import running_totals
from tidewatch.session import stage
from tidewatch.settings import Settings


def class_weight(df: DataFrame, target: str) -> DataFrame:
    """Class counts and the weight of the positive class."""
    counts = df.agg(
        F.count_if(F.col(target) == 0).alias("n_negative"),
        F.count_if(F.col(target) == 1).alias("n_positive"),
    )
    return counts.withColumn("positive_weight", F.try_divide("n_negative", "n_positive"))


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Rows per class and their percentage."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "percent", F.col("n") * 100.0 / total
    )


def counts_of_outcomes(df: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """The four outcome counts per group, in one aggregate."""
    t, p = F.col("true_label"), F.col("predicted_label")
    return df.groupBy(*by).agg(
        F.count_if((t == 0) & (p == 0)).alias("tn"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 1) & (p == 1)).alias("tp"),
    )


def confusion_matrix(df: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """All four cells per group, zero cells included."""
    def cell(t: int, p: int, c: str) -> Column:
        return F.struct(F.lit(t).alias("true_label"), F.lit(p).alias("predicted_label"), F.col(c).alias("n"))

    cells = F.array(cell(0, 0, "tn"), cell(0, 1, "fp"), cell(1, 0, "fn"), cell(1, 1, "tp"))
    return counts_of_outcomes(df, by).select(*by, F.inline(cells))


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def _per_class(counts: DataFrame) -> DataFrame:
    """Outcome counts with precision, recall, f1 and support of both classes."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    out = counts.withColumns(
        {
            "p0": _ratio(tn, tn + fn), "r0": _ratio(tn, tn + fp),
            "p1": _ratio(tp, tp + fp), "r1": _ratio(tp, tp + fn),
            "n0": tn + fp, "n1": tp + fn, "n": tn + fp + fn + tp,
        }
    )
    return out.withColumns(
        {
            "f0": _f1(F.col("p0"), F.col("r0")),
            "f1": _f1(F.col("p1"), F.col("r1")),
            "accuracy": _ratio(tn + tp, F.col("n")),
        }
    )


def _weighted(a: str, b: str) -> Column:
    return _ratio(F.col(a) * F.col("n0") + F.col(b) * F.col("n1"), F.col("n"))


def weighted_metrics(df: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """Accuracy and support-weighted precision, recall and f1 per group."""
    return _per_class(counts_of_outcomes(df, by)).select(
        *by,
        "accuracy",
        _weighted("p0", "p1").alias("precision"),
        _weighted("r0", "r1").alias("recall"),
        _weighted("f0", "f1").alias("f1_score"),
    )


def class_report(df: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """Per class, accuracy, macro and weighted rows."""
    def row(name: str, p: Column, r: Column, f: Column, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"),
            f.alias("f1_score"), n.alias("support"),
        )

    c = F.col
    none = F.lit(None).cast("double")
    rows = F.array(
        row("0", c("p0"), c("r0"), c("f0"), c("n0")),
        row("1", c("p1"), c("r1"), c("f1"), c("n1")),
        row("accuracy", none, none, c("accuracy"), c("n")),
        row("macro avg", (c("p0") + c("p1")) / 2, (c("r0") + c("r1")) / 2, (c("f0") + c("f1")) / 2, c("n")),
        row("weighted avg", _weighted("p0", "p1"), _weighted("r0", "r1"), _weighted("f0", "f1"), c("n")),
    )
    return _per_class(counts_of_outcomes(df, by)).select(*by, F.inline(rows))


def _score_totals(df: DataFrame, by: Sequence[str], descending: bool) -> DataFrame:
    sums = {
        "pos": F.count_if(F.col("true_label") == 1),
        "neg": F.count_if(F.col("true_label") == 0),
    }
    return running_totals(df, by, "churn_probability", sums, descending=descending)


def roc_curve(df: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """True and false positive rate at every distinct score, plus the origin.

    The origin has a null threshold.
    """
    points = stage(
        _score_totals(df, by, descending=True).select(
            *by,
            F.col("churn_probability").alias("threshold"),
            F.try_divide(F.col("before_neg") + F.col("neg"), "all_neg").alias("fpr"),
            F.try_divide(F.col("before_pos") + F.col("pos"), "all_pos").alias("tpr"),
        ),
        "curve",
    )
    origin = points.select(*by).distinct().select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def roc_auc(df: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """Area under the ROC curve; equal scores share their average rank."""
    ranked = _score_totals(df, by, descending=False)
    # Pairs (positive, negative) with the positive ahead; ties count a half.
    wins = F.col("pos") * (F.col("before_neg") + F.col("neg") / 2)
    return ranked.groupBy(*by).agg(
        F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc")
    )


def metrics_long(df: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """One row per group and metric."""
    wide = weighted_metrics(df, by).join(roc_auc(df, by), list(by), "left")
    names = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]
    return wide.unpivot(list(by), names, "metric", "value")


def test_summary(df: DataFrame) -> DataFrame:
    """Headline metrics of the test rows, one row."""
    test = df.filter(F.col("dataset") == "test")
    return weighted_metrics(test).join(roc_auc(test), ["dataset"], "left").drop("dataset")


# -- errors -----------------------------------------------------------------------------

def prediction_summary_vs_truth(df: DataFrame, settings: Settings) -> DataFrame:
    """Label, prediction, clamped confidence and whether they agree."""
    return df.select(
        "dealer_code",
        "true_label",
        "predicted_label",
        clamp_score(F.col("churn_probability"), settings.confidence_floor).alias("confidence_score"),
        (F.col("true_label") == F.col("predicted_label")).alias("prediction_correct"),
    )


def prediction_errors(summary: DataFrame) -> DataFrame:
    """The rows that were predicted wrongly, with the kind of error."""
    return summary.filter(~F.col("prediction_correct")).withColumn(
        "error_kind",
        F.when(F.col("predicted_label") == 1, "false_positive").otherwise("false_negative"),
    )


def error_statistics(errors: DataFrame) -> DataFrame:
    """Counts of both error kinds and the spread of their confidence.

    Confidence has 5 decimals, hence at most 100,001 distinct values, which is
    what the exact percentile keeps.
    """
    c = F.col("confidence_score")
    return errors.agg(
        F.count(F.lit(1)).alias("n_errors"),
        F.count_if(F.col("predicted_label") == 1).alias("n_false_positive"),
        F.count_if(F.col("predicted_label") == 0).alias("n_false_negative"),
        F.avg(c).alias("mean_confidence"),
        F.stddev_samp(c).alias("std_confidence"),
        F.min(c).alias("min_confidence"),
        F.percentile(c, F.lit(0.25)).alias("q1_confidence"),
        F.percentile(c, F.lit(0.5)).alias("median_confidence"),
        F.percentile(c, F.lit(0.75)).alias("q3_confidence"),
        F.max(c).alias("max_confidence"),
    )
