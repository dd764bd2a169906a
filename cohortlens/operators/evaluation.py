"""ROC curve, AUC and confusion counts over a scored table.

Scores are grouped first (one row per distinct score with its positive and
negative counts), then cumulative counts in descending score order come
from ``running_totals`` — range partitions plus per-partition offsets, so
no window ever holds all scores on one task.

AUC is the Mann-Whitney statistic with ties counted one half (Hanley &
McNeil 1982), which equals the trapezoid area under the ROC points
(Fawcett 2006). With one class only it is null. Rows without a label or a
score are left out everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.ordering import running_totals


def _grouped(scored: DataFrame, score_col: str, label_col: str) -> DataFrame:
    positive = (F.col(label_col) == 1)
    return (scored.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
            .groupBy(F.col(score_col).alias("score"))
            .agg(F.sum(F.when(positive, 1).otherwise(0)).cast("long").alias("p"),
                 F.sum(F.when(positive, 0).otherwise(1)).cast("long").alias("n")))


def _cumulative(scored: DataFrame, score_col: str, label_col: str,
                num_partitions: int | None) -> DataFrame:
    g = _grouped(scored, score_col, label_col)
    return running_totals(g, F.col("score").desc(), ["p", "n"], "cum_", num_partitions,
                          totals_prefix="all_")


def roc_points(scored: DataFrame, score_col: str = "prob", label_col: str = "y",
               num_partitions: int | None = None) -> DataFrame:
    """(threshold, tp, fp, tpr, fpr): one point per distinct score, counting
    every sample with score >= threshold as positive, plus the start point
    (threshold null, 0, 0). Collinear points are kept."""
    cum = _cumulative(scored, score_col, label_col, num_partitions)
    points = cum.select(F.col("score").cast("double").alias("threshold"),
                        F.col("cum_p").alias("tp"), F.col("cum_n").alias("fp"),
                        F.col("all_p").alias("P"), F.col("all_n").alias("N"))
    start = cum.agg(F.lit(None).cast("double").alias("threshold"),
                    F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"),
                    F.max("all_p").alias("P"), F.max("all_n").alias("N"))
    body = points.unionByName(start)
    return body.select(
        "threshold", "tp", "fp",
        F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("tpr"),
        F.try_divide(F.col("fp").cast("double"), F.col("N")).alias("fpr"))


def auc(scored: DataFrame, score_col: str = "prob", label_col: str = "y",
        num_partitions: int | None = None) -> DataFrame:
    """One row (auc, n_pos, n_neg)."""
    cum = _cumulative(scored, score_col, label_col, num_partitions)
    term = F.col("n") * (F.col("cum_p") - F.col("p") / F.lit(2.0))
    agg = cum.agg(F.sum(term).alias("_num"), F.sum("p").alias("n_pos"),
                  F.sum("n").alias("n_neg"))
    return agg.select(
        F.try_divide(F.col("_num"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("auc"),
        F.coalesce(F.col("n_pos"), F.lit(0)).cast("long").alias("n_pos"),
        F.coalesce(F.col("n_neg"), F.lit(0)).cast("long").alias("n_neg"))


def confusion_counts(scored: DataFrame, threshold: float = 0.5, score_col: str = "prob",
                     label_col: str = "y") -> DataFrame:
    """One row (tp, fp, tn, fn, accuracy) with prediction = score > threshold."""
    pred = F.col(score_col) > threshold
    pos = F.col(label_col) == 1

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("long")

    agg = scored.where(F.col(label_col).isNotNull() & F.col(score_col).isNotNull()).agg(n(pred & pos).alias("tp"), n(pred & ~pos).alias("fp"),
                     n(~pred & ~pos).alias("tn"), n(~pred & pos).alias("fn"))
    return agg.withColumn(
        "accuracy", F.try_divide((F.col("tp") + F.col("tn")).cast("double"),
                                 F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")))
