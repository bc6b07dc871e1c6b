"""Model monitoring: classification quality and drift over a scoring log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.functions.safe import rate
from beaconry.operators.ordering import range_slices


def confusion_matrix(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    return scored.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count("*").alias("n"))


def f1_columns(label: Column, prediction: Column) -> dict[str, Column]:
    """Aggregates for precision, recall and F1 of the positive class."""
    tp = F.count_if((label == 1) & (prediction == 1))
    fp = F.count_if((label == 0) & (prediction == 1))
    fn = F.count_if((label == 1) & (prediction == 0))
    return {"precision": rate(tp, tp + fp), "recall": rate(tp, tp + fn),
            "f1": rate(2 * tp, 2 * tp + fp + fn)}


def classification_report(scored: DataFrame, label: str, prediction: str,
                          by: list[Column] = ()) -> DataFrame:
    columns = f1_columns(F.col(label), F.col(prediction))
    return scored.groupBy(*by).agg(F.count("*").alias("n"),
                                   *[c.alias(n) for n, c in columns.items()])


def auc(scored: DataFrame, label: str, score: str, slices: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counted half (one row).

    Scores are summed per distinct value, then a running count of negatives is
    taken over range slices: no task sees more than its slice.
    """
    per_score = scored.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    sliced = range_slices(per_score, [F.col("s")], slices)
    offsets = sliced.groupBy("_slice").agg(F.sum("n").alias("_n")).select(
        "_slice", F.coalesce(F.sum("_n").over(
            W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = W.partitionBy("_slice").orderBy("_pos").rowsBetween(W.unboundedPreceding, -1)
    below = F.coalesce(F.sum("n").over(within), F.lit(0)) + F.col("_before")
    area = (sliced.join(F.broadcast(offsets), "_slice")
            .select("p", "n", (F.col("p") * (below + F.col("n") / 2)).alias("_area"))
            .agg(F.sum("_area").alias("_area"), F.sum("p").alias("_p"), F.sum("n").alias("_n")))
    return area.select(rate(F.col("_area"), F.col("_p") * F.col("_n")).alias("auc"))


def drift_of_means(log: DataFrame, baseline: DataFrame, score: str, scored_at: str,
                   segments: list[str] = (), window: str = "1 day") -> DataFrame:
    """Mean score per window (and segment) minus the baseline mean of the segment."""
    windows = log.groupBy(F.window(scored_at, window)["start"].alias("window_start"), *segments).agg(
        F.avg(score).alias("mean_score"), F.count("*").alias("n"))
    base = baseline.groupBy(*segments).agg(F.avg(score).alias("baseline_mean"))
    if segments:
        joined = windows.join(base, list(segments))
    else:
        joined = windows.withColumn("baseline_mean", base.scalar())
    return joined.withColumn("difference_of_means", F.col("mean_score") - F.col("baseline_mean"))


def performance_alert(report: DataFrame, metric: str, threshold: float) -> DataFrame:
    """One row: does any window fall below the threshold?"""
    return report.agg(
        F.coalesce(F.bool_or(F.col(metric) < threshold), F.lit(False)).alias("alert"),
        F.count_if(F.col(metric) < threshold).alias("windows_below"))
