"""Threshold sweep, choice and thresholded evaluation.

The sweep is O(n + steps): each score is mapped to the index of the last grid
point it reaches, counts are grouped by that index (at most steps+1 rows per
group), and suffix sums over that small table give TP/FP at every threshold.
No row is ever paired with the grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmetric.operators.evaluate import binary_metrics
from segmetric.sources.tables import broadcast_if_bounded


def grid_index(score: str, steps: int):
    """Largest i with i/(steps-1) <= score (-1 below 0, steps-1 above 1); the
    floor estimate is corrected against the exact grid values."""
    d = float(steps - 1)
    s = F.col(score)
    b = F.floor(s * d).cast("long")
    b = F.when(s >= (b + 1) / d, b + 1).when(s < b / d, b - 1).otherwise(b)
    return F.when(s < 0, F.lit(-1)).when(s >= 1, F.lit(steps - 1)).otherwise(b)


def threshold_sweep(df: DataFrame, group: list[str], label: str = "label", score: str = "score",
                    steps: int = 201) -> DataFrame:
    """M4: precision, recall, F1 of ``score >= t`` for t = i/(steps-1), i in 0..steps-1."""
    counts = df.groupBy(*group, grid_index(score, steps).alias("i")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) == 0, 1)).alias("neg"))
    totals = counts.groupBy(*group).agg(F.sum("pos").alias("P"))
    grid = totals.select(*group, "P", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("i"))
    g = grid.join(counts, [*group, "i"], "left").fillna(0, ["pos", "neg"])
    w = Window.partitionBy(*group).orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g = g.select(*group, "i", "P", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp"))
    tp, fp, P = F.col("tp"), F.col("fp"), F.col("P")
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return g.select(*group, (F.col("i") / float(steps - 1)).alias("threshold"),
                    ratio(tp, tp + fp).alias("precision"), ratio(tp, P).alias("recall"),
                    ratio(2 * tp, tp + fp + P).alias("f1"))


def choose_threshold(sweep: DataFrame, group: list[str], target_recall: float | None = None,
                     target_precision: float | None = None) -> DataFrame:
    """Best F1 (then smallest threshold) among rows meeting the
    floors; when none meets them, among all rows. One ordered pass per group."""
    ok = F.lit(True)
    if target_recall is not None:
        ok = ok & (F.col("recall") >= float(target_recall))
    if target_precision is not None:
        ok = ok & (F.col("precision") >= float(target_precision))
    w = Window.partitionBy(*group).orderBy(F.desc(ok.cast("int")), F.desc("f1"), "threshold")
    return sweep.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1).drop("__r")


def apply_threshold(df: DataFrame, threshold, score: str = "score", out: str = "pred") -> DataFrame:
    """pred = score >= t."""
    t = threshold if not isinstance(threshold, (int, float)) else F.lit(float(threshold))
    return df.withColumn(out, (F.col(score) >= t).cast("int"))


def evaluate_at_threshold(scores: DataFrame, thresholds: DataFrame, group: list[str],
                          split: str = "split", label: str = "label", score: str = "score") -> DataFrame:
    """M6: metrics of both splits at the per-group chosen threshold."""
    j = scores.join(broadcast_if_bounded(thresholds.select(*group, "threshold")), group)
    pred = apply_threshold(j, F.col("threshold"), score)
    return binary_metrics(pred, [*group, split, "threshold"], label, "pred", score)
