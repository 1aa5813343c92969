"""Stratified folds and splits, class weights.

A rank within a class is needed for exact per-class fold balance. It comes
from ``ordered.group_rank`` (range-partitioned, no single-task window), so a
class holding most rows is still ranked by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmetric.operators.ordered import group_rank
from segmetric.sources.tables import broadcast_if_bounded


def shuffle_key(row_id: str = "row_id", seed: int = 42, portable: bool = False) -> Column:
    """Deterministic pseudo-random order of rows (never rand()).

    ``portable`` uses integer arithmetic that other SQL engines reproduce."""
    if portable:
        return F.pmod(F.col(row_id) * 7919 + F.lit(seed), F.lit(10007))
    return F.xxhash64(F.lit(seed), F.col(row_id))


def stratified_folds(df: DataFrame, label: str = "label", k: int = 5, seed: int = 42,
                     row_id: str = "row_id", portable: bool = False) -> DataFrame:
    """fold = position in the shuffled class order mod k (class sizes per fold differ by <= 1)."""
    r = group_rank(df, [label], [shuffle_key(row_id, seed, portable), F.col(row_id)])
    return r.withColumn("fold", (F.col("grp_rank") % k).cast("int")).drop("grp_rank")


def stratified_split(df: DataFrame, label: str = "label", test_fraction: float = 0.2, seed: int = 42,
                     row_id: str = "row_id", portable: bool = False, out_col: str = "part") -> DataFrame:
    """One stratified shuffle split; the first round(frac * n_class) rows of
    each shuffled class go to 'holdout', the rest to 'fit'."""
    r = group_rank(df, [label], [shuffle_key(row_id, seed, portable), F.col(row_id)])
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    r = r.join(broadcast_if_bounded(sizes), label)
    n_hold = F.round(F.col("__n") * F.lit(float(test_fraction)))
    return r.withColumn(out_col, F.when(F.col("grp_rank") < n_hold, "holdout").otherwise("fit")).drop(
        "grp_rank", "__n")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights w_c = n / (n_classes * n_c)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    every = Window.partitionBy()  # over the per-class table only: one row per class
    return c.select(label, F.col("n_c").cast("long"),
                    (F.sum("n_c").over(every) / (F.count(F.lit(1)).over(every) * F.col("n_c"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = "label", weight_col: str = "weight") -> DataFrame:
    """Attach the balanced weight of each row's class."""
    w = broadcast_if_bounded(class_weights(df, label).select(label, F.col("weight").alias(weight_col)))
    return df.join(w, label)
