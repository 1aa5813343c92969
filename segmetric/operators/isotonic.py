"""Isotonic calibration (M7): pools of the least-squares non-decreasing fit, found in parallel.

Rows are counted by score first, so a score that a third of the rows share is one row. Neighbouring
pools whose means fall are joined inside every score range, then in rounds over ``fan_in`` neighbouring ranges
until one list is left; pools joined in a range stay joined in the whole. Means are compared as whole numbers
(labels are 0 or 1), and equal ones are joined, so the pools don't depend on how rows are partitioned.

Means of the pools are distinct fractions between 0 and 1 whose denominators add up to at most the number of rows
n, so there are no more than about n^(2/3) of them: a million for a billion rows. That bounds what the driver
holds to score with; a task of the last round holds the lists of ``fan_in`` neighbours.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_POOLS = "part int, lo double, hi double, n long, y long"


def _join_falling(stack: list, rows) -> list:
    """Adds (lo, hi, n, y) in order of score; a pool whose mean isn't above the one before joins it."""
    for lo, hi, n, y in rows:
        while stack and stack[-1][3] * n >= y * stack[-1][2]:
            lo, _, n0, y0 = stack.pop()
            n, y = n + n0, y + y0
        stack.append((lo, hi, n, y))
    return stack


def _records(f: pd.DataFrame):
    return zip(f["lo"].tolist(), f["hi"].tolist(), f["n"].tolist(), f["y"].tolist())


def isotonic_pools(scored: DataFrame, label: str = "label", score: str = "score", fan_in: int = 16,
                   num_partitions: int | None = None) -> DataFrame:
    """(lo, hi, n, y, value): the pools with their least and largest score, rows, positives and mean.

    Rows without a label or a finite score take no part; an empty table has no pools."""
    spark = scored.sparkSession
    s = F.col(score).cast("double")
    fit = scored.where(F.col(label).isNotNull() & s.isNotNull() & ~F.isnan(s) & (F.abs(s) != float("inf")))
    counts = fit.groupBy(s.alias("lo")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("y"))
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = counts.repartitionByRange(parts, "lo").sortWithinPartitions("lo").select(
        F.spark_partition_id().alias("part"), "lo", F.col("lo").alias("hi"), "n", "y")

    def inside(batches):
        stack, part = [], 0
        for b in batches:
            if len(b):
                part = int(b["part"].iloc[0])
                _join_falling(stack, _records(b))
        yield pd.DataFrame([(part, *r) for r in stack], columns=["part", "lo", "hi", "n", "y"])

    def across(f: pd.DataFrame) -> pd.DataFrame:
        part = int(f["part"].iloc[0])
        stack = _join_falling([], _records(f.sort_values("lo")))
        return pd.DataFrame([(part, *r) for r in stack], columns=["part", "lo", "hi", "n", "y"])

    pools = ranged.mapInPandas(inside, _POOLS)
    while parts > 1:
        parts = -(-parts // fan_in)
        pools = pools.withColumn("part", F.floor(F.col("part") / fan_in).cast("int")).groupBy("part").applyInPandas(across, _POOLS)
    return pools.select("lo", "hi", "n", "y", (F.col("y") / F.col("n")).alias("value"))


def isotonic_calibrator(scored: DataFrame, label: str = "label", score: str = "score"):
    """Function that replaces ``score`` by the fit: the pool's mean inside a pool, straight lines between
    pools, the end values outside. Null scores stay null."""
    pools = isotonic_pools(scored, label, score).orderBy("lo").collect()
    if not pools:
        raise ValueError("no labelled scores to calibrate on")
    ends = [(x, r["value"]) for r in pools for x in ([r["lo"]] if r["lo"] == r["hi"] else [r["lo"], r["hi"]])]
    at, value = np.array([e[0] for e in ends]), np.array([e[1] for e in ends])

    @F.pandas_udf("double")
    def fitted(s: pd.Series) -> pd.Series:
        return pd.Series(np.interp(s.to_numpy(dtype=np.float64, na_value=np.nan), at, value)).where(s.notna().to_numpy(), None)

    return lambda df: df.withColumn(score, fitted(F.col(score).cast("double")))
