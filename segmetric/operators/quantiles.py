"""Exact, linearly interpolated quantiles without gathering a column in one task.

Spark's ``percentile``/``median`` aggregates merge every distinct value of a
group into one buffer, which does not survive a global aggregate at scale.
Here the order statistics a quantile needs are found by histogram
refinement: each round buckets the values inside the current window of every
target rank (one grouped aggregate with partial aggregation, output at most
``buckets`` rows per window) and narrows the window to the bucket that holds
the rank. Once a window holds at most ``final_rows`` values, the exact rank is
read with a row_number over that bounded window. Interpolation matches
pandas ``describe``/``quantile``, DuckDB ``quantile_cont`` and Spark
``percentile``: position q*(n-1) between the two neighbouring order statistics.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmetric.sources.tables import broadcast_if_bounded

_BUCKETS = 1024
_FINAL_ROWS = 1_000_000
_STUCK_ROUNDS = 200


def to_long(df: DataFrame, cols: list[str], by: list[str] | None = None,
            name_col: str = "column", value_col: str = "x") -> DataFrame:
    """Wide -> long (by..., column, x) as double, dropping nulls and NaN."""
    by = by or []
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias(name_col), F.col(c).cast("double").alias(value_col)) for c in cols
    ])).alias("_p")
    out = df.select(*by, pairs).select(*by, f"_p.{name_col}", f"_p.{value_col}")
    return out.where(F.col(value_col).isNotNull() & ~F.isnan(value_col))


def _keyed_join(left: DataFrame, right: DataFrame, keys: list[str], extra=None, how: str = "inner") -> DataFrame:
    """Null-safe equi-join on ``keys``; ``extra(l, r)`` adds a condition using
    accessors for the left and right columns. Keys are kept once."""
    a, b = left.alias("_l"), right.alias("_r")

    def lc(c):
        return F.col(f"_l.{c}")

    def rc(c):
        return F.col(f"_r.{c}")

    cond = [lc(k).eqNullSafe(rc(k)) for k in keys]
    if extra is not None:
        cond.append(extra(lc, rc))
    out = a.join(b, reduce(lambda x, y: x & y, cond), how)
    rest = [rc(c) for c in right.columns if c not in keys]
    return out.select(*[lc(c) for c in left.columns], *rest)


def order_statistics(long_df: DataFrame, keys: list[str], ranks: DataFrame,
                     value_col: str = "x", buckets: int | None = None,
                     final_rows: int | None = None) -> DataFrame:
    """Exact k-th smallest values (0-based ``rank``) per key.

    ``ranks`` holds keys..., rank, lo, hi, below, cnt where [lo, hi] is a value
    window known to contain the rank and ``below`` counts values under lo.
    Returns keys..., rank, value.
    """
    buckets = buckets or _BUCKETS
    final_rows = final_rows or _FINAL_ROWS
    win_cols = keys + ["lo", "hi", "below"]
    rw = ranks
    for turn in range(_STUCK_ROUNDS + 1):
        if turn == _STUCK_ROUNDS:
            raise RuntimeError("quantile windows stopped shrinking")
        big = rw.where((F.col("cnt") > final_rows) & (F.col("lo") < F.col("hi")))
        if big.isEmpty():
            break
        small = rw.where(~((F.col("cnt") > final_rows) & (F.col("lo") < F.col("hi"))))
        windows = broadcast_if_bounded(big.select(*win_cols).distinct())
        inside = _keyed_join(long_df, windows, keys,
                             lambda l, r: (l(value_col) >= r("lo")) & (l(value_col) <= r("hi")))
        b = F.least(F.lit(buckets - 1), F.floor((F.col(value_col) - F.col("lo"))
                                              / (F.col("hi") - F.col("lo")) * buckets)).cast("int")
        hist = inside.groupBy(*win_cols, b.alias("b")).agg(
            F.count(F.lit(1)).alias("c"), F.min(value_col).alias("bmin"), F.max(value_col).alias("bmax"))
        w = Window.partitionBy(*win_cols).orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hist = hist.withColumn("before", F.sum("c").over(w) - F.col("c"))
        h = hist.alias("h")
        r = big.alias("r")
        cond = [F.col(f"r.{k}").eqNullSafe(F.col(f"h.{k}")) for k in win_cols]
        pos = F.col("r.rank") - F.col("r.below") - F.col("h.before")
        cond += [pos >= 0, pos < F.col("h.c")]
        refined = r.join(h, reduce(lambda a, c: a & c, cond)).select(
            *[F.col(f"r.{k}").alias(k) for k in keys], F.col("r.rank"),
            F.col("h.bmin").alias("lo"), F.col("h.bmax").alias("hi"),
            (F.col("r.below") + F.col("h.before")).alias("below"), F.col("h.c").alias("cnt"))
        rw = small.unionByName(refined).checkpoint(eager=True)
    done = rw.where(F.col("lo") == F.col("hi")).select(*keys, "rank", F.col("lo").alias("value"))
    open_ = rw.where(F.col("lo") < F.col("hi"))
    windows = broadcast_if_bounded(open_.select(*win_cols).distinct())
    inside = _keyed_join(long_df, windows, keys,
                         lambda l, r: (l(value_col) >= r("lo")) & (l(value_col) <= r("hi")))
    rn = F.row_number().over(Window.partitionBy(*win_cols).orderBy(value_col)) - 1 + F.col("below")
    ranked = inside.select(*win_cols, rn.alias("rank"), F.col(value_col).alias("value"))
    picked = _keyed_join(open_.select(*win_cols, "rank"), ranked, win_cols + ["rank"])
    return done.unionByName(picked.select(*keys, "rank", "value"))


def quantiles_long(long_df: DataFrame, keys: list[str], probs: list[float],
                   value_col: str = "x", stats: DataFrame | None = None) -> DataFrame:
    """keys..., prob, value: exact interpolated quantiles of ``value_col`` per key."""
    if stats is None:
        stats = long_df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.min(value_col).alias("vmin"), F.max(value_col).alias("vmax"))
    tgt = stats.select("*", F.explode(F.array(*[F.lit(float(q)) for q in probs])).alias("prob"))
    tgt = tgt.withColumn("pos", F.col("prob") * (F.col("n") - 1))
    tgt = tgt.withColumn("k_lo", F.floor("pos").cast("long")).withColumn("k_hi", F.ceil("pos").cast("long"))
    tgt = tgt.checkpoint(eager=True)
    ranks = tgt.select(*keys, F.explode(F.array("k_lo", "k_hi")).alias("rank"),
                       F.col("vmin").alias("lo"), F.col("vmax").alias("hi"),
                       F.lit(0).cast("long").alias("below"), F.col("n").alias("cnt")).distinct()
    stat = order_statistics(long_df, keys, ranks, value_col)
    lo = stat.select(*keys, F.col("rank").alias("k_lo"), F.col("value").alias("v_lo"))
    hi = stat.select(*keys, F.col("rank").alias("k_hi"), F.col("value").alias("v_hi"))
    out = _keyed_join(_keyed_join(tgt, lo, keys + ["k_lo"]), hi, keys + ["k_hi"])
    value = F.when(F.col("k_lo") == F.col("k_hi"), F.col("v_lo")).otherwise(
        F.col("v_lo") + (F.col("pos") - F.col("k_lo")) * (F.col("v_hi") - F.col("v_lo")))
    return out.select(*keys, "prob", value.alias("value"))


def quantiles(df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None) -> DataFrame:
    """by..., column, prob, value for every numeric column in ``cols``."""
    by = by or []
    return quantiles_long(to_long(df, cols, by), by + ["column"], probs)
