"""Table profiling.

Every profile is one or two grouped aggregates over the table; wide results are
turned long with ``unpivot``/``explode`` so the output schema does not depend
on the number of columns. Quantiles come from the distributed exact operator.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmetric.operators.quantiles import _keyed_join, quantiles_long, to_long
from segmetric.sources.tables import broadcast_if_bounded


def label_overview(df: DataFrame, label: str = "label") -> DataFrame:
    """A1: n, class counts and positive rate (0.0 for an empty table)."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col(label) == 1, 1)).alias("n_positive"),
        F.count(F.when(F.col(label) == 0, 1)).alias("n_negative"),
    ).select("n", "n_positive", "n_negative",
             F.coalesce(F.try_divide(F.col("n_positive").cast("double"), F.col("n")), F.lit(0.0))
             .alias("positive_rate"))


def missing_table(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A2: per column missing count and rate, only columns with missing values."""
    cols = cols or df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    long = wide.unpivot("__n", cols, "column", "missing")
    return long.where(F.col("missing") > 0).select(
        "column", F.col("missing").cast("long"),
        (F.col("missing") / F.col("__n")).alias("missing_rate"))


def numeric_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """A3: count, mean, std (ddof=1), min, 25/50/75 % (linear), max per column."""
    long = to_long(df, cols)
    stats = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("vmin"), F.max("x").alias("vmax"))
    stats = stats.checkpoint(eager=True)
    q = quantiles_long(long, ["column"], [0.25, 0.5, 0.75], stats=stats.select("column", "n", "vmin", "vmax"))
    qw = q.groupBy("column").pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("value"))
    qw = qw.toDF("column", "p25", "p50", "p75")
    return stats.join(qw, "column").select(
        "column", F.col("n").alias("count"), "mean", "std", F.col("vmin").alias("min"),
        "p25", "p50", "p75", F.col("vmax").alias("max"))


def _category_value(c: str) -> F.Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("NA"))


def category_freq(df: DataFrame, cols: list[str], top_n_col: str | None = None,
                  top_n: int = 15, head: int = 30) -> DataFrame:
    """A4: frequency per category. ``top_n_col`` keeps its top N plus an 'Other'
    bucket (only when non-empty); other columns keep their first ``head``.
    Ties are ordered by category value."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), _category_value(c).alias("category")) for c in cols])).alias("p"))
    counts = long.groupBy("p.feature", "p.category").count()
    w = Window.partitionBy("feature").orderBy(F.desc("count"), "category")
    ranked = counts.withColumn("rank", F.row_number().over(w))
    is_top_col = F.col("feature") == F.lit(top_n_col) if top_n_col else F.lit(False)
    bucket = F.when(is_top_col & (F.col("rank") > top_n), F.lit("Other")).otherwise(F.col("category"))
    keep = is_top_col | (F.col("rank") <= head)
    agg = ranked.where(keep).groupBy("feature", bucket.alias("category")).agg(
        F.sum("count").alias("count"), F.min("rank").alias("rank"))
    return agg.select("feature", "category", F.col("count").cast("long"), F.col("rank").cast("int"))


def outcome_rate_by_category(df: DataFrame, cols: list[str], label: str = "label",
                             min_count: int = 20, top: int = 30) -> DataFrame:
    """A5: outcome mean and count per category, count >= min_count, top by rate."""
    long = df.select(F.col(label).alias("__y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), _category_value(c).alias("category")) for c in cols])).alias("p"))
    agg = long.groupBy("p.feature", "p.category").agg(
        F.avg("__y").alias("outcome_rate"), F.count(F.lit(1)).alias("n"))
    agg = agg.where(F.col("n") >= min_count)
    w = Window.partitionBy("feature").orderBy(F.desc("outcome_rate"), F.desc("n"), "category")
    return agg.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def _pair_corr(a: str, b: str) -> F.Column:
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x = F.when(both, F.col(a).cast("double"))
    y = F.when(both, F.col(b).cast("double"))
    r = F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
    return F.coalesce(F.when(~F.isnan(r), r), F.lit(0.0))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """A10: Pearson matrix in long form (col_a, col_b, corr), nulls dropped pairwise,
    undefined correlations reported as 0.0. One aggregate for all pairs."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    names = [f"__c{i}" for i in range(len(pairs))]
    wide = df.agg(*[_pair_corr(a, b).alias(n) for (a, b), n in zip(pairs, names)])
    entries = []
    for (a, b), n in zip(pairs, names):
        entries.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(n).alias("corr")))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(n).alias("corr")))
    return wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def corr_pairs(df: DataFrame, cols: list[str], threshold: float = 0.95) -> DataFrame:
    """Upper-triangle pairs (in column order) with |r| >= threshold, by |r| desc."""
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, corr double")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[_pair_corr(a, b).alias(f"__c{i}") for i, (a, b) in enumerate(pairs)])
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"__c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)])).alias("e")).select("e.*")
    return long.where(F.abs("corr") >= threshold).orderBy(F.desc(F.abs("corr")), "col_a", "col_b")


def histogram(df: DataFrame, cols: list[str], num_bins: int | None = None) -> DataFrame:
    """Equal-width bins per column, zero bins included.

    Bin count as numpy's 'auto' rule: width = min(Sturges, Freedman-Diaconis)
    (Sturges alone when the IQR is 0), bins = ceil(range / width)."""
    long = to_long(df, cols)
    stats = long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("vmin"),
                                       F.max("x").alias("vmax")).checkpoint(eager=True)
    rng = F.col("vmax") - F.col("vmin")
    if num_bins:
        nb = F.lit(int(num_bins))
    else:
        q = quantiles_long(long, ["column"], [0.25, 0.75], stats=stats)
        iqr = q.groupBy("column").agg((F.max("value") - F.min("value")).alias("iqr"))
        stats = stats.join(iqr, "column")
        sturges = rng / (F.log2(F.col("n")) + 1.0)
        fd = 2.0 * F.col("iqr") * F.pow(F.col("n").cast("double"), -1.0 / 3.0)
        width = F.when(fd > 0, F.least(sturges, fd)).otherwise(sturges)
        nb = F.when(rng > 0, F.ceil(rng / width)).otherwise(F.lit(1))
    stats = stats.withColumn("nbins", nb.cast("int"))
    bins = stats.select("column", "vmin", "vmax", "nbins",
                        F.explode(F.sequence(F.lit(0), F.col("nbins") - 1)).alias("bin"))
    bins = bins.select("column", "bin", "nbins",
                       (F.col("vmin") + (F.col("vmax") - F.col("vmin")) * F.col("bin") / F.col("nbins")).alias("lo"),
                       (F.col("vmin") + (F.col("vmax") - F.col("vmin")) * (F.col("bin") + 1) / F.col("nbins"))
                       .alias("hi"))
    s = broadcast_if_bounded(stats.select("column", "vmin", "vmax", "nbins"))
    tagged = long.join(s, "column")
    b = F.when(F.col("vmax") > F.col("vmin"),
               F.least(F.col("nbins") - 1,
                       F.floor((F.col("x") - F.col("vmin")) / (F.col("vmax") - F.col("vmin")) * F.col("nbins"))))
    counts = tagged.groupBy("column", b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    out = bins.join(counts, ["column", "bin"], "left")
    return out.select("column", "bin", "lo", "hi", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def kde(df: DataFrame, cols: list[str], grid_size: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian KDE with Scott bandwidth h = std * n^(-1/5) on a grid from
    min - cut*h to max + cut*h. Each row adds its kernel value at every grid
    point; partial aggregation keeps at most grid_size rows per column per task."""
    long = to_long(df, cols)
    stats = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
        F.min("x").alias("vmin"), F.max("x").alias("vmax"))
    stats = stats.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), -0.2))
    stats = stats.where(F.col("h") > 0)
    stats = stats.withColumn("g0", F.col("vmin") - cut * F.col("h")).withColumn(
        "gstep", (F.col("vmax") - F.col("vmin") + 2 * cut * F.col("h")) / (grid_size - 1))
    s = broadcast_if_bounded(stats.select("column", "n", "h", "g0", "gstep")).checkpoint(eager=True)
    tagged = long.join(s, "column").select(
        "column", "x", "n", "h", "g0", "gstep", F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("i"))
    g = F.col("g0") + F.col("i") * F.col("gstep")
    z = (g - F.col("x")) / F.col("h")
    dens = F.exp(-0.5 * z * z) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
    out = tagged.groupBy("column", "i").agg(F.first(g).alias("grid"), F.sum(dens).alias("density"))
    return out.select("column", F.col("i").cast("int").alias("point"), "grid", "density")


def box_stats(df: DataFrame, cols: list[str], by: str = "label") -> DataFrame:
    """Quartiles per (column, group); whiskers at the last datum inside
    1.5*IQR; number of points outside the whiskers."""
    long = to_long(df, cols, [by])
    q = quantiles_long(long, [by, "column"], [0.25, 0.5, 0.75])
    qw = q.groupBy(by, "column").pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("value")).toDF(
        by, "column", "q1", "median", "q3")
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1")).checkpoint(eager=True)
    fences = broadcast_if_bounded(qw)
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    j = _keyed_join(long, fences, [by, "column"])
    inside = (F.col("x") >= lo_f) & (F.col("x") <= hi_f)
    agg = j.groupBy(by, "column").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_hi"),
        F.count(F.when(~inside, 1)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
    return _keyed_join(qw, agg, [by, "column"]).select(
        by, "column", "n", "q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi",
        F.col("n_outliers").cast("long"))
