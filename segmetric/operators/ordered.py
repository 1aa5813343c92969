"""Running sums and ranks in a global order, without a single-task window.

``Window.partitionBy(g).orderBy(o)`` sorts each group in one task; a group that
holds a third of all rows would then sit in one task. Here rows are
range-partitioned on (group, order) so a hot group spreads over many tasks;
each task computes its local running sums, and the per-(partition, group)
totals -- at most partitions x groups rows -- give the offsets to add.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmetric.sources.tables import broadcast_if_bounded


def running_sum(df: DataFrame, group: list[str], order: list[Column | str], values: list[str],
                num_partitions: int | None = None, suffix: str = "_cum") -> DataFrame:
    """Inclusive running sums of ``values`` per group along ``order`` (a total order)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    okeys = [F.col(o) if isinstance(o, str) else o for o in order]
    names = [f"__o{i}" for i in range(len(okeys))]
    base = df.select("*", *[k.alias(nm) for k, nm in zip(okeys, names)])
    parted = base.repartitionByRange(n, *group, *names).withColumn("__pid", F.spark_partition_id())
    local_w = (Window.partitionBy("__pid", *group).orderBy(*names)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = parted.select("*", *[F.sum(v).over(local_w).alias(f"__l_{v}") for v in values])
    # materialised once so the partition totals see the same range bounds as the rows
    local = local.checkpoint(eager=True)
    tot = local.groupBy("__pid", *group).agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    ow = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("__pid", *group, *[F.coalesce(F.sum(f"__t_{v}").over(ow), F.lit(0)).alias(f"__o_{v}")
                                        for v in values])
    out = local.join(broadcast_if_bounded(off, 1_000_000), ["__pid", *group])
    out = out.select("*", *[(F.col(f"__o_{v}") + F.col(f"__l_{v}")).alias(f"{v}{suffix}") for v in values])
    return out.drop("__pid", *names, *[f"__l_{v}" for v in values], *[f"__o_{v}" for v in values])


def group_rank(df: DataFrame, group: list[str], order: list[Column | str],
               num_partitions: int | None = None, rank_col: str = "grp_rank") -> DataFrame:
    """0-based position of each row inside its group along ``order`` (a total order)."""
    out = running_sum(df.withColumn("__one", F.lit(1).cast("long")), group, order, ["__one"], num_partitions)
    return out.withColumn(rank_col, (F.col("__one_cum") - 1).cast("long")).drop("__one", "__one_cum")
