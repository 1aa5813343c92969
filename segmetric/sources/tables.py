"""Table scans, size-checked broadcast, and sinks."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan of one driver table; ``columns`` prunes the read schema."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def is_bounded(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows+1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast hint only behind a row-count check; otherwise let the planner choose."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df


def spread(df: DataFrame, min_partitions: int | None = None, rows_per_task: int | None = None) -> DataFrame:
    """Give a compute-heavy stage (model fits, numpy kernels) enough partitions:
    one per core, or with ``rows_per_task`` (for learners that make many cheap
    passes) about that many rows per task, up to one per core. Inputs that
    already have more partitions are left as they are."""
    sc = df.sparkSession.sparkContext
    n = min_partitions or sc.defaultParallelism
    if rows_per_task:
        n = min(n, max(1, -(-df.count() // rows_per_task)))
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def kernel_partitions(spark: SparkSession, groups: int) -> int:
    """Partition count for a cogroup over ``groups`` keys: one key per task up to
    4 x cores, never fewer than the configured shuffle partitions."""
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(base, min(groups, 4 * spark.sparkContext.defaultParallelism))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Table sink (no index column exists in Spark, so none is written)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_json_record(spark: SparkSession, record: dict, path: str) -> DataFrame:
    """Metadata sink. The record becomes a one-row frame written as JSON."""
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps(record)]))
    df.coalesce(1).write.mode("overwrite").json(path)
    return df


def load_processed(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Read processed features partitioned by ``split``; the filter prunes partitions."""
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df
