"""Bounded labelled samples for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmetric.llm.common import local_table

_SPAN = 1 << 40


def label_quota(rows: DataFrame, label: str, key: Column, per_label: int, max_labels: int = 200) -> DataFrame:
    """Rows of about ``per_label`` keys for each value of ``label``, chosen by a hash of the key.

    ``rows`` should hold the label and short columns only: they are counted by label first.
    The most frequent ``max_labels`` values take part (ties by value). The result holds
    about per_label * labels rows; deterministic.
    """
    spark = rows.sparkSession
    name = F.col(label).cast("string")
    counts = (rows.where(name.isNotNull()).groupBy(name.alias("name")).agg(F.count("*").alias("c"))
              .orderBy(F.col("c").desc(), "name").limit(max_labels).collect())
    share = local_table(spark, [(r[0], int(_SPAN * min(1.0, per_label / r[1]))) for r in counts],
                        "quota_label string, quota long")
    picked = rows.join(F.broadcast(share), name == F.col("quota_label"))
    return picked.where(F.pmod(F.xxhash64(key, F.lit("quota")), F.lit(_SPAN)) < F.col("quota")).drop("quota_label", "quota")
