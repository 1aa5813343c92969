"""Corpus preparation in five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns
them with the columns of documents; the last one adds the shard. ``run`` writes every
stage's result to the shared scratch folder and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmetric.llm import decontaminate, kd_shards, langid, mixing, ngram_join
from segmetric.llm.common import small_side, text_hash, written
from segmetric.llm.queries import MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, SHARDS


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is identified; texts without letters or below the least score go."""
    model = langid.fit_language_model(langid.training_rows(docs))
    return langid.keep_identified(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each n-gram Jaccard group: the first by id and text. Rows are told
    apart by id and text, so a clean text stays though its id stands on a copy too. Of rows with
    equal id and text one stays; documents without words stay."""
    gone = (ngram_join.ngram_jaccard_join(docs).where(~F.col("kept"))
            .select(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__gone_key")).distinct())
    keyed = docs.withColumn("__key", text_hash("text"))
    kept = keyed.join(small_side(gone, 1_000_000),
                      F.col("doc_id").eqNullSafe(F.col("__gone")) & (F.col("__key") == F.col("__gone_key")), "left_anti")
    return kept.dropDuplicates(["doc_id", "__key"]).drop("__key")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixing.mix_sources(docs, mixing.by_code_point(docs, MIX_WEIGHTS), MIX_SHARE, MIX_EPOCHS, MIX_SEED)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with size, text_crc32 and shard."""
    return kd_shards.kd_shards(docs, SHARDS)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", sharding),
]

#: Language identification can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
