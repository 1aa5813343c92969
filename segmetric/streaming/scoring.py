"""Applying fitted stages to a stream.

The original project is batch only; its fitted preparation pipeline and
classifiers are Spark ML Transformers, which work unchanged on a streaming
DataFrame. This module only wires a Parquet stream source through them to a
sink; no state is kept between micro-batches.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession


def read_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet files arriving under ``path`` (the schema must be given for streams)."""
    return spark.readStream.schema(schema).parquet(path)


def score_stream(stream: DataFrame, stages: list[Transformer] | PipelineModel) -> DataFrame:
    """Transform a streaming DataFrame with fitted stages (stateless, per micro-batch)."""
    out = stream
    for st in (stages.stages if isinstance(stages, PipelineModel) else stages):
        out = st.transform(out)
    return out


def write_stream(scored: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Append scored rows as Parquet; the checkpoint folder makes restarts exact."""
    w = scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.outputMode("append").start()
