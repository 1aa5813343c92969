"""Helpers of the corpus operators: scratch tables, checked broadcasts, word arrays."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

#: Words are separated by space and the five ASCII control blanks.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"


def scratch_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and written intermediate tables.

    The folder that the cluster names in ``spark.checkpoint.dir``; where that is
    unset a private one is made, which only a local master may use.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="corpus-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Arrow batches of at most ``most`` rows for what is written inside; the session's
    setting comes back afterwards. Only memory depends on it, never a result."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(most, int(before)) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read again: its
    lineage is cut and later readers scan only the columns they use. ``batch_rows`` bounds
    the rows of the Arrow batches that Python steps of ``df`` get."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/corpus-{label}-{uuid.uuid4().hex}"
    with arrow_rows(spark, batch_rows) if batch_rows else nullcontext():
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a table from ``written`` that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def local_table(spark: SparkSession, rows: Iterable[tuple], ddl: str) -> DataFrame:
    """A short table of plain values, built by the JVM from one literal: no Python worker
    starts for it on an executor."""
    schema = StructType.fromDDL(ddl)
    text = json.dumps([dict(zip(schema.names, r)) for r in rows])
    held = F.from_json(F.lit(text), ArrayType(schema))
    return spark.range(0, 1, 1, 1).select(F.explode(held).alias("r")).select("r.*")


def bounded(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows (reads at most one more)."""
    return df.limit(max_rows + 1).count() <= max_rows


def small_side(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint if its row count is within ``max_rows``; else as it
    is, for a shuffled join. Only for tables of a few short columns."""
    return F.broadcast(df) if bounded(df, max_rows) else df


def text_hash(text: Column | str) -> Column:
    """64-bit hash of a text; null counts as a value of its own."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("\u0000null")))


def blank_words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; empty for null."""
    kept = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    return F.when(kept == "", F.array().cast("array<string>")).otherwise(F.split(kept, BLANKS))


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column in ``taken`` has it."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name
