"""Mixing sources to target weights by capped water-filling.

Targets share a number of words among sources by weight; a source's target stops at
``max_epochs`` times its size and the excess goes to the others by weight until none is
above. A document is taken whole as often as its source's target holds whole epochs, and
once more if it comes early enough in its source's seeded order for the rest.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmetric.llm.common import BLANKS, blank_words, fresh, small_side, written

#: Hex digits of a document's order key that name its bucket.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0)."""
    return F.size(blank_words(text)).cast("long")


def order_key(id_col: Column, text_col: Column, seed: str) -> Column:
    """Seeded order of documents within a source: the MD5 digest of seed, id and the text's digest."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("")),
                             F.coalesce(F.md5(text_col), F.lit(""))))


def water_fill(sizes: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """(source, weight, source_size) with target: weights share ``share`` times all sizes,
    no target above ``max_epochs`` times its source's size.

    Each round computes one level (words per unit of weight) over the sources that aren't
    clamped yet and clamps those above it; a round's only result on the driver is three
    sums. Stops when a round clamps none, so after one round more than there are
    different caps at most. Sources without words or weight get 0.
    """
    table = written(sizes.withColumn("cap", F.col("source_size") * max_epochs)
                    .withColumn("clamped", (F.col("weight") <= 0) | (F.col("cap") <= 0)), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    ratio = F.col("cap") / F.col("weight")
    while True:
        # a source clamped at an earlier level stays clamped: the level only rises
        full = F.col("clamped") | (F.col("weight") * F.lit(level) > F.col("cap"))
        used, weight, n = table.agg(
            F.sum(F.when(full & (F.col("weight") > 0), F.col("cap"))),
            F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        if not weight:
            return table.select("source", "weight", "source_size", F.when(F.col("weight") > 0, F.col("cap"))
                                .otherwise(F.lit(0.0)).cast("double").alias("target"))
        new = max(0.0, share * total - float(used or 0.0)) / float(weight)
        if new <= level or table.where(~full & (ratio < F.lit(new))).isEmpty():
            level = new
            return table.select("source", "weight", "source_size", F.when(
                F.col("weight") <= 0, F.lit(0.0)).otherwise(
                F.least("cap", F.col("weight") * F.lit(level))).cast("double").alias("target"))
        level = new


def by_code_point(docs: DataFrame, weights: list[float], source_col: str = "source") -> DataFrame:
    """(source, weight): ``weights`` dealt in turn to the distinct sources in code point
    order, null last. The list of sources is ranked in one task; it has one short row each."""
    names = docs.select(F.col(source_col).alias("source")).distinct()
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    return names.withColumn("r", rank).select("source", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("r") % len(weights)).cast("int") + 1).alias("weight"))


def mixing_plan(docs: DataFrame, weights: DataFrame, share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix",
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(source, weight, source_size, target, epochs, cut): what each source's documents need
    to know: whole repetitions, and the order key up to which (inclusive) one more is taken.

    Sizes are summed per source and bucket of the order key first, so no source is gathered;
    only documents of the one bucket in which a source's rest ends are ordered one by one.
    """
    slim = written(docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                               order_key(F.col(id_col), F.col(text_col), seed).alias("k")), "sizes")
    bucket = F.substring("k", 1, BUCKET_DIGITS).alias("bucket")
    part = written(slim.groupBy("source", bucket).agg(F.sum("size").alias("size")), "buckets")
    total = part.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighted = total.join(weights.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    filled = water_fill(weighted, share, max_epochs)
    plan = written(filled.withColumn("epochs", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + F.lit(1e-12))).otherwise(F.lit(0)))
        .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size"))), "plan")
    small = small_side(plan.select(F.col("source").alias("s"), "rest"))
    run = Window.partitionBy("source").orderBy("bucket")  # one row per bucket: at most 16 ** BUCKET_DIGITS
    ends = (part.join(small, F.col("source").eqNullSafe(F.col("s"))).withColumn("upto", F.sum("size").over(run))
            .where((F.col("upto") - F.col("size") < F.col("rest")) & (F.col("upto") >= F.col("rest")))
            .select(F.col("source").alias("s"), F.col("bucket").alias("b"), (F.col("upto") - F.col("size")).alias("before"),
                    "rest"))
    inside = Window.partitionBy("source").orderBy("k").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    near = (slim.join(small_side(ends), F.col("source").eqNullSafe(F.col("s")) & (bucket == F.col("b")))
            .groupBy("source", "k").agg(F.sum("size").alias("size"), F.first("before").alias("before"),
                                        F.first("rest").alias("rest"))
            .withColumn("upto", F.col("before") + F.sum("size").over(inside)))
    # the last document is taken if that comes nearer to the rest
    taken = near.where((F.col("upto") <= F.col("rest")) | ((F.col("upto") - F.col("size") < F.col("rest")) &
                       (F.col("upto") - F.col("rest") <= F.col("rest") - (F.col("upto") - F.col("size")))))
    last = taken.groupBy(F.col("source").alias("s")).agg(F.max("k").alias("last"))
    edge = ends.select(F.col("s").alias("e"), "b")
    cut = (plan.join(edge, F.col("source").eqNullSafe(F.col("e")), "left")
           .join(last, F.col("source").eqNullSafe(F.col("s")), "left"))
    return written(cut.select("source", "weight", "source_size", "target", F.col("epochs").cast("int").alias("epochs"),
                              F.coalesce("last", "b", F.lit("")).alias("cut")), "cuts")


def planned_repeats(docs: DataFrame, plan: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", name: str = "repeats") -> DataFrame:
    """``docs`` with source_size, target and ``name``: how often the mix takes the row."""
    side = small_side(plan.select(F.col("source").alias("__s"), F.col("source_size").alias("__size"),
                                  F.col("target").alias("__target"), F.col("epochs").alias("__epochs"),
                                  F.col("cut").alias("__cut")))
    joined = docs.join(side, docs[source_col].eqNullSafe(F.col("__s")))
    extra = (order_key(docs[id_col], docs[text_col], seed) <= F.col("__cut")).cast("int")
    kept = [docs[c] for c in docs.columns if c.lower() not in ("source_size", "target", name)]
    return joined.select(*kept, F.col("__size").alias("source_size"), F.col("__target").alias("target"),
                         (F.col("__epochs") + extra).alias(name))


def mix_sources(docs: DataFrame, weights: DataFrame, share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix",
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed table: rows of ``docs``, each as often as the plan takes it.

    Null texts have size 0 and follow their source's repetitions; a null source is a source.
    Rows with equal id and text share one decision, so repeated rows are taken alike; null ids are
    told apart by their texts. Whole rows are taken: a source's words miss its target by at
    most half its largest row (or group of repeated rows). An empty table gives an empty one. Sources that ``weights`` lacks or gives 0 are left out. Same seed, same
    result. Columns come back as they were.
    """
    plan = mixing_plan(docs, weights, share, max_epochs, seed, id_col, text_col, source_col)
    name = fresh(docs.columns, "__repeats")
    rep = planned_repeats(docs.select("*"), plan, seed, id_col, text_col, source_col, name).where(F.col(name) > 0)
    once = rep.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(name))).alias(name))
    return once.drop(name)


__all__ = ["BLANKS", "by_code_point", "mix_sources", "mixing_plan", "order_key", "planned_repeats", "water_fill", "word_count"]
