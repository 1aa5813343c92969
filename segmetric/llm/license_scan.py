"""License scans by diagonal voting.

Texts become words; every rolling word pair's hash is joined to the places of the same
pair in the license templates. A hit votes for the diagonal (place in the text minus place
in the template) of its template. Votes are counted per diagonal, neighbouring diagonals
merge (an inserted or missing word shifts the diagonal), and a merged span is kept if it
holds enough of the template's pairs within the template's length plus the shift.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segmetric.llm.common import local_table, small_side, text_hash

#: (label, words, whether only the exact phrase counts)
PHRASES = [
    ("gpl", "gnu general public license", True),
    ("apache", "apache license", True),
    ("cc-by", "cc by", True),
    ("mit", "mit license", True),
]
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", False),
    ("gpl-3.0", "licensed under the gnu general public license version 3", False),
    ("cc-by-4.0", "licensed under cc by 4 0", False),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", False),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy", False),
]
#: Diagonals at most so far apart merge.
SHIFT = 2
#: Least share of a template's pairs in a span.
COVERAGE = 0.75

_CUT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; empty for null."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"  # only these: other letters stay as they are
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), _CUT), lambda w: w != "")


def template_pairs(spark: SparkSession, templates: list[tuple[str, str, bool]]) -> DataFrame:
    """(h, template, label, exact, pairs, tpos, w1, w2): every word pair of every template."""
    rows = []
    for t, (label, phrase, exact) in enumerate(templates):
        words = phrase.split()
        if len(words) < 2:
            raise ValueError("a template needs two words")
        rows += [(t, label, exact, len(words) - 1, i, words[i], words[i + 1]) for i in range(len(words) - 1)]
    df = local_table(spark, rows, "template int, label string, exact boolean, pairs int, tpos int, w1 string, w2 string")
    return df.withColumn("h", F.xxhash64(F.xxhash64("w1"), F.xxhash64("w2")))


def license_spans(docs: DataFrame, templates: list[tuple[str, str, bool]] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_words, copies, template, label, exact, first_word, last_word, coverage).

    One row per verified span, and one with null template for every document, which carries
    the number of equal rows (copies). first_word and last_word are the span's bounds, words
    counted from 0. A document is named by id and text hash: repeated rows are read as one
    with ``copies`` above 1. Null and empty texts have no words and no span; very long texts
    are read whole; an empty table gives no rows. Only the named columns are read.
    """
    spark = docs.sparkSession
    pairs = small_side(template_pairs(spark, templates if templates is not None else PHRASES + NOTICES))
    keys = ["doc_id", "text_key"]
    base = docs.select(F.col(id_col).alias("doc_id"), text_hash(F.col(text_col)).alias("text_key"),
                       license_words(F.col(text_col)).alias("words"))
    hashed = base.select(*keys, "words", F.expr("transform(words, w -> xxhash64(w))").alias("hs"))
    # element 0 stands for the document itself; element i for the pair that starts at word i - 1
    rolled = hashed.select(*keys, "words", F.expr(
        "transform(sequence(0, greatest(size(hs) - 1, 0)), i -> if(i = 0, null, xxhash64(hs[i - 1], hs[i])))").alias("hs"))
    # the outer form: for the inner one the optimizer infers a filter on the array and computes it again
    rows = rolled.select(*keys, "words", F.posexplode_outer("hs").alias("at", "h"))
    hits = rows.join(pairs, "h", "left").where(
        (F.col("at") == 0) | ((F.col("words")[F.col("at") - 1] == F.col("w1")) & (F.col("words")[F.col("at")] == F.col("w2"))))
    flat = hits.select(*keys, F.when(F.col("at") == 0, F.size("words")).alias("n_words"), "template", "label", "exact",
                       "pairs", "tpos", (F.col("at") - 1).alias("pos"))
    # votes: distinct places per diagonal, counted before and after the shuffle
    votes = flat.groupBy(*keys, "template", "label", "exact", "pairs", "tpos",
                         F.when(F.col("template").isNotNull(), F.col("pos")).alias("pos")).agg(
        F.max("n_words").alias("n_words"), F.count("*").alias("copies"))
    diagonal = votes.withColumn("diagonal", F.col("pos") - F.col("tpos"))
    by = Window.partitionBy(*keys, "template").orderBy("diagonal", "pos")
    gap = F.when(F.col("exact"), F.lit(0)).otherwise(F.lit(SHIFT))
    start = (F.col("diagonal") - F.lag("diagonal").over(by) > gap).cast("int")
    merged = diagonal.withColumn("island", F.sum(F.coalesce(start, F.lit(0))).over(by))
    spans = merged.groupBy(*keys, "template", "label", "exact", "pairs", "island").agg(
        F.max("n_words").alias("n_words"), F.max("copies").alias("copies"), F.min("pos").alias("first_word"),
        (F.max("pos") + 1).alias("last_word"), F.count_distinct("tpos").alias("held"))
    coverage = F.col("held") / F.col("pairs")
    verified = F.when(F.col("exact"), F.col("held") == F.col("pairs")).otherwise(
        (coverage >= COVERAGE) & (F.col("last_word") - F.col("first_word") <= F.col("pairs") + SHIFT))
    return spans.where(F.col("template").isNull() | verified).select(
        *keys, "n_words", "copies", "template", "label", "exact", "first_word", "last_word",
        F.when(F.col("template").isNotNull(), coverage).alias("coverage"))


def license_report(spans: DataFrame) -> DataFrame:
    """One row for each document row of ``license_spans``: doc_id, n_words, n_base (places of
    the exact phrases), first_word and last_word (their least and greatest start, else null),
    base_labels and labels (distinct, sorted, comma-joined, empty for none), score (greatest
    coverage of a span, 0 for none)."""
    def starts(f):
        return f(F.when(F.col("exact"), F.col("first_word")))

    def joined(values):
        return F.array_join(F.sort_array(values), ",")

    one = spans.groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.max(F.when(F.col("template").isNull(), F.col("copies"))).alias("copies"),
        F.count(F.when(F.col("exact"), 1)).alias("n_base"),
        starts(F.min).cast("long").alias("first_word"), starts(F.max).cast("long").alias("last_word"),
        joined(F.collect_set(F.when(F.col("exact"), F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"))
    return one.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies", "copy", "text_key")
