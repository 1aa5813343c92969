"""Benchmark decontamination: size-partitioned MinHash containment search.

Short test items are looked for inside documents of any length. Items are partitioned by
their number of shingles into classes [1, 2), [2, 4), [4, 8), ... The sketch of an item
holds its least min-hash values, as many as its class needs: an item of n shingles of
which a document holds the share ``containment`` misses at most n - ceil(containment * n)
of them, so one more sketch value than the class's largest item may miss always meets the
document. The search therefore loses nothing, whatever the document's length, and a
document is probed with equi-joins on hashes only. Items that meet are then verified by
exact containment of their shingles, compared as words.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmetric.llm.common import blank_words, small_side, text_hash, written


def _windows(hashes: str, width: int) -> Column:
    """Array of the hashes of all ``width``-word windows of an array of word hashes."""
    parts = ", ".join(f"{hashes}[i + {k}]" if k else f"{hashes}[i]" for k in range(width))
    return F.expr(f"CASE WHEN size({hashes}) >= {width} THEN "
                  f"transform(sequence(0, size({hashes}) - {width}), i -> xxhash64({parts})) "
                  f"ELSE array() END")


def _hashed(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    return (df.select(*keep, blank_words(F.lower(F.col(text))).alias("words"))
            .select(*keep, "words", F.expr("transform(words, w -> xxhash64(w))").alias("hashes")))


def item_shingles(items: DataFrame, width: int, item_col: str, text_col: str) -> DataFrame:
    """(item_id, width, n, hash, shingle): distinct shingles of every item; an item of fewer
    words than ``width`` is one shingle of its own width. Null and blank items have none."""
    words = items.select(F.col(item_col).alias("item_id"), blank_words(F.lower(F.col(text_col))).alias("words"))
    sized = words.where(F.size("words") > 0).withColumn("width", F.least(F.size("words"), F.lit(width)))
    one = sized.select("item_id", "width", F.explode(F.array_distinct(F.expr(
        "transform(sequence(1, size(words) - width + 1), i -> slice(words, i, width))"))).alias("shingle"))
    one = one.distinct()  # repeated rows of an item are one item
    n = one.groupBy("item_id").agg(F.count("*").alias("n"))
    hashed = F.expr("CASE width " + " ".join(
        f"WHEN {w} THEN xxhash64({', '.join(f'xxhash64(get(shingle, {k}))' for k in range(w))})" if w > 1
        else "WHEN 1 THEN xxhash64(xxhash64(shingle[0]))" for w in range(1, width + 1)) + " END")
    return one.join(n, "item_id").select("item_id", "width", "n", hashed.alias("hash"), "shingle")


def sketches(shingles: DataFrame, percent: int) -> DataFrame:
    """The least min-hash values of every item, as many as its size class needs."""
    top = F.expr("cast(pow(2, floor(log2(n)) + 1) - 1 as long)")  # largest size of the class
    may_miss = top - F.ceil(top * percent / 100.0)
    keep = F.least(F.col("n"), may_miss + 1)
    ranked = shingles.groupBy("item_id", "n").agg(F.sort_array(F.collect_list(F.struct(
        F.xxhash64("hash").alias("minhash"), "width", "hash", "shingle"))).alias("s"))
    return ranked.select("item_id", F.explode(F.slice("s", F.lit(1), keep.cast("int"))).alias("v")).select(
        "item_id", "v.width", "v.hash", "v.shingle")


def _meets(docs: DataFrame, keep: list[str], wanted: DataFrame, widths: list[int]) -> DataFrame:
    """(keep..., item_id, hash) for document windows that equal a wanted shingle word by word."""
    out = None
    for w in widths:
        # the outer form: for the inner one the optimizer infers a filter on the array and computes it again
        windows = docs.select(*keep, "words", F.posexplode_outer(_windows("hashes", w)).alias("pos", "hash"))
        hit = windows.join(wanted.where(F.col("width") == w).drop("width"), "hash").where(
            F.slice("words", F.col("pos") + 1, F.lit(w)) == F.col("shingle")).select(*keep, "item_id", "hash")
        out = hit if out is None else out.unionByName(hit)
    return out


def contained_items(docs: DataFrame, items: DataFrame, percent: int = 75, width: int = 5, id_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                    broadcast_rows: int = 50_000) -> DataFrame:
    """(doc_id, text_key, item_id, matched, n, containment): every item of which a document's
    text holds at least ``percent`` of the distinct shingles.

    Words are lower-cased and cut at ASCII blanks. text_key is a hash of the document's
    text: a row is named by its id and its text, so rows with equal ids but other texts are
    told apart and repeated rows give one result. Null and blank texts and items match
    nothing; null ids are kept as they are; empty tables give an empty result. Only the
    named columns are read. Item shingles are broadcast up to ``broadcast_rows`` rows,
    beyond that the joins shuffle by shingle hash.
    """
    shingles = written(item_shingles(items, width, item_col, item_text_col), "items")
    widths = sorted(r[0] for r in shingles.select("width").distinct().collect())  # at most `width` values
    if not widths:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, text_key long, item_id long, matched long, n long, containment double")
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    keys = ["doc_id", "text_key"]
    keyed = base.where(F.col("text").isNotNull()).withColumn("text_key", text_hash("text"))
    sketch = small_side(sketches(shingles, percent), broadcast_rows)
    met = _meets(_hashed(keyed, "text", keys), keys, sketch, widths)
    candidates = written(met.select(*keys, "item_id").distinct(), "candidates")
    named = candidates.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).distinct()
    again = keyed.join(small_side(named, 1_000_000), F.col("doc_id").eqNullSafe(F.col("d"))
                       & (F.col("text_key") == F.col("k")), "left_semi")
    exact = _meets(_hashed(again, "text", keys), keys, small_side(
        shingles.select("item_id", "width", "hash", "shingle"), broadcast_rows), widths)
    # one row per shingle found, then its count; both steps combine before they shuffle
    matched = exact.distinct().groupBy(*keys, "item_id").agg(F.count("*").alias("matched"))
    sizes = small_side(shingles.select("item_id", "n").distinct(), 1_000_000)
    wanted = candidates.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), F.col("item_id").alias("i"))
    verified = matched.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
                            & F.col("item_id").eqNullSafe(F.col("i")), "left_semi")
    return (verified.join(sizes, "item_id").where(F.col("matched") * 100 >= F.col("n") * percent)
            .select(*keys, "item_id", "matched", "n", (F.col("matched") / F.col("n")).alias("containment")))


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = 75, width: int = 5, id_col: str = "doc_id",
                  text_col: str = "text", **names) -> DataFrame:
    """``docs`` without the rows whose text holds an item (see ``contained_items``).

    All columns come back as they were; a name equal to a helper's is no problem. Rows with
    null or blank text stay.
    """
    hit = contained_items(docs, items, percent, width, id_col, text_col, **names)
    gone = small_side(hit.select(F.col("doc_id").alias("__gone_id"), F.col("text_key").alias("__gone_key")).distinct(),
                      1_000_000)
    return docs.join(gone, docs[id_col].eqNullSafe(gone["__gone_id"]) & (text_hash(docs[text_col]) == gone["__gone_key"]),
                     "left_anti")
