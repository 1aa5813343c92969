"""K-d tree sharding: nodes split at weighted medians along their widest dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmetric.llm.common import fresh, local_table, small_side, written

#: Bins of one pass of the median search.
BINS = 2048
#: The search ends when the bin that holds the median weighs at most this share of its node.
TOLERANCE = 0.0005
#: Rows of a slot bucket, about.
SLOT_ROWS = 50_000


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def _search_cuts(rows: DataFrame, nodes: dict[int, tuple[int, float]]) -> dict[int, tuple[int, int]]:
    """For nodes {node: (dimension, weight wanted below)} the cut (value, tie): a row lies below
    if its (value, tie) is smaller. ``rows`` has node, w, x (array of dimensions), tie.

    Every pass sums weights over BINS ranges of each node's interval (map-side combine, at
    most BINS rows a node), keeps the range in which the wanted weight falls and goes on in
    it; first on the dimension, then on the tie among rows of that value.
    """
    spark = rows.sparkSession
    dims = local_table(spark, [(n, d) for n, (d, _) in nodes.items()], "node int, d int")
    keyed = rows.join(F.broadcast(dims), "node").select("node", "w", F.expr("x[d]").alias("v"), "tie")
    ends = keyed.groupBy("node").agg(F.min("v"), F.max("v"), F.sum("w")).collect()
    state = {r[0]: {"lo": r[1], "hi": r[2], "below": 0, "x": None, "total": r[3]} for r in ends}
    cuts: dict[int, tuple[int, int]] = {}
    while state:
        spec = []
        for n, s in state.items():
            width = -(-(s["hi"] - s["lo"] + 1) // BINS)
            s["width"] = width
            spec.append((n, s["x"], s["lo"], s["hi"], width))
        now = local_table(spark, spec, "node int, at long, lo long, hi long, width long")
        key = F.when(F.col("at").isNull(), F.col("v")).otherwise(F.col("tie"))
        live = keyed.join(F.broadcast(now), "node").where(F.col("at").isNull() | (F.col("v") == F.col("at"))).where(
            key.between(F.col("lo"), F.col("hi")))
        sums = live.groupBy("node", F.expr("(CASE WHEN at IS NULL THEN v ELSE tie END - lo) div width").alias("bin")).agg(
            F.sum("w").alias("w"))
        got: dict[int, list[tuple[int, int]]] = {}
        for n, b, w in sums.collect():  # at most BINS rows for each node
            got.setdefault(n, []).append((b, w))
        for n in list(state):
            s, want = state[n], nodes[n][1]
            below, chosen = s["below"], None
            for b, w in sorted(got[n]):
                chosen = (b, w, below)
                if below + w > want:
                    break
                below += w
            b, w, below = chosen
            lo = s["lo"] + b * s["width"]
            hi = min(s["hi"], lo + s["width"] - 1)
            if below + w <= want:  # all of it fits below
                cuts[n] = (hi + 1, -1) if s["x"] is None else (s["x"], hi + 1)
            elif w <= TOLERANCE * s["total"] or (s["x"] is not None and lo == hi):
                edge = lo if want - below <= below + w - want else hi + 1
                cuts[n] = (edge, -1) if s["x"] is None else (s["x"], edge)
            elif lo == hi:  # one value: go on among its ties
                s.update(x=lo, lo=0, hi=(1 << 63) - 1 - BINS, below=below)
                continue
            else:
                s.update(lo=lo, hi=hi, below=below)
                continue
            del state[n]
    return cuts


def kd_tree(rows: DataFrame, shards: int, spans: list[int]) -> list[list[tuple[int, int, int, int, int, int]]]:
    """Levels of (node, dimension, value, tie, left, right). A node that is to hold s shards
    gives floor(s / 2) of them, and that share of its weight, to the left."""
    levels: list = []
    waiting = {0: shards}
    fresh_node = 1
    while any(s > 1 for s in waiting.values()):
        split = {n: s for n, s in waiting.items() if s > 1}
        at = assign_nodes(rows, levels)
        stats = at.groupBy("node").agg(F.sum("w").alias("w"), *[F.min(F.col("x")[i]) for i in range(len(spans))],
                                       *[F.max(F.col("x")[i]) for i in range(len(spans))]).collect()
        plan = {}
        for r in stats:
            if r[0] in split:
                width = [(r[2 + len(spans) + i] - r[2 + i]) / max(spans[i], 1) for i in range(len(spans))]
                plan[r[0]] = (max(range(len(spans)), key=lambda i: (width[i], -i)),
                              r[1] * (split[r[0]] // 2) / split[r[0]])
        cuts = _search_cuts(at, plan) if plan else {}
        level = []
        for n, s in split.items():
            left, right = fresh_node, fresh_node + 1
            fresh_node += 2
            d = plan[n][0] if n in plan else 0
            value, tie = cuts.get(n, (0, -1))
            level.append((n, d, value, tie, left, right))
            del waiting[n]
            waiting[left], waiting[right] = s // 2, s - s // 2
        levels.append(level)
    return levels


def assign_nodes(rows: DataFrame, levels: list) -> DataFrame:
    """``rows`` (x, tie, ...) with their node after the given levels; no shuffle."""
    spark = rows.sparkSession
    if not levels:
        return rows if "node" in rows.columns else rows.withColumn("node", F.lit(0))
    # the root is the only node of the first level: an expression, no join
    _, d, value, edge, left, right = levels[0][0]
    at = F.col("x")[d]
    first = (at < F.lit(value)) | ((at == F.lit(value)) & (F.col("tie") < F.lit(edge)))
    out = rows.withColumn("node", F.when(first, F.lit(left)).otherwise(F.lit(right)))
    for level in levels[1:]:
        cut = local_table(spark, level, "n int, d int, value long, edge long, l int, r int")
        below = F.expr("x[d] < value OR (x[d] = value AND tie < edge)")
        out = out.join(F.broadcast(cut), F.col("node") == F.col("n"), "left").withColumn(
            "node", F.when(F.col("n").isNull(), F.col("node")).when(below, F.col("l")).otherwise(F.col("r"))).drop(
            "n", "d", "value", "edge", "l", "r")
    return out


def _leaves(levels: list) -> dict[int, int]:
    """Shard number of each leaf, from left to right."""
    child = {row[0]: (row[4], row[5]) for level in levels for row in level}
    order: list[int] = []
    todo = [0]
    while todo:
        n = todo.pop()
        if n in child:
            todo += [child[n][1], child[n][0]]
        else:
            order.append(n)
    return {n: i for i, n in enumerate(order)}


def kd_shards(docs: DataFrame, shards: int | None = 8, target_bytes: int | None = None, id_col: str = "doc_id",
              text_col: str = "text", dims: list[Column] | None = None, slots: bool = False) -> DataFrame:
    """``docs`` with size (UTF-8 bytes of the text plus 1), text_crc32, shard and, with
    ``slots``, slot (gapless from 0 in each shard).

    A node splits at the median of its bytes along the dimension in which it is widest
    (against that dimension's whole span) until each leaf is one shard; with
    ``target_bytes`` as many shards are made as that size needs. ``dims`` are long columns
    of metadata; by default size, the language's code and the text's CRC-32. Rows of
    equal value are ordered by the text's CRC-32, then by a hash of the id, so equal texts
    share a shard unless a cut falls inside their group.

    Null texts count 1 byte, null dimensions 0. Repeated rows (equal id and text) stay
    together. Fewer rows than shards leave shards empty; an empty table gives no rows.
    Columns of ``docs`` named as the new ones are replaced. A dimension's values must lie
    within 62 bits of each other.
    """
    text = F.col(f"`{text_col}`")
    if dims is None:
        dims = [text_bytes(text), text_crc(text)]
        if "lang" in docs.columns:
            dims.insert(1, F.crc32(F.coalesce(F.col("lang"), F.lit("")).cast("binary")))
    point = F.array(*[F.coalesce(d.cast("long"), F.lit(0).cast("long")) for d in dims]).alias("x")
    tie = (text_crc(text) * F.lit(1 << 30) + F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(1 << 30))).alias("tie")
    # the root's number is stored with the points, so joins on it keep a key
    slim = written(docs.select(F.lit(0).alias("node"), text_bytes(text).alias("w"), point, tie), "points")
    ends = slim.agg(F.sum("w"), *[F.max(F.col("x")[i]) - F.min(F.col("x")[i]) for i in range(len(dims))]).first()
    if target_bytes:
        shards = max(1, -(-(ends[0] or 0) // target_bytes))
    levels = kd_tree(slim, shards, [s or 0 for s in ends[1:]]) if ends[0] else []
    leaf = local_table(docs.sparkSession, _leaves(levels).items(), "leaf int, shard_no int")
    new = ["size", "text_crc32", "shard", "slot"]
    kept = [c for c in docs.columns if c.lower() not in new]
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), text_bytes(text).alias("w"),
                      text_crc(text).alias("crc"), point, tie)
    placed = assign_nodes(row, levels).join(F.broadcast(leaf), F.col("node") == F.col("leaf")).select(
        *[F.col("doc").getField(c).alias(c) for c in kept], F.col("w").alias("size"), F.col("crc").alias("text_crc32"),
        F.col("shard_no").alias("shard"), "tie")
    if not slots:
        return placed.drop("tie")
    return _with_slots(placed, kept, slim.count(), id_col)


def _with_slots(placed: DataFrame, kept: list[str], rows: int, id_col: str) -> DataFrame:
    """Slots from counts per bucket of the tie and a rank inside the bucket, so no shard is
    ordered in one task. Columns of the documents travel with their row."""
    parts = max(1, rows // SLOT_ROWS)
    bucket = fresh([*kept, "tie"], "bucket")
    held = placed.withColumn(bucket, F.pmod(F.xxhash64("tie"), F.lit(parts)))
    count = held.groupBy("shard", bucket).agg(F.count("*").alias("c"))
    before = count.select("shard", bucket, (F.sum("c").over(Window.partitionBy("shard").orderBy(bucket)) - F.col("c"))
                          .alias("before"))
    before = small_side(before.select(F.col("shard").alias("s"), F.col(bucket).alias("b"), "before"), 1_000_000)
    order = [F.col("tie"), F.col(f"`{id_col}`"), F.col("size")]  # the tie holds 30 bits of the id's hash
    rank = F.row_number().over(Window.partitionBy("shard", bucket).orderBy(*order)) - 1
    ranked = held.withColumn("in_bucket", rank)
    return ranked.join(before, (F.col("shard") == F.col("s")) & (F.col(bucket) == F.col("b"))).select(
        *[F.col(f"`{c}`") for c in kept], "size", "text_crc32", "shard",
        (F.col("before") + F.col("in_bucket")).cast("long").alias("slot"))
