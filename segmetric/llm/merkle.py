"""Merkle manifest of a dataset as postorder append logs.

Every source's rows, in order of their id, are the leaves of a hash tree in which runs of
``FAN`` consecutive nodes become their hash; the sources' roots are the leaves of one more
tree. Trees are built in tiers by aligned builders: a builder takes a block of FAN ** DEPTH
consecutive nodes of a tier, hashes the subtree above them and writes all its nodes in
completion order (postorder), so a tier's log is its builders' segments one after another.
The last node of a segment is the subtree's top and a leaf of the next tier.

Where a node stands in a log follows from subtree sizes alone (``postorder``), so the
siblings of a proof are addressed in the segments without any search, and a builder never
waits for another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmetric.llm.common import written
from segmetric.operators.ordered import group_rank

#: Nodes of a run, and levels that one builder adds: a segment holds at most
#: (3 ** 7 - 1) / 2 = 1,093 digests.
FAN = 3
DEPTH = 6
_BLOCK = FAN ** DEPTH


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return sha256(F.concat(*[field(v) for v in values]))


def _up(n: Column, by: int) -> Column:
    return F.call_function("div", n + F.lit(by - 1), F.lit(by))


def _down(n: Column, by: int) -> Column:
    return F.call_function("div", n, F.lit(by))


def height(leaves: Column) -> Column:
    """Levels above ``leaves`` leaves until one node remains (0 for a lone leaf)."""
    powers = F.array(*[F.lit(FAN ** k) for k in range(39)])
    return F.size(F.filter(powers, lambda p: p < leaves))


def postorder(level: Column, index: Column, leaves: Column, levels: Column) -> Column:
    """Place (from 0) of the node ``index`` of ``level`` in the log of a subtree with that many
    leaves and levels. Complete before it are, of its own level and below, the nodes over the
    leaves up to its last one, and of the levels above, those that end before its first leaf."""
    width = F.element_at(F.array(*[F.lit(FAN ** k) for k in range(DEPTH + 1)]), level + 1)
    first = index * width
    end = F.least(first + width, leaves)
    at = F.lit(-1)
    for k in range(DEPTH + 1):
        at = at + F.when(F.lit(k) <= level, _up(end, FAN ** k)).when(F.lit(k) <= levels, _down(first, FAN ** k)).otherwise(0)
    return at


def _steps(levels: Column) -> Column:
    """0 .. levels - 1 as an array."""
    return F.slice(F.array(*[F.lit(k) for k in range(DEPTH)]), F.lit(1), levels)


def _segment(children: Column, levels: Column) -> Column:
    """All nodes of the subtree over an array of digests, in completion order."""
    def above(rows: Column, step: Column) -> Column:
        below = F.element_at(rows, step + 1)
        runs = F.sequence(F.lit(0), _up(F.size(below), FAN) - 1)
        return F.concat(rows, F.array(F.transform(
            runs, lambda r: sha256(F.array_join(F.slice(below, r * FAN + 1, FAN), "")))))

    rows = F.aggregate(_steps(levels), F.array(children), above)
    placed = F.flatten(F.transform(rows, lambda nodes, level: F.transform(nodes, lambda digest, index: F.struct(
        postorder(level, index, F.size(children), levels).alias("at"), digest.alias("digest")))))
    return F.transform(F.sort_array(placed), lambda x: x["digest"])


def _sibling_path(log: Column, child: Column, leaves: Column, levels: Column) -> Column:
    """Per level the joined digests of the siblings before and after the node on the way up
    from ``child``: array of (before, after). The siblings are read at their places in the log."""
    def level(step: Column) -> Column:
        width = F.element_at(F.array(*[F.lit(FAN ** k) for k in range(DEPTH + 1)]), step + 1)
        own = F.call_function("div", child, width)
        run = own - own % FAN
        there = F.call_function("div", leaves + width - 1, width)
        of_run = F.transform(F.array(*[F.lit(k) for k in range(FAN)]), lambda k: run + k)

        def joined(keep) -> Column:
            return F.array_join(F.transform(F.filter(of_run, keep), lambda i: F.element_at(
                log, (postorder(step, i, leaves, levels) + 1).cast("int"))), "")

        return F.struct(joined(lambda i: i < own).alias("before"), joined(lambda i: (i > own) & (i < there)).alias("after"))

    return F.transform(_steps(levels), level)


def append_log(leaves: DataFrame, label: str) -> list[DataFrame]:
    """Logs of all tiers over ``leaves`` (tree, idx, digest, nodes and further columns in the
    struct ``rest``; idx gapless from 0, nodes = leaves of the tree).

    One written table a tier: tree, block, nodes (of the tier), levels, log (digests in
    completion order), rest (of its leaves in order). A tier for each DEPTH levels.
    """
    tiers = []
    now = leaves
    while True:
        block = F.call_function("div", F.col("idx"), F.lit(_BLOCK)).alias("block")
        held = now.groupBy("tree", block).agg(
            F.first("nodes").alias("nodes"),
            F.sort_array(F.collect_list(F.struct("idx", "digest", "rest"))).alias("held"))
        levels = F.least(height(F.col("nodes")), F.lit(DEPTH)).cast("int")
        # a block of at most FAN ** DEPTH nodes: bounded however large the tree
        now = written(held.select("tree", "block", "nodes", levels.alias("levels"),
                                  _segment(F.col("held.digest"), levels).alias("log"), F.col("held.rest").alias("rest")),
                      f"{label}{len(tiers)}")
        tiers.append(now)
        unfinished = now.where(F.col("nodes") > _BLOCK)
        if unfinished.isEmpty():
            return tiers
        now = unfinished.select("tree", F.col("block").alias("idx"), F.element_at("log", -1).alias("digest"),
                                _up(F.col("nodes"), _BLOCK).alias("nodes"), F.lit(0).alias("rest"))


def tree_roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, root): the last node of the log of the tier in which the tree ends."""
    ends = [t.where(F.col("nodes") <= _BLOCK).select("tree", F.element_at("log", -1).alias("root")) for t in tiers]
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return out


def leaf_paths(tiers: list[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """(tree, idx, digest, rest, path) of every leaf; path goes up to the tree's root, then on
    with that of ``above`` (tree, path). Upper tiers first, so a join meets one row a block."""
    def expand(tier: DataFrame, upper: DataFrame | None, deepest: bool) -> DataFrame:
        rows = tier.withColumn("leaves", F.size("rest"))
        if upper is not None:
            rows = rows.join(upper, ["tree", "block"], "left")
        own = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("leaves") - 1)).alias("child"))
        path = _sibling_path(F.col("log"), F.col("child"), F.col("leaves"), F.col("levels"))
        if upper is not None:
            path = F.concat(path, F.coalesce(F.col("upper"), F.array().cast(_PATH)))
        cols = ["tree", (F.col("block") * _BLOCK + F.col("child")).alias("idx"), path.alias("path")]
        if deepest:
            place = (postorder(F.lit(0), F.col("child"), F.col("leaves"), F.col("levels")) + 1).cast("int")
            cols += [F.element_at("log", place).alias("digest"), F.element_at("rest", (F.col("child") + 1).cast("int")).alias("rest")]
        return own.select(*cols)

    upper = None
    for k in range(len(tiers) - 1, -1, -1):
        found = expand(tiers[k], upper, k == 0)
        if k:
            upper = found.select("tree", F.col("idx").alias("block"), F.col("path").alias("upper"))
    if above is not None:
        found = found.join(above.select("tree", F.col("path").alias("__above")), "tree").withColumn(
            "path", F.concat("path", "__above")).drop("__above")
    return found


_PATH = "array<struct<before:string,after:string>>"


def fold(path: Column, leaf: Column) -> Column:
    """Root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda acc, s: sha256(F.concat(s["before"], acc, s["after"])))


def proof_digest(path: Column) -> Column:
    return sha256(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def merkle_manifest(docs: DataFrame, columns: list[str], tree_col: str, id_col: str, altered: Column) -> DataFrame:
    """(id, leaf, subroot, root, path, altered_leaf) of every row of ``docs``.

    ``columns`` are hashed in their order into the leaf; ``altered`` is the leaf hash of the row
    as someone else sees it. Each value of ``tree_col`` (null is one, and comes first) has a
    tree of its own, whose leaves ascend by ``id_col``: null ids first, rows with equal ids by
    their leaf hash; equal rows are interchangeable, each is a leaf. Null and empty values
    differ (``-`` against ``0:``). A lone leaf is its tree's root. An empty table gives an
    empty result. Only the named columns are read, so others may have any names; whole texts
    are hashed, however long.
    """
    tree = F.coalesce(F.concat(F.lit("1"), F.col(f"`{tree_col}`").cast("string")), F.lit("0"))
    leaves = written(docs.select(
        tree.alias("tree"), F.col(f"`{id_col}`").alias("id"), leaf_hash([F.col(f"`{c}`") for c in columns]).alias("digest"),
        altered.alias("altered"), F.monotonically_increasing_id().alias("line")), "leaves")
    # ``line`` only keeps many equal rows from meeting in one range
    order = [F.coalesce(F.col("id"), F.lit(-(1 << 63))), F.col("id").isNotNull(), "digest", "line"]
    ranked = group_rank(leaves, ["tree"], order, rank_col="idx")
    sizes = leaves.groupBy("tree").agg(F.count("*").alias("nodes"))
    placed = ranked.join(sizes, "tree").select("tree", "idx", "digest", "nodes", F.struct("id", "altered").alias("rest"))
    tiers = append_log(placed, "log")
    subroots = tree_roots(tiers)
    top = group_rank(subroots.withColumn("all", F.lit(0)), ["all"], ["tree"], rank_col="idx")
    width = subroots.agg(F.count("*").alias("nodes"))
    root_tiers = append_log(
        top.join(width.withColumn("all", F.lit(0)), "all").select(
            F.lit("all").alias("tree"), "idx", F.col("root").alias("digest"), "nodes", F.struct("tree").alias("rest")), "roots")
    root = tree_roots(root_tiers).select(F.col("tree").alias("whole"), "root")
    above = leaf_paths(root_tiers).join(root, F.col("tree") == F.col("whole")).select(
        F.col("rest.tree").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    above = written(above, "above")
    found = leaf_paths(tiers, above).join(above.select("tree", "subroot", "root"), "tree")
    return found.select(F.col("rest.id").alias("id"), F.col("digest").alias("leaf"), "subroot", "root", "path",
                        F.col("rest.altered").alias("altered_leaf"))


def verified_manifest(docs: DataFrame, columns: list[str], tree_col: str, id_col: str, altered: Column) -> DataFrame:
    """``merkle_manifest`` with proof_sha256 (hash of the siblings, level by level, left to
    right), folded_root (from the altered leaf) and verified (it is the root)."""
    m = merkle_manifest(docs, columns, tree_col, id_col, altered)
    return (m.select("id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                     fold(F.col("path"), F.col("altered_leaf")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
