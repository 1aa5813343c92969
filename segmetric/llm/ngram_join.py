"""N-gram Jaccard join by prefix trees.

Documents with equal shingle sets form a class; one set stands for it. Links between
sets (Jaccard similarity at or above the threshold) are found in these steps.

1. Every shingle has a place in one global order: first the shingles of a fixed hash
   range by the number of sets that hold them, then the others by hash. Two linked sets
   share a shingle among the first ``n - required + 1`` of each. Shingles that one set
   alone holds can't be that one, so most sets leave here, without any pair made.
2. The sets that remain are stored in prefix trees, one for each bucket of sets that
   share a prefix shingle (split into blocks of bounded size). A walk down the tree
   carries the overlap of all searching sets at once, shared by everything below a
   node, and drops a search where the remaining lengths can't reach the required overlap.
3. Sets linked so far get a common label. In buckets that still hold several labels,
   each set outside the bucket's most common label searches the trees of the others,
   so no link between different labels is missed.
4. Labels are joined into components.

The result doesn't depend on which shingles are counted or how blocks are cut: the order
only decides how many sets meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmetric.llm.common import discard, small_side, text_hash, written
from segmetric.llm.components import components
from segmetric.llm.wordhash import batched_word_hashes, distinct_sorted, mix, shingle_hashes

#: Shingles whose hash lies below this share of the range are counted and come first.
COUNTED_SHARE = 0.4
#: Shingles of a tree's sets together; a bucket with more is split into blocks, by size of
#: the sets first (classes of this ratio), then by hash.
BLOCK_SHINGLES = 80_000
SIZE_RATIO = 1.15
#: Buckets that each set enters in step 2: its largest one, which most sets of a group share,
#: so few trees hold a group, then some by hash.
HOMES = 2
#: Searching sets that meet one tree at a time in step 3.
SEARCHES = 128

#: Texts or sets of one Arrow batch.
BATCH_ROWS = 1_000

_SIGNED = np.int64


def _required(n: np.ndarray | int, m: np.ndarray | int, percent: int):
    """Least overlap of sets of n and m shingles whose Jaccard similarity reaches percent."""
    return -(-(percent * (n + m)) // (100 + percent))


def _prefix_length(n: int, percent: int) -> int:
    return n - (-(-percent * n // 100)) + 1


def _shingle_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, 512):  # few texts at a time as Python objects
            batch = whole.slice(at, 512)
            texts = batch.column("text").to_pylist()
            raw = [t.encode("utf-8", "surrogatepass") if t is not None else None for t in texts]
            for i, words in batched_word_hashes(raw):
                yield batch, i, distinct_sorted(shingle_hashes(words, width))


def _signature(sorted_set: np.ndarray) -> int:
    """64-bit hash of a set, from its sum and size."""
    total = mix(sorted_set).sum(dtype=np.uint64, keepdims=True)
    total += np.array([len(sorted_set)], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return int(mix(total).view(_SIGNED)[0])


class _Rows:
    """Collects rows of scalars and one array column, and gives Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, most: int = 1 << 19):
        self.schema, self.most = schema, most
        self._reset()

    def _reset(self) -> None:
        self.rows: list[tuple] = []
        self.arrays: list[np.ndarray | None] = []
        self.held = 0

    def add(self, row: tuple, array: np.ndarray | None) -> bool:
        self.rows.append(row)
        self.arrays.append(array)
        self.held += 8 + (0 if array is None else len(array))
        return self.held >= self.most

    def batch(self) -> pa.RecordBatch:
        scalars = list(zip(*self.rows)) if self.rows else [()] * (len(self.schema) - 1)
        columns = [pa.array(c, type=f.type) for c, f in zip(scalars, self.schema)]
        lengths = [0 if a is None else len(a) for a in self.arrays]
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        full = [a.view(_SIGNED) for a in self.arrays if a is not None and len(a)]
        values = pa.array(np.concatenate(full) if full else np.empty(0, dtype=_SIGNED))
        columns.append(pa.ListArray.from_arrays(pa.array(offsets), values))
        out = pa.RecordBatch.from_arrays(columns, schema=self.schema)
        self._reset()
        return out


def _order_class(sorted_set: np.ndarray) -> int:
    """How many shingles of a sorted set lie in the counted range."""
    return int(np.searchsorted(sorted_set, np.uint64(int(COUNTED_SHARE * 2.0 ** 64))))


def _emit_sets(width: int, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("sig", pa.int64()), ("n", pa.int64()),
                        ("given", pa.int64()), ("toks", pa.list_(pa.int64()))])

    def run(batches):
        seen: set[int] = set()  # sets this task has given: some 60 bytes for each row of a partition
        rows = _Rows(schema)
        for batch, i, sh in _shingle_sets(batches, width):
            row = batch.column("doc_id")[i].as_py(), batch.column("text_key")[i].as_py()
            if not len(sh):
                if rows.add((*row, None, 0, 0), None):
                    yield rows.batch()
                continue
            sig = _signature(sh)
            given = max(_order_class(sh), min(len(sh), _prefix_length(len(sh), percent)))
            toks = None if sig in seen else sh[:given]
            seen.add(sig)
            if rows.add((*row, sig, len(sh), given), toks):
                yield rows.batch()
        yield rows.batch()

    return run


def _emit_full(width: int):
    schema = pa.schema([("sig", pa.int64()), *[(f"b{k}", pa.int64()) for k in range(HOMES)], ("toks", pa.list_(pa.int64()))])

    def run(batches):
        rows = _Rows(schema)
        seen: set[int] = set()
        for batch, i, sh in _shingle_sets(batches, width):
            sig = _signature(sh) if len(sh) else None
            if sig is None or sig in seen or sig != batch.column("sig")[i].as_py():
                continue
            seen.add(sig)
            if rows.add((sig, *[batch.column(f"b{k}")[i].as_py() for k in range(HOMES)]), sh):
                yield rows.batch()
        yield rows.batch()

    return run


# ---------------------------------------------------------------- the tree
class PrefixTree:
    """Sets of shingles as paths of a compressed prefix tree.

    Shingles are ordered by how many of the block's sets hold them, most first, so sets
    that overlap share long paths. Shingles that only one of the block's sets (stored or
    searching) holds can't count for an overlap: only their number is kept.
    """

    def __init__(self, sets: list[np.ndarray], stored: np.ndarray):
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        kept = int((count > 1).sum())
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        ranks = rank[code]
        shared = ranks < kept
        ranks, owner = ranks[shared], owner[shared]
        by = np.lexsort((ranks, owner))
        steps, cuts = ranks[by], np.searchsorted(owner[by], np.arange(len(sets) + 1))
        self.paths = [steps[cuts[i]:cuts[i + 1]] for i in range(len(sets))]  # views of one array
        by = np.argsort(ranks, kind="stable")
        self.owners, self.starts = owner[by], np.searchsorted(ranks[by], np.arange(kept + 1))
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.after = np.diff(cuts)  # shared shingles of each set
        self.count = np.zeros(len(sets), dtype=np.int64)
        self.stored = sorted(np.flatnonzero(stored).tolist(), key=lambda i: self.paths[i].tolist())

    def holding(self, steps: np.ndarray, among: np.ndarray) -> np.ndarray:
        """How many of the path steps each of the sets ``among`` holds, from the steps' postings."""
        held = [self.owners[self.starts[r]:self.starts[r + 1]] for r in steps.tolist()]
        for h in held:
            self.count[h] += 1
        got = self.count[among]
        for h in held:
            self.count[h] = 0
        return got

    def search(self, probes: np.ndarray, percent: int, visit) -> None:
        """Calls visit(stored set, probes that reach the percentage) for every stored set.

        A node's overlaps hold for all sets below it; a probe goes on below a node only
        if overlap + least of what it and the subtree have left reaches what the
        subtree's smallest set requires.
        """
        # entries: stored sets [lo, hi) that share `depth` path steps; probes still alive; their overlaps, their steps left
        stack = [(0, len(self.stored), 0, probes, np.zeros(len(probes), dtype=np.int64), self.after[probes])]
        while stack:
            lo, hi, depth, alive, overlap, left = stack.pop()
            group = self.stored[lo:hi]
            first, last = self.paths[group[0]], self.paths[group[-1]]
            limit = min(len(first), len(last))
            same = first[depth:limit] != last[depth:limit]
            to = depth + (int(np.argmax(same)) if same.any() else limit - depth)
            if to > depth:
                step = self.holding(first[depth:to], alive)
                overlap = overlap + step
                left = left - step
            least = int(self.size[group].min())
            longest = max(len(self.paths[i]) for i in group) - to
            able = overlap + np.minimum(left, longest) >= _required(self.size[alive], least, percent)
            if not able.any():
                continue
            alive, overlap, left = alive[able], overlap[able], left[able]
            at = lo
            while at < hi and len(self.paths[self.stored[at]]) == to:  # sets that end here
                i = self.stored[at]
                good = overlap >= _required(self.size[alive], self.size[i], percent)
                if good.any():
                    visit(i, alive[good])
                at += 1
            while at < hi:  # one child for each next step
                step = self.paths[self.stored[at]][to]
                end = at
                while end < hi and self.paths[self.stored[end]][to] == step:
                    end += 1
                stack.append((at, end, to, alive, overlap, left))
                at = end


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[dict[str, list]]:
    """Runs of rows with equal key from batches sorted by it."""
    held: dict[str, list] = {}
    now = None
    for batch in batches:
        keys = batch.column(key).to_pylist()
        cols = {}
        for name in batch.schema.names:
            c = batch.column(name)
            if pa.types.is_list(c.type):
                off = c.offsets.to_numpy()
                val = c.values.to_numpy(zero_copy_only=False)
                cols[name] = [val[off[i]:off[i + 1]] for i in range(len(c))]
            else:
                cols[name] = c.to_pylist()
        for i, k in enumerate(keys):
            if k != now and held:
                yield held
                held = {}
            if not held:
                held = {name: [] for name in cols}
                now = k
            for name, v in cols.items():
                held[name].append(v[i].copy() if isinstance(v[i], np.ndarray) else v[i])
    if held:
        yield held


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _within(percent: int):
    """Step 2: links of a block's sets among themselves, as a spanning forest."""

    def run(batches):
        for g in _groups(batches, "block"):
            sigs = g["sig"]
            once = [i for i, s in enumerate(sigs) if s not in sigs[:i]] if len(sigs) < 50 else list(
                dict(zip(reversed(sigs), reversed(range(len(sigs))))).values())
            if len(once) < 2:
                continue
            sets = [g["toks"][i] for i in once]
            parent = list(range(len(once)))
            a, b = [], []

            def visit(i, near, parent=parent, a=a, b=b, once=once, sigs=sigs):
                for j in near.tolist():
                    x, y = _find(parent, i), _find(parent, j)
                    if x != y:
                        parent[max(x, y)] = min(x, y)
                        a.append(sigs[once[i]])
                        b.append(sigs[once[j]])

            tree = PrefixTree(sets, np.ones(len(sets), dtype=bool))
            tree.search(np.arange(len(sets)), percent, visit)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_LINKS)

    return run


def _across(percent: int):
    """Step 3: links from searching sets to stored sets of another label, one for each label."""

    def run(batches):
        for g in _groups(batches, "block"):
            role, label, sigs = g["role"], g["label"], g["sig"]
            stored = np.array([r == 0 for r in role])
            if stored.all() or not stored.any():
                continue
            found: dict[tuple[int, int], int] = {}

            def visit(i, near, found=found, label=label, sigs=sigs):
                for j in near.tolist():
                    if label[i] != label[j]:
                        found.setdefault((sigs[j], label[i]), sigs[i])

            tree = PrefixTree(g["toks"], stored)
            tree.search(np.flatnonzero(~stored), percent, visit)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.int64()),
                                                  pa.array(list(found.values()), pa.int64())], schema=_LINKS)

    return run


# ---------------------------------------------------------------- the job
def ngram_jaccard_join(docs: DataFrame, percent: int = 75, width: int = 5, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id, text_key, kept) for every row of ``docs``.

    Words are lower-cased (A-Z) and cut at ASCII blanks; a text's set holds its distinct
    ``width``-word windows, or its whole word sequence where that is shorter. Two sets
    link when 100 * |intersection| >= percent * |union|. class_id is the smallest id with
    the same set, component_id the smallest id that links lead to.

    Null texts and texts without words have an empty set, link with nothing and keep
    their own id. kept marks the first row of each group by (doc_id, text_key), null ids last; text_key
    is ``common.text_hash`` of the text, so repeated rows are all kept or all not. Rows without
    words are kept. Rows with equal ids are separate rows; null ids stay null unless links
    lead to a smaller one. An empty table gives an empty result. Columns other than the
    two named are never read, so their names can't clash.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie in 50..100")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("text_key"),
                       F.col(text_col).alias("text"))
    sets = written(base.mapInArrow(_emit_sets(width, percent),
                                   "doc_id long, text_key long, sig long, n long, given long, toks array<long>"),
                   "sets", BATCH_ROWS)
    # one row of each set: the text is read again by the row's id
    reps = (sets.where(F.col("sig").isNotNull()).groupBy("sig")
            .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("given").alias("given")))

    # step 1: shingles of several sets, with their counts, at the sets that hold them
    # the null checks that later joins imply stand here, so both readers share one exchange
    rows = (sets.where(F.col("toks").isNotNull() & F.col("sig").isNotNull()).select("sig", F.explode("toks").alias("tok"))
            .where(F.col("tok").isNotNull()).repartition("tok"))
    several = (rows.groupBy("tok").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi"), F.count("*").alias("df"))
               .where(F.col("lo") != F.col("hi")).select("tok", "df"))
    held = rows.join(several.hint("shuffle_hash"), "tok")
    cut = int(COUNTED_SHARE * 2.0 ** 64)
    border = F.lit(cut if cut < 1 << 63 else cut - (1 << 64))
    # signed view of the unsigned hash: the counted range is [0, cut) for cut below 2**63
    late = (~F.col("tok").between(F.lit(0), border - F.lit(1))).cast("int") if cut < 1 << 63 else (
        F.col("tok").between(border, F.lit(-1))).cast("int")
    # tok < 0 first: the tasks gave the first shingles in unsigned order, and positions must follow the same one
    place = F.struct(late.alias("late"), F.when(late == 1, 0).otherwise(F.col("df")).alias("df"),
                     (F.col("tok") < 0).alias("high"), F.col("tok"))
    mine = held.groupBy("sig").agg(F.sort_array(F.collect_set(place)).alias("shared"))
    required = F.expr(f"(n * {percent} + 99) div 100")
    open_places = F.col("n") - required + 1 - (F.col("given") - F.size("shared"))
    prefixes = written(
        mine.join(reps, "sig").withColumn("left", open_places).where("left > 0")
        # shingles before the shared ones; where uncounted shingles were given too, none is sure to be
        .select("sig", "rep", "n", F.when(F.col("given") > F.col("n") - required + 1, F.col("given") - F.size("shared"))
                .otherwise(0).alias("alone"),
                F.expr("transform(slice(shared, 1, cast(least(left, size(shared)) as int)), x -> x.tok)").alias("prefix")),
        "prefixes")
    ids = written(sets.select("doc_id", "text_key", "sig", "n"), "ids")
    row = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_key")
    reps = ids.where(F.col("sig").isNotNull()).groupBy("sig").agg(F.min("doc_id").alias("rep"), F.min(row).alias("first"))
    discard(sets)
    # rest: shingles of the set from this one on, in the global order
    postings = prefixes.select("sig", "n", "alone", F.posexplode("prefix").alias("pos", "tok")).select(
        "sig", "n", "tok", (F.col("n") - F.col("alone") - F.col("pos")).alias("rest"))
    bucket = postings.groupBy("tok").agg(F.count("*").alias("sets"), F.sum("n").alias("load")).where("sets > 1")

    # step 2: each set enters the trees of its largest bucket and of its least-hashed ones
    met = postings.join(bucket, "tok")
    homes = met.groupBy("sig").agg(
        F.first("n").alias("n"), F.max(F.struct("load", "tok")).alias("h0"),
        *[F.min(F.struct(F.xxhash64(F.col("tok"), F.lit(k)).alias("h"), "tok", "load")).alias(f"h{k}")
          for k in range(1, HOMES)])
    size_class = F.floor(F.log(F.col("n")) / F.log(F.lit(SIZE_RATIO)))

    def block(k: int):
        parts = F.ceil(F.col(f"h{k}.load") / F.lit(BLOCK_SHINGLES))
        part = F.when(parts == 1, 0).otherwise(F.pmod(F.xxhash64("sig", F.lit(k)), parts))
        return F.xxhash64(F.col(f"h{k}.tok"), F.when(parts == 1, -1).otherwise(size_class), part)

    placed = written(homes.join(prefixes.select("sig", "rep"), "sig").select(
        "sig", "rep", *[block(k).alias(f"b{k}") for k in range(HOMES)]), "placed")
    blocks = [f"b{k}" for k in range(HOMES)]
    texts = base.join(small_side(placed, 500_000), F.col("doc_id").eqNullSafe(F.col("rep")))
    full = written(texts.select("sig", *blocks, "text").mapInArrow(
        _emit_full(width), ", ".join(["sig long", *[f"{b} long" for b in blocks], "toks array<long>"])), "full", BATCH_ROWS)
    entered = full.select("sig", "toks", F.explode(F.array_distinct(F.array(*blocks))).alias("block"))
    links = written(entered.repartition("block").sortWithinPartitions("block", "sig")
                    .mapInArrow(_within(percent), "a long, b long"), "links", BATCH_ROWS)

    # step 3: buckets that still hold several labels
    labels = components(links)
    slim = written(placed.select("sig", F.col("b0").alias("block")).join(
        labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("label", F.coalesce("label", "sig")), "labelled")
    tagged = postings.join(slim, "sig")
    spread = (tagged.groupBy("tok", "label").agg(F.count("*").alias("c")).groupBy("tok")
              .agg(F.count("*").alias("labels"), F.max(F.struct("c", "label")).alias("most")).where("labels > 1"))
    still = written(tagged.join(spread.select("tok", F.col("most.label").alias("main")), "tok"), "open")
    trees = still.groupBy("tok", "block").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                              F.min("n").alias("n_lo"), F.max("n").alias("n_hi"),
                                              F.max("rest").alias("rest_hi"))
    # if this bucket's shingle is the first that two sets share, both rests must reach the required overlap
    need = F.expr(f"(({percent} * (n + greatest(n_lo, ({percent} * n + 99) div 100))) + {99 + percent}) div {100 + percent}")
    probes = (still.where(F.col("label") != F.col("main")).select("tok", "sig", "label", "n", "rest")
              .join(trees, "tok").where((F.col("lo") != F.col("label")) | (F.col("hi") != F.col("label")))
              .where((F.col("n_hi") * 100 >= F.col("n") * percent) & (F.col("n_lo") * percent <= F.col("n") * 100))
              .where((F.col("rest") >= need) & (F.col("rest_hi") >= need))
              .select("sig", "label", "block").distinct())
    probes = written(probes, "probes")
    if not probes.isEmpty():
        tree_parts = probes.groupBy("block").agg(F.ceil(F.count("*") / F.lit(SEARCHES)).alias("parts"))
        stored = slim.join(tree_parts, "block").select(
            "sig", "label", F.lit(0).alias("role"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "block")
        asking = probes.join(tree_parts, "block").select(
            "sig", "label", F.lit(1).alias("role"), F.pmod(F.xxhash64("sig"), F.col("parts")).alias("part"), "block")
        roles = written(stored.unionByName(asking).select("sig", "label", "role", F.xxhash64("block", "part").alias("block")),
                        "roles")
        meet = full.select("sig", "toks").join(small_side(roles, 500_000), "sig")
        more = written(meet.repartition("block").sortWithinPartitions("block", "role", "sig")
                       .mapInArrow(_across(percent), "a long, b long"), "more", BATCH_ROWS)
        labels = components(links.unionByName(more))

    # step 4
    named = reps.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "label", F.coalesce("label", "sig"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"), F.min("first").alias("group_first"))
    classes = named.join(least, "label").select("sig", F.col("rep").alias("class_id"), "component_id", "group_first")
    kept = F.col("sig").isNull() | row.eqNullSafe(F.col("group_first"))
    return (ids.join(classes, "sig", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"),
                    F.coalesce("component_id", "doc_id").alias("component_id"), "text_key", kept.alias("kept")))
