"""Histogram gradient boosting for a 0/1 label, many models at a time.

Features are cut into at most 256 bins. A tree grows from sums of gradient, hessian and rows by
(node, feature, bin); a cut's gain is GL^2/(HL + l2) + GR^2/(HR + l2) - G^2/(H + l2), a leaf's
value -rate * G/(H + l2). With a bound on leaves the node of the largest gain is cut first,
without one every node down to the depth limit. Gradients are rounded to 2^-26, so their
sums are whole numbers and no partitioning or order of rows changes a tree.

Models grow in step: a pass over the rows sums each task's rows by (model, node), the sums are
added by (model, node, feature) where the best cut is found too, and the driver receives that
cut alone. The rows' margins are a column that each finished tree updates. A table proven to
be small (``LOCAL_BYTES`` of bins) is broadcast and its models are dealt over the tasks
instead; sums, cuts and growth are the same functions, so the trees are the same.
Inputs hold no null or NaN features; constant features are never cut.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from copy import copy
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 256
SCALE = 2.0 ** 26
#: Bins and row columns that may be broadcast; larger tables are never gathered.
LOCAL_BYTES = 64 << 20
#: Trees between two checkpoints of the margins.
CHECKPOINT_EVERY = 10
NODE = np.dtype([("slot", "<i2"), ("bin", "<i2"), ("left", "<i2"), ("value", "<f8")])


@dataclass(frozen=True)
class BoostedModel:
    """``view``: column of bins read, its first ``size`` slots (None: all). Rows whose fold is
    ``held_out`` don't count. ``depth`` and ``leaves`` None: no limit."""

    view: str
    rounds: int = 100
    rate: float = 0.1
    depth: int | None = None
    leaves: int | None = 31
    least_rows: int = 20
    least_hessian: float = 1e-3
    l2: float = 0.0
    least_gain: float = 0.0
    subsample: float = 1.0
    colsample: float = 1.0
    balanced: bool = False
    held_out: int | None = None
    size: int | None = None
    seed: int = 42

    def __post_init__(self):
        if self.rounds < 1 or not self.rate > 0 or min(self.l2, self.least_gain, self.least_hessian) < 0 \
                or not 0 < self.subsample <= 1 or not 0 < self.colsample <= 1 \
                or self.depth is None and self.leaves is None or (self.leaves or 2) < 2 or (self.depth or 1) < 1:
            raise ValueError(f"settings out of range: {self}")


# ---------------------------------------------------------------- bins
def bin_edges(rows: DataFrame, views: dict[str, int | None], bins: int = BINS) -> dict[str, list[np.ndarray]]:
    """Upper edges of the bins of every slot of the array columns ``views`` (column: fold left out).
    A slot of at most ``bins`` different values is cut half-way between neighbours, others at
    approximate quantiles (relative rank error 1e-4)."""
    long = None
    for v, fold in views.items():
        part = rows if fold is None else rows.where(F.col("fold") != fold)
        part = part.select(F.lit(v).alias("view"), F.posexplode(v).alias("slot", "x"))
        long = part if long is None else long.unionByName(part)
    seen = long.distinct()
    few = seen.groupBy("view", "slot").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= bins)
    exact = seen.join(few, ["view", "slot"]).groupBy("view", "slot").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    at = [i / bins for i in range(1, bins)]
    cuts = long.join(few, ["view", "slot"], "left_anti").groupBy("view", "slot").agg(
        F.percentile_approx("x", at, 10000).alias("xs"))
    out: dict[str, dict[int, np.ndarray]] = {v: {} for v in views}
    for r in exact.collect():
        xs = np.asarray(r["xs"])
        out[r["view"]][r["slot"]] = (xs[1:] + xs[:-1]) / 2
    for r in cuts.collect():
        out[r["view"]][r["slot"]] = np.unique(np.asarray(r["xs"]))
    return {v: [e[s] for s in range(len(e))] for v, e in out.items()}


def binned(col: str, edges: list[np.ndarray]) -> F.Column:
    """The array column as one byte a slot: the number of edges below the value."""
    @F.pandas_udf("binary")
    def cut(xs: pd.Series) -> pd.Series:
        if not len(xs):
            return pd.Series([], dtype=object)
        x = np.stack(xs.to_numpy())
        found = np.empty(x.shape, dtype=np.uint8)
        for s, e in enumerate(edges):
            found[:, s] = np.searchsorted(e, x[:, s], side="left")
        return pd.Series([r.tobytes() for r in found])

    return cut(F.col(col))


def _matrix(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(len(values), -1)


# ---------------------------------------------------------------- sums, cuts, trees
def descend(tree: np.ndarray, bins: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """The lowest node that each row reaches, from the root or from where it stood before the tree grew."""
    left, slot, edge = (np.ascontiguousarray(tree[c], dtype=np.intp) for c in ("left", "slot", "bin"))
    at = np.zeros(len(bins), dtype=np.intp) if at is None else at
    flat, rows = bins.ravel(), np.arange(len(bins))
    while True:
        here = at[rows]
        inner = left[here] >= 0
        if not inner.all():
            rows, here = rows[inner], here[inner]
        if not len(rows):
            return at
        at[rows] = left[here] + (flat[rows * bins.shape[1] + slot[here]] > edge[here])


def _gradients(margin, y, weight) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
    return np.rint(weight * (p - y) * SCALE), np.rint(weight * p * (1 - p) * SCALE)


def _drawn(key: np.ndarray, model: BoostedModel, tree: int) -> np.ndarray:
    """Rows that a tree reads: a share of them by a hash of row, seed and tree."""
    if model.subsample >= 1:
        return np.ones(len(key), dtype=bool)
    z = key.astype(np.int64).view(np.uint64) + np.uint64((model.seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (z >> np.uint64(11)) / 2.0 ** 53 < model.subsample


class Packed:
    """Bins laid out for sums: a column a slot, and up to eight slots of no bin above 1 as one column of codes."""

    mine: np.ndarray | None = None

    def __init__(self, bins: np.ndarray):
        self.rows, self.width = bins.shape
        self.two = bins.max(axis=0, initial=0) <= 1
        few = np.flatnonzero(self.two)
        self.columns = [(np.array([s]), np.ascontiguousarray(bins[:, s])) for s in np.flatnonzero(~self.two)]
        for i in range(0, len(few), 8):
            codes = np.zeros(self.rows, np.uint8)
            for bit, s in enumerate(few[i:i + 8]):
                codes |= bins[:, s] << np.uint8(bit)
            self.columns.append((few[i:i + 8], codes))

    def of(self, mine: np.ndarray | None) -> "Packed":
        """The rows ``mine`` (None: all), gathered where they are summed."""
        if mine is None:
            return self
        out = copy(self)
        out.mine, out.rows = mine if self.mine is None else self.mine[mine], len(mine)
        return out


def partial_sums(bins: Packed, g: np.ndarray, h: np.ndarray, node: np.ndarray, ask: list[int],
                 slots: np.ndarray) -> np.ndarray:
    """Gradient, hessian and rows (first axis) by asked node, slot and bin: whole numbers, exact below
    2^53, that is for some 10^8 rows a task."""
    place = np.full(max(int(node.max(initial=0)), max(ask)) + 1, -1)
    place[ask] = np.arange(len(ask))
    if np.array_equal(place, np.arange(len(place))):  # every row's node is asked for
        return _cell_sums(bins, g, h, node, len(ask), slots)
    p = place[node]
    mine = np.flatnonzero(p >= 0)
    return _cell_sums(bins, g, h, p, len(ask), slots) if len(mine) == len(p) else \
        _cell_sums(bins.of(mine), g[mine], h[mine], p[mine], len(ask), slots)


def _cell_sums(bins: Packed, g, h, node, nodes: int, slots: np.ndarray) -> np.ndarray:
    """Sums of all rows by their nodes."""
    base = node * BINS if nodes > 1 else None
    size = nodes * BINS
    at = np.full(bins.width, -1)
    at[slots] = np.arange(len(slots))
    sums = np.zeros((3, nodes, len(slots), BINS))
    for of, column in bins.columns:
        if (at[of] < 0).all():
            continue
        cell = column if bins.mine is None else column[bins.mine]
        cell = cell.astype(np.intp) if base is None else base + cell
        found = np.stack([np.bincount(cell, g, size), np.bincount(cell, h, size), np.bincount(cell, minlength=size)])
        found = found.reshape(3, nodes, BINS)
        if not bins.two[of[0]]:
            sums[:, :, at[of[0]]] = found
            continue
        total = found.sum(axis=-1)
        for bit, s in enumerate(of):
            if at[s] >= 0:
                on = found[..., (np.arange(BINS) >> bit) & 1 == 1].sum(axis=-1)
                sums[:, :, at[s], 0], sums[:, :, at[s], 1] = total - on, on
    return sums


def best_cuts(sums: np.ndarray, m: BoostedModel, two: np.ndarray):
    """``best_bins`` of (3, node, slot, bin); slots marked in ``two`` have no bin above 1 and are read so far only."""
    if not two.any() or two.all():
        return best_bins(sums[..., :2] if two.any() else sums, m)
    parts = [(np.flatnonzero(w), best_bins(sums[:, :, w, :n], m)) for w, n in ((two, 2), (~two, BINS))]
    out = []
    for c in range(4):
        whole = np.empty((*sums.shape[1:3], *parts[0][1][c].shape[2:]), parts[0][1][c].dtype)
        for w, found in parts:
            whole[:, w] = found[c]
        out.append(whole)
    return tuple(out)


def best_bins(sums: np.ndarray, m: BoostedModel) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best gain (0: no cut allowed), its bin, sums left of it and whole sums, for sums shaped (3, ..., bin)."""
    left = np.cumsum(sums, axis=-1, dtype=np.float64)
    whole = left[..., -1:]
    right = whole - left

    def strength(s):
        g, h = s[0] / SCALE, s[1] / SCALE
        return g * g / np.maximum(h + m.l2, 1e-12)

    gain = strength(left) + strength(right) - strength(whole)
    ok = np.minimum(left[2], right[2]) >= max(m.least_rows, 1)
    ok &= np.minimum(left[1], right[1]) >= m.least_hessian * SCALE
    ok &= gain > max(m.least_gain, 1e-12)
    gain *= ok
    at = gain.argmax(axis=-1)
    pick = np.take_along_axis(left, np.broadcast_to(at[..., None], (3, *at.shape, 1)), -1)[..., 0]
    return np.take_along_axis(gain, at[..., None], -1)[..., 0], at, np.moveaxis(pick, 0, -1), np.moveaxis(whole[..., 0], 0, -1)


class Grower:
    """One tree. ``ask`` names nodes whose best cuts it needs next; none: the tree is settled."""

    def __init__(self, model: BoostedModel, tree_no: int, width: int):
        self.model, self.slots = model, np.arange(width if model.size is None else min(model.size, width))
        if model.colsample < 1:
            n = max(1, int(model.colsample * len(self.slots)))
            self.slots = np.sort(np.random.default_rng((model.seed, tree_no)).choice(self.slots, n, replace=False))
        self.left, self.depth, self.sums, self.cut = [-1], [0], [None], [None]
        self.ask, self.inner = [0], set()

    def take(self, gain: np.ndarray, at: np.ndarray, left: np.ndarray, whole: np.ndarray) -> None:
        """Best cuts of the asked nodes by slot, in the order of ``ask`` and ``slots``."""
        for i, node in enumerate(self.ask):
            s = int(gain[i].argmax())
            self.sums[node] = whole[i, 0]
            self.cut[node] = (float(gain[i, s]), int(self.slots[s]), int(at[i, s]), left[i, s])
        self._plan()

    def _closed(self, node: int) -> bool:
        m = self.model
        return m.depth is not None and self.depth[node] >= m.depth or self.sums[node][2] < 2 * max(m.least_rows, 1)

    def _plan(self) -> None:
        """Cuts known nodes in order of gain; children met without a known cut are asked for. When
        none is, the order was the true one."""
        ask, inner, leaves, limit = [], set(), 1, self.model.leaves or float("inf")
        heap = [(-self.cut[0][0], 0)] if self.cut[0][0] > 0 else []
        while heap and leaves < limit:
            node = heapq.heappop(heap)[1]
            inner.add(node)
            leaves += 1
            if self.left[node] < 0:
                self.left[node] = len(self.left)
                for sums in (self.cut[node][3], self.sums[node] - self.cut[node][3]):
                    self.left.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    self.sums.append(sums)
                    self.cut.append(None)
                    if self._closed(len(self.left) - 1):
                        self.cut[-1] = (0.0, 0, 0, None)
            for child in (self.left[node], self.left[node] + 1):
                if self.cut[child] is None:
                    if leaves < limit:
                        ask.append(child)
                elif self.cut[child][0] > 0:
                    heapq.heappush(heap, (-self.cut[child][0], child))
        self.ask, self.inner = ask, inner

    def siblings(self) -> list[tuple[int, int, int]]:
        """(parent, child of fewer rows, the other) of the asked nodes."""
        up = {c: i for i, l in enumerate(self.left) if l >= 0 for c in (l, l + 1)}
        out = {}
        for node in self.ask:
            if node:
                a = self.left[up[node]]
                out[a] = (up[node], a, a + 1) if self.sums[a][2] <= self.sums[a + 1][2] else (up[node], a + 1, a)
        return list(out.values())

    def array(self) -> np.ndarray:
        """All nodes tried so far, to place rows."""
        out = np.zeros(len(self.left), dtype=NODE)
        out["left"] = self.left
        for i in np.flatnonzero(out["left"] >= 0):
            out["slot"][i], out["bin"][i] = self.cut[i][1:3]
        return out

    def _value(self, node: int) -> float:
        s = self.sums[node]
        return -self.model.rate * (s[0] / SCALE) / max(s[1] / SCALE + self.model.l2, 1e-12)

    def values(self) -> dict[int, float]:
        """Values of the settled tree's leaves by node."""
        order = [0]
        for node in order:  # grows while it is read
            if node in self.inner:
                order += [self.left[node], self.left[node] + 1]
        return {node: self._value(node) for node in order if node not in self.inner}

    def tree(self) -> np.ndarray:
        """The settled tree."""
        rows, order = [], [0]
        for node in order:  # grows while it is read
            value = self._value(node)
            if node in self.inner:
                rows.append((*self.cut[node][1:3], len(order), value))
                order += [self.left[node], self.left[node] + 1]
            else:
                rows.append((0, 0, -1, value))
        return np.array(rows, dtype=NODE)


# ---------------------------------------------------------------- fits
@dataclass
class Fitted:
    model: BoostedModel
    start: float
    trees: list[np.ndarray]

    def margins(self, bins: np.ndarray, stages: list[int] | None = None) -> list[np.ndarray]:
        """Log-odds after each of the ``stages`` (numbers of trees; default: all)."""
        stages, total, out = stages or [len(self.trees)], np.full(len(bins), self.start), []
        for n, t in enumerate(self.trees, 1):
            total = total + t["value"][descend(t, bins)]
            if n in stages:
                out.append(total)
        return out


class _RowLists:
    """Rows of the nodes of a growing tree: a node's list is cut from its parent's when it is asked for. None: all rows."""

    def __init__(self, grower: Grower, columns: np.ndarray):
        self.grower, self.columns, self.known = grower, columns, {0: None}

    def of(self, nodes: list[int]) -> list[np.ndarray | None]:
        up = {c: i for i, left in enumerate(self.grower.left) if left >= 0 for c in (left, left + 1)}
        for node in nodes:
            path = []
            while node not in self.known:
                node = up[node]
                path.append(node)
            for parent in reversed(path):
                _, slot, edge, _ = self.grower.cut[parent]
                rows, left = self.known[parent], self.grower.left[parent]
                right = (self.columns[slot] if rows is None else self.columns[slot][rows]) > edge
                self.known[left], self.known[left + 1] = (np.flatnonzero(~right), np.flatnonzero(right)) if rows is None else \
                    (rows[~right], rows[right])
        return [self.known[n] for n in nodes]


def _fit_one(m: BoostedModel, start: float, weights: tuple[float, float], table: dict) -> list[np.ndarray]:
    keep = np.ones(len(table["label"]), dtype=bool) if m.held_out is None else table["fold"] != m.held_out
    bins, y, key = np.ascontiguousarray(table[m.view][:, :m.size][keep]), table["label"][keep], table["key"][keep]
    weight, margin, trees = np.where(y == 1, weights[1], weights[0]), np.full(len(y), start), []
    packed, columns = Packed(bins), np.ascontiguousarray(bins.T)
    for no in range(m.rounds):
        drawn = _drawn(key, m, no)
        every = bool(drawn.all())
        g, h = _gradients(margin[drawn], y[drawn], weight[drawn])
        mine, mine_columns = (packed, columns) if every else (Packed(bins[drawn]), columns[:, drawn])
        grower, known = Grower(m, no, bins.shape[1]), {}
        lists = _RowLists(grower, mine_columns)
        two = mine.two[grower.slots]
        while grower.ask:
            if grower.ask == [0]:
                known[0] = partial_sums(mine, g, h, np.zeros(len(g), np.intp), [0], grower.slots)[:, 0]
            else:
                # the larger child is what its sibling leaves of the parent: whole numbers, so exactly
                pairs = grower.siblings()
                rows = lists.of([a for _, a, _ in pairs])
                at, rows = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)
                small = partial_sums(mine.of(rows), g[rows], h[rows], at, list(range(len(pairs))), grower.slots)
                for i, (parent, a, b) in enumerate(pairs):
                    whole = known.pop(parent)
                    known[a], known[b] = small[:, i], whole - small[:, i]
            grower.take(*best_cuts(np.stack([known[n] for n in grower.ask], axis=1), m, two))
        trees.append(grower.tree())
        if every:
            values = grower.values()
            for rows, value in zip(lists.of(list(values)), values.values()):
                margin[slice(None) if rows is None else rows] += value
        else:
            margin = margin + trees[-1]["value"][descend(trees[-1], bins)]
    return trees


def _fit_dealt(rows: DataFrame, models: list[BoostedModel], starts, weights, views) -> list[list[np.ndarray]]:
    """A table of proven size: broadcast, one model a task, long ones first."""
    got = rows.select("key", "label", "fold", *views).toPandas()
    order = np.argsort(got["key"].to_numpy(), kind="stable")
    table = {c: got[c].to_numpy()[order] for c in ("key", "label", "fold")} | {v: _matrix(got[v])[order] for v in views}
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast(table)

    def cost(i):
        m = models[i]
        width = table[m.view].shape[1]
        return m.rounds * min(m.size or width, width) * min(m.depth or 64, (m.leaves or 1 << 16) - 1)

    def run(i):
        return i, [t.tobytes() for t in _fit_one(models[i], starts[i], weights[i], shared.value)]

    # the number of models bounds this list
    todo = sc.parallelize(sorted(range(len(models)), key=cost, reverse=True), len(models))
    out: list[list] = [[] for _ in models]
    for i, found in todo.map(run).collect():
        out[i] = [np.frombuffer(t, dtype=NODE) for t in found]
    shared.unpersist()
    return out


def _packed_rows(rows: DataFrame, views: list[str], starts):
    """RDD of blocks of rows: key, label, fold, margins, and the bins of every view with their ``Packed`` form."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"n": [len(pdf)], **{c: [pdf[c].to_numpy(np.int64).tobytes()] for c in ("key", "label", "fold")},
                                    **{v: [b"".join(pdf[v])] for v in views}})

    def block(r) -> dict:
        bins = {v: np.frombuffer(bytes(r[v]), np.uint8).reshape(r["n"], -1) for v in views}
        return {c: np.frombuffer(bytes(r[c]), np.int64) for c in ("key", "label", "fold")} | {
            "bins": bins, "packed": {v: Packed(x) for v, x in bins.items()}, "margins": np.tile(np.array(starts, float), (r["n"], 1))}

    columns = ["key", "label", "fold", *views]
    blocks = rows.mapInPandas(pack, ", ".join(["n int", *[f"{c} binary" for c in columns]])).rdd.map(block)
    most = 2 * rows.sparkSession.sparkContext.defaultParallelism  # the driver keeps records of every task of every pass
    return blocks.coalesce(most) if blocks.getNumPartitions() > most else blocks


def _drop_checkpoint(sc, path: str | None) -> None:
    if path:
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def _fit_in_step(rows: DataFrame, models: list[BoostedModel], starts, weights, widths) -> list[list[np.ndarray]]:
    """A table of any size: one pass over it for each level of the trees. The passes are RDD jobs: plans of SQL jobs,
    some thousand of them, would stay in the driver's memory. Of the checkpoints the last one is kept."""
    sc = rows.sparkSession.sparkContext
    state = _packed_rows(rows, list(widths), starts).persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[list] = [[] for _ in models]
    old, kept = [], None

    def sums_of(asked):
        def run(part):
            total: dict[int, np.ndarray] = {}
            for b in part:
                for i, m, no, ask, slots, so_far in asked:
                    keep = _drawn(b["key"], m, no)
                    if m.held_out is not None:
                        keep &= b["fold"] != m.held_out
                    at = descend(so_far, b["bins"][m.view])
                    at[~keep] = len(so_far)  # no node that is asked for
                    g, h = _gradients(b["margins"][:, i], b["label"], np.where(b["label"] == 1, weights[i][1], weights[i][0]))
                    found = partial_sums(b["packed"][m.view], g, h, at, ask, slots).astype(np.int64)
                    total[i] = total[i] + found if i in total else found
            for i, _, _, ask, slots, _ in asked:
                if i in total:
                    yield from (((i, n, int(s)), total[i][:, a, c]) for a, n in enumerate(ask) for c, s in enumerate(slots))
        return run

    for no in range(max(m.rounds for m in models)):
        growers = {i: Grower(m, no, widths[m.view]) for i, m in enumerate(models) if no < m.rounds}
        while asked := [(i, models[i], no, gr.ask, gr.slots, gr.array()) for i, gr in growers.items() if gr.ask]:
            cuts = dict(state.mapPartitions(sums_of(asked)).reduceByKey(np.add, sc.defaultParallelism).map(
                lambda r: (r[0], best_bins(r[1], models[r[0][0]]))).collect())
            for was, path in old:  # the rows were read once: no pass needs the state before
                was.unpersist()
                _drop_checkpoint(sc, path)
            old = []
            for i, _, _, ask, slots, _ in asked:
                if (i, ask[0], int(slots[0])) not in cuts:  # no rows at all
                    growers[i].take(*best_bins(np.zeros((3, len(ask), len(slots), BINS)), models[i]))
                    continue
                of = [[cuts[i, n, int(s)] for s in slots] for n in ask]
                growers[i].take(*[np.array([[r[c] for r in row] for row in of]) for c in range(4)])
        grown = {i: gr.tree() for i, gr in growers.items()}
        for i, t in grown.items():
            trees[i].append(t)

        def add(b: dict, grown=grown) -> dict:
            margins = b["margins"].copy()
            for i, t in grown.items():
                margins[:, i] += t["value"][descend(t, b["bins"][models[i].view])]
            return b | {"margins": margins}

        new = state.map(add).persist(StorageLevel.MEMORY_AND_DISK)
        if (no + 1) % CHECKPOINT_EVERY == 0:
            new.checkpoint()
            new.count()
            old.append((state, kept))
            kept = new.getCheckpointFile()
        else:
            old.append((state, None))
        state = new
    for was, path in [*old, (state, kept)]:
        was.unpersist()
        _drop_checkpoint(sc, path)
    return trees


def fit_boosted(rows: DataFrame, models: list[BoostedModel], local_bytes: int = LOCAL_BYTES) -> list[Fitted]:
    """``rows`` holds key (long, one a row), label (0/1), fold (0 where there is none) and the
    models' columns of bins. A model's trees don't depend on ``local_bytes``."""
    views = sorted({m.view for m in models})
    rows = rows.select(F.col("key").cast("long"), F.col("label").cast("int").alias("label"), F.col("fold").cast("int").alias("fold"), *views)
    counts = {(r["fold"], r["label"]): r["n"] for r in rows.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
    first = rows.select(*[F.length(v).alias(v) for v in views]).first()
    starts, weights = [], []
    for m in models:
        n = [sum(c for (f, y), c in counts.items() if y == k and f != m.held_out) for k in (0, 1)]
        if not sum(n):
            raise ValueError("no rows to fit")
        w = tuple(sum(n) / (2 * c) if c else 0.0 for c in n) if m.balanced else (1.0, 1.0)
        share = np.clip(w[1] * n[1] / (w[0] * n[0] + w[1] * n[1]), 1e-9, 1 - 1e-9)
        starts.append(float(np.log(share / (1 - share))))
        weights.append(w)
    widths = {v: first[v] for v in views}
    if sum(counts.values()) * (16 + sum(widths.values())) <= local_bytes:
        trees = _fit_dealt(rows, models, starts, weights, views)
    else:
        trees = _fit_in_step(rows, models, starts, weights, widths)
    return [Fitted(m, s, t) for m, s, t in zip(models, starts, trees)]


def score(fitted: Fitted, margin: bool = False) -> F.Column:
    """Probability of label 1 from the model's column of bins, or its log-odds with ``margin``."""
    @F.pandas_udf("double")
    def run(bins: pd.Series) -> pd.Series:
        if not len(bins):
            return pd.Series([], dtype="float64")
        z = fitted.margins(_matrix(bins))[0]
        return pd.Series(z if margin else 1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return run(F.col(fitted.model.view))


def staged_confusion(rows: DataFrame, fits: list[Fitted], stages: list[list[int]]) -> pd.DataFrame:
    """tp, fp, fn of every model after each of its stages, in the rows of its held-out fold (part
    test) and the others (train): one pass, as a fit's prefixes are the fits of fewer rounds."""
    shared = rows.sparkSession.sparkContext.broadcast(fits)
    views = sorted({f.model.view for f in fits})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            if not len(pdf):
                continue
            bins = {v: _matrix(pdf[v]) for v in views}
            y, fold = pdf["label"].to_numpy() == 1, pdf["fold"].to_numpy()
            for i, f in enumerate(shared.value):
                test = fold == f.model.held_out
                for n, margin in zip(sorted(stages[i]), f.margins(bins[f.model.view], stages[i])):
                    said = margin > 0
                    for part, mine in (("train", ~test), ("test", test)):
                        c = np.array([(said & y & mine).sum(), (said & ~y & mine).sum(), (~said & y & mine).sum()])
                        total[i, n, part] = total.get((i, n, part), 0) + c
        if total:
            yield pd.DataFrame([(*k, *c) for k, c in total.items()], columns=["model", "stage", "part", "tp", "fp", "fn"])

    out = (rows.select(F.col("label").cast("int").alias("label"), F.col("fold").cast("int").alias("fold"), *views)
           .mapInPandas(run, "model int, stage int, part string, tp long, fp long, fn long")
           .groupBy("model", "stage", "part").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")]).toPandas())
    shared.unpersist()
    return out
