"""Distance operators: exact kNN join (J4), radius join (J5), Euclidean
silhouette (K3), approximate kNN (LSH).

All exact operators share one blocked plan. Rows are split into blocks of
``block_rows``, on larger tables of more (``block_size``: 1/24 of the rows, 16,384 at
most, so copies of a row stay few); each (left block, right block) pair becomes one
cogroup key, so a task holds two bounded blocks and computes their distance matrix
with numpy, some rows at a time. The kernel emits only what the operator needs (top-k
per row, pairs within eps, or per-cluster distance sums), never the full pair set.

Distances are first found by a matrix product, whose rounding error has a proven bound.
Only pairs that the bound can't decide are computed by direct differences, so what is
returned (neighbours, ties, pairs, weights) is that of direct differences.

The radius join prunes block pairs with a grid: cells of side eps on the
first ``grid_dims`` coordinates (a projection never increases distance, so no
pair within eps is lost). A cell with many rows is split into several blocks
on both sides, so a hot cell becomes many bounded tasks instead of one.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmetric.sources.tables import kernel_partitions

_CHUNK = 4_000_000
#: Distances of a chunk in single precision, and rows of ``y`` that share one minimum there.
_CHUNK_SINGLE, _GROUP = 1_000_000, 16
#: Most dimensions in which bounds of a pivot index prune enough to pay for it.
INDEX_DIMS = 16


def as_vectors(df: DataFrame, id_col: str, vec_col: str, extra: list[str] | None = None) -> DataFrame:
    """(id, vec array<double>, extra...) with the vector cast to double."""
    extra = extra or []
    return df.select(F.col(id_col).cast("long").alias("id"),
                     F.col(vec_col).cast("array<double>").alias("vec"), *extra)


def _matrix(s: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in s.to_numpy()]) if len(s) else np.zeros((0, 0))


def pair_distances(a: np.ndarray, b: np.ndarray, p: int = 2) -> np.ndarray:
    """Exact Minkowski distances (p = 1 or 2) by direct differences, in chunks."""
    out = np.empty((a.shape[0], b.shape[0]))
    step = max(1, _CHUNK // max(1, b.size))
    for s in range(0, a.shape[0], step):
        d = a[s:s + step, None, :] - b[None, :, :]
        out[s:s + step] = np.sqrt(np.einsum("ijk,ijk->ij", d, d)) if p == 2 else np.abs(d).sum(-1)
    return out


def exact_distances(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, p: int = 2) -> np.ndarray:
    """Distances of the pairs (x[i], y[j]) by direct differences, as ``pair_distances`` has them."""
    out = np.empty(len(i))
    step = max(1, _CHUNK // max(1, x.shape[1]))
    for s in range(0, len(i), step):
        d = x[i[s:s + step]] - y[j[s:s + step]]
        out[s:s + step] = np.sqrt(np.einsum("ij,ij->i", d, d)) if p == 2 else np.abs(d).sum(-1)
    return out


class Near:
    """Approximate distances of row ranges of ``x`` to all of ``y``: squared for p = 2. ``error`` bounds their
    error. ``ok`` is false where rows hold no finite numbers (or too large ones): no bound is known. With ``single``
    the product is taken in single precision where the numbers' size allows it: the bound is that of its digits."""

    def __init__(self, x: np.ndarray, y: np.ndarray, p: int = 2, single: bool = False):
        self.x, self.y, self.p = x, y, p
        self.step = max(1, _CHUNK // max(1, len(y)))
        unit = 8 * (x.shape[1] + 8)
        if p == 2:
            with np.errstate(all="ignore"):
                nx, ny = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
            top = max(nx.max(initial=0), ny.max(initial=0))
            self.ok = bool(top < 1e300 and np.isfinite(nx.sum() + ny.sum()))
            self.error = unit * np.finfo(np.float64).eps * (nx + ny.max(initial=0))
            if single and self.ok and top < 1e30:
                mid = y.mean(axis=0) if len(y) else 0.0
                x, y = x - mid, y - mid  # digits go to the spread; the bound above covers what these differences lose
                nx, ny = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
            # one product gives |a|^2 + |b|^2 - 2ab
            self.left = np.column_stack([-2 * x, nx, np.ones(len(x))])
            self.right = np.ascontiguousarray(np.column_stack([y, np.ones(len(y)), ny]).T)
            if single and self.ok and top < 1e30 and ny.max(initial=0) > 1e-20:
                self.error = self.error + unit * np.finfo(np.float32).eps * (nx + ny.max(initial=0))
                self.step = max(1, _CHUNK_SINGLE // max(1, len(self.y)))
                self.left, self.right = self.left.astype(np.float32), self.right.astype(np.float32)
        else:
            top = np.abs(x).sum(1) + np.abs(y).sum(1).max(initial=0)
            self.ok = bool(np.isfinite(top).all())
            self.columns, self.rows = np.ascontiguousarray(y.T), x
            self.error = unit * np.finfo(np.float64).eps * top
            if single and self.ok and len(y) and 1e-20 < top.max(initial=0) < 1e30:
                self.error = self.error + unit * np.finfo(np.float32).eps * top
                self.step = max(1, _CHUNK_SINGLE // 4 // len(y))
                self.columns, self.rows = self.columns.astype(np.float32), x.astype(np.float32)

    def parts(self):
        """(first row, distances of some rows, bounds on their error)."""
        for s in range(0, len(self.x), self.step):
            if self.p == 2:
                d = self.left[s:s + self.step] @ self.right
            else:
                rows = self.rows[s:s + self.step]
                d = np.zeros((len(rows), len(self.y)), rows.dtype)
                part = np.empty_like(d)
                for c, column in enumerate(self.columns):
                    np.subtract(rows[:, c, None], column, out=part)
                    np.abs(part, out=part)
                    d += part
            yield s, d, self.error[s:s + self.step]


def _least_of_groups(d: np.ndarray) -> np.ndarray | None:
    """Minima of columns c, c + q, c + 2q.. of every row, for c < q; None where there are few columns."""
    q = d.shape[1] // _GROUP
    return d[:, :q * _GROUP].reshape(len(d), _GROUP, q).min(axis=1) if q else None


def _at_most(d: np.ndarray, limit: np.ndarray, least: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of the entries of ``d`` not above the row's limit; ``least`` are its group minima."""
    if least is None:
        return np.divmod(np.flatnonzero(d <= limit[:, None]), d.shape[1])
    q = least.shape[1]
    i, c = np.divmod(np.flatnonzero(least <= limit[:, None]), q)
    column = c[:, None] + q * np.arange(_GROUP)
    hit = d[i[:, None], column] <= limit[i, None]
    rest = np.divmod(np.flatnonzero(d[:, q * _GROUP:] <= limit[:, None]), max(1, d.shape[1] - q * _GROUP))
    return (np.concatenate([np.broadcast_to(i[:, None], hit.shape)[hit], rest[0]]),
            np.concatenate([column[hit], rest[1] + q * _GROUP]))


def _same_ids(qid: np.ndarray, rid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (query, row) of all pairs of equal ids, by query."""
    order = np.argsort(rid, kind="stable")
    lo, hi = (np.searchsorted(rid[order], qid, side) for side in ("left", "right"))
    i = np.repeat(np.arange(len(qid)), hi - lo)
    return i, order[np.arange(len(i)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[i]]


def nearest_in_block(qid, x, rid, y, k: int, p: int = 2, exclude_self: bool = False):
    """Positions of queries (ascending), ids and distances of their k nearest rows in the block, ties to the
    smaller id; pairs without a finite distance are left out."""
    kk = min(k, len(rid))
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if not kk or not len(qid):
        return none
    near = Near(x, y, p, single=True)
    found = []
    if not near.ok:
        for s in range(0, len(x), near.step):
            d = pair_distances(x[s:s + near.step], y, p)
            if exclude_self:
                d[qid[s:s + near.step, None] == rid] = np.inf
            order = np.lexsort((np.broadcast_to(rid, d.shape), d), axis=-1)[:, :kk]
            far = np.take_along_axis(d, order, axis=1).ravel()
            keep = np.isfinite(far)
            found.append((np.repeat(np.arange(len(d)) + s, kk)[keep], rid[order].ravel()[keep], far[keep]))
        return tuple(np.concatenate(c) for c in zip(*found))
    own, its = _same_ids(qid, rid) if exclude_self else none[:2]
    for s, d, error in near.parts():
        mine = slice(*np.searchsorted(own, [s, s + len(d)]))
        d[own[mine] - s, its[mine]] = np.inf
        # the k-th of the minima of groups, or of some columns, bounds the k-th of all
        least = _least_of_groups(d) if len(rid) >= 4 * kk * _GROUP else None
        some = d[:, :max(8 * kk, len(rid) // 8)] if least is None else least
        few = np.partition(some, kk - 1, axis=1)[:, kk - 1]
        i, j = _at_most(d, few + 2 * error, least)
        finite = np.isfinite(d[i, j])
        i, j = i[finite], j[finite]
        far = exact_distances(x, y, i + s, j, p)
        order = np.lexsort((rid[j], far, i))
        i, j, far = i[order], j[order], far[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < kk
        found.append((i[keep] + s, rid[j[keep]], far[keep]))
    return tuple(np.concatenate(c) for c in zip(*found))


def within_in_block(x, y, eps: float, p: int = 2):
    """(i, j, distance) of the pairs of two blocks with distance <= eps, some rows at a time."""
    near = Near(x, y, p, single=True)
    if not near.ok:
        for s in range(0, len(x), near.step):
            d = pair_distances(x[s:s + near.step], y, p)
            i, j = np.nonzero(d <= eps)
            yield i + s, j, d[i, j]
        return
    for s, d, error in near.parts():
        limit = (eps * eps if p == 2 else eps) * (1 + 1e-15) + error
        i, j = _at_most(d, limit, _least_of_groups(d))
        far = exact_distances(x, y, i + s, j, p)
        keep = far <= eps
        yield i[keep] + s, j[keep], far[keep]


def distances_in_block(x, y, p: int = 2):
    """(first row, distances of some rows to all of ``y``) to about 1e-11 of the rows' spread: close pairs,
    where a matrix product loses digits, by direct differences."""
    mid = y.mean(axis=0)
    near = Near(x - mid, y - mid, p)
    if p != 2 or not near.ok:
        for s in range(0, len(x), near.step):
            yield s, pair_distances(x[s:s + near.step], y, p)
        return
    for s, d, error in near.parts():
        at = np.flatnonzero(d <= (error / near.left.shape[1] * 1e8)[:, None])
        i, j = np.divmod(at, len(y))
        np.sqrt(np.maximum(d, 0, out=d), out=d)
        d.ravel()[at] = exact_distances(x, y, i + s, j, p)
        yield s, d


def _cluster_sums(x, y, labels: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of x by cluster of ``labels``: sums of distances, the clusters, their sizes in the block)."""
    seen, place, size = np.unique(labels, return_inverse=True, return_counts=True)
    order = np.argsort(place, kind="stable")
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    y = y[order]
    out = np.empty((len(x), len(seen)))
    hot = (np.sort(place)[:, None] == np.arange(len(seen))).astype(np.float64) if len(seen) <= 32 else None
    for s, d in distances_in_block(x, y, p):
        out[s:s + len(d)] = d @ hot if hot is not None else np.add.reduceat(d, starts, axis=1)
    return out, seen, size


#: Most rows of a block, and parts that smaller tables are cut into.
_BLOCK_MOST, _PARTS = 16_384, 24


def block_size(n: int, least: int) -> int:
    """Rows of a block for a table of ``n`` rows."""
    return max(least, min(_BLOCK_MOST, n // _PARTS))


def _n_blocks(df: DataFrame, block_rows: int) -> int:
    n = df.count()
    return max(1, math.ceil(n / block_size(n, block_rows)))


def _block_pairs(left: DataFrame, right: DataFrame, nl: int, nr: int) -> tuple[DataFrame, DataFrame]:
    """Tag rows with their block and replicate them to every partner block."""
    left = left.select(*[F.col(c).alias(c) for c in left.columns])
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    # both block ids are int on both sides, so equal keys hash to the same partition
    lx = left.select("*", F.pmod(F.xxhash64("id"), F.lit(nl)).cast("int").alias("lb"),
                     F.explode(F.sequence(F.lit(0), F.lit(nr - 1))).alias("rb"))
    rx = right.select("*", F.pmod(F.xxhash64("id"), F.lit(nr)).cast("int").alias("rb"),
                      F.explode(F.sequence(F.lit(0), F.lit(nl - 1))).alias("lb"))
    # an explicit count keeps block pairs on separate tasks (AQE does not merge these)
    n = kernel_partitions(left.sparkSession, nl * nr)
    return lx.repartition(n, "lb", "rb"), rx.repartition(n, "lb", "rb")


def _self_block_pairs(df: DataFrame, nb: int) -> tuple[DataFrame, DataFrame]:
    """Blocked self-join over pairs lb <= rb: a row of block b is copied to the
    left of (b, r) for r >= b and to the right of (l, b) for l <= b (nb + 1
    copies instead of 2 nb); kernels answer both sides of an off-diagonal pair."""
    # fresh columns on each side, also where ``df`` comes from a join of tables with one origin
    left, right = (df.select(*[F.col(c).alias(c) for c in df.columns]) for _ in "lr")
    blk = F.pmod(F.xxhash64("id"), F.lit(nb)).cast("int")
    lx = left.select("*", blk.alias("lb")).select("*", F.explode(F.sequence(F.col("lb"), F.lit(nb - 1))).alias("rb"))
    rx = right.select("*", blk.alias("rb")).select("*", F.explode(F.sequence(F.lit(0), F.col("rb"))).alias("lb"))
    n = kernel_partitions(df.sparkSession, nb * (nb + 1) // 2)
    return lx.repartition(n, "lb", "rb"), rx.repartition(n, "lb", "rb")


# ---------------------------------------------------------------- J4 exact kNN
def knn_join(query: DataFrame, ref: DataFrame, k: int, p: int = 2, block_rows: int = 512,
             exclude_self: bool = False, max_block_pairs: int = 4096) -> DataFrame:
    """k nearest ``ref`` rows of every ``query`` row: (query_id, neighbor_id, rank, distance).

    Inputs are (id, vec). Ties are broken by neighbour id; the query row itself
    counts as a neighbour when it is in ``ref`` unless ``exclude_self``. Beyond
    ``max_block_pairs`` pairs of ``block_rows`` a pivot index prunes vectors of few dimensions,
    with the same result."""
    same = query is ref
    nq = query.count()
    nr = nq if same else ref.count()
    head = ref.where(F.col("vec").isNotNull()).select(F.size("vec").alias("n")).first()
    if math.ceil(nq / block_rows) * math.ceil(nr / block_rows) > max_block_pairs and head and head["n"] <= INDEX_DIMS:
        from segmetric.operators.metric_index import pivot_index

        return pivot_index(ref, p=p, block_rows=block_rows).knn(query, k, exclude_self)
    schema = "query_id long, neighbor_id long, distance double"

    def best(left: pd.DataFrame, right: pd.DataFrame, x, y) -> pd.DataFrame:
        qid = left["id"].to_numpy()
        of, to, far = nearest_in_block(qid, x, right["id"].to_numpy(), y, k, p, exclude_self)
        return pd.DataFrame({"query_id": qid[of], "neighbor_id": to, "distance": far})

    def top_k(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "neighbor_id": [], "distance": []})
        x, y = _matrix(left["vec"]), _matrix(right["vec"])
        out = best(left, right, x, y)
        if same and key[0] != key[1]:
            out = pd.concat([out, best(right, left, y, x)], ignore_index=True)
        return out

    nl = max(1, math.ceil(nq / block_size(nq, block_rows)))
    if same:
        # self join: only block pairs lb <= rb; an off-diagonal pair answers both sides
        lx, rx = _self_block_pairs(query.select("id", "vec"), nl)
    else:
        lx, rx = _block_pairs(query.select("id", "vec"), ref.select("id", "vec"), nl,
                              max(1, math.ceil(nr / block_size(nr, block_rows))))
    part = lx.groupBy("lb", "rb").cogroup(rx.groupBy("lb", "rb")).applyInPandas(top_k, schema)
    w = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def approx_knn_join(query: DataFrame, ref: DataFrame, k: int, bucket_length: float,
                    num_hash_tables: int = 3, threshold: float | None = None) -> DataFrame:
    """Scale option: LSH candidate pairs (Euclidean) then top-k; may miss neighbours."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    q = query.select("id", array_to_vector("vec").alias("v"))
    r = ref.select("id", array_to_vector("vec").alias("v"))
    lsh = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket_length,
                                      numHashTables=num_hash_tables, seed=42).fit(r)
    thr = threshold if threshold is not None else float("inf")
    pairs = lsh.approxSimilarityJoin(q, r, thr, distCol="distance").select(
        F.col("datasetA.id").alias("query_id"), F.col("datasetB.id").alias("neighbor_id"), "distance")
    w = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ---------------------------------------------------------------- J5 radius join
def _radius_units(df: DataFrame, eps: float, grid_dims: int, block_rows: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a radius self-join, one copy a pair of neighbouring units (lc, ls) <= (rc, rs): kernels answer
    both sides of a pair of different units. Columns of ``df`` ride along."""
    head = df.select(F.size("vec").alias("n")).first()
    dim = head["n"] if head else 1  # an empty input gives no pairs
    g = max(1, min(grid_dims, dim))
    cell = F.array(*[F.floor(F.col("vec")[i] / F.lit(float(eps))).cast("long") for i in range(g)])
    cols = df.columns
    pts = df.select(*cols, cell.alias("cell"))
    sizes = pts.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    rows = block_size(df.count(), block_rows)
    units = sizes.select("cell", F.ceil(F.col("n") / F.lit(rows)).cast("int").alias("S"))
    pts = pts.join(units, "cell").withColumn("s", F.pmod(F.xxhash64("id"), F.col("S")).cast("int"))
    offsets = F.array(*[F.array(*[F.lit(o) for o in off]) for off in itertools.product((-1, 0, 1), repeat=g)])

    def neighbour_cells(c):
        return F.transform(offsets, lambda off: F.zip_with(c, off, lambda a, b: a + b))

    mine = F.struct("lc", "ls") <= F.struct("rc", "rs")
    # left copy of a point goes to every (its unit, neighbour unit) pair
    left = pts.select(*[F.col(c).alias(c) for c in cols], F.col("cell").alias("lc"), F.col("s").alias("ls"),
                      F.explode(neighbour_cells(F.col("cell"))).alias("rc"))
    left = left.join(units.select(F.col("cell").alias("rc"), F.col("S").alias("rS")), "rc")
    left = left.select(*cols, "lc", "ls", "rc", F.explode(F.sequence(F.lit(0), F.col("rS") - 1)).alias("rs")).where(mine)
    # right copy of a point goes to every (neighbour unit, its unit) pair
    right = pts.select(*[F.col(c).alias(c) for c in cols], F.col("cell").alias("rc"), F.col("s").alias("rs"),
                       F.explode(neighbour_cells(F.col("cell"))).alias("lc"))
    right = right.join(units.select(F.col("cell").alias("lc"), F.col("S").alias("lS")), "lc")
    right = right.select(*cols, "rc", "rs", "lc", F.explode(F.sequence(F.lit(0), F.col("lS") - 1)).alias("ls")).where(mine)
    keys = ["lc", "ls", "rc", "rs"]
    n = kernel_partitions(df.sparkSession, 4 * df.sparkSession.sparkContext.defaultParallelism)
    return left.repartition(n, *keys), right.repartition(n, *keys), keys


def _same_unit(key) -> bool:
    return list(key[0]) == list(key[2]) and key[1] == key[3]


def radius_join(df: DataFrame, eps: float, p: int = 2, grid_dims: int = 3, block_rows: int = 512) -> DataFrame:
    """All ordered pairs (i, j, distance) with distance <= eps, self pairs included."""
    left, right, keys = _radius_units(df.select("id", "vec"), eps, grid_dims, block_rows)

    def within(key, l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if l.empty or r.empty:
            return pd.DataFrame({"i": [], "j": [], "distance": []})
        a, b, d = (np.concatenate(c) for c in zip(*within_in_block(_matrix(l["vec"]), _matrix(r["vec"]), eps, p)))
        i, j = l["id"].to_numpy()[a], r["id"].to_numpy()[b]
        if not _same_unit(key):
            i, j, d = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([d, d])
        return pd.DataFrame({"i": i, "j": j, "distance": d})

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        within, "i long, j long, distance double")


def radius_counts(df: DataFrame, eps: float, p: int = 2, grid_dims: int = 3, block_rows: int = 512) -> DataFrame:
    """(id, nn): rows within eps of every row, itself included; no pair leaves a task."""
    left, right, keys = _radius_units(df.select("id", "vec"), eps, grid_dims, block_rows)

    def count(key, l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if l.empty or r.empty:
            return pd.DataFrame({"id": [], "nn": []})
        of_l, of_r = np.zeros(len(l), np.int64), np.zeros(len(r), np.int64)
        for a, b, _ in within_in_block(_matrix(l["vec"]), _matrix(r["vec"]), eps, p):
            of_l += np.bincount(a, minlength=len(l))
            of_r += np.bincount(b, minlength=len(r))
        out = pd.DataFrame({"id": l["id"], "nn": of_l})
        if not _same_unit(key):
            out = pd.concat([out, pd.DataFrame({"id": r["id"], "nn": of_r})], ignore_index=True)
        return out[out["nn"] > 0]

    part = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(count, "id long, nn long")
    return part.groupBy("id").agg(F.sum("nn").alias("nn"))


def _local_roots(n: int, pairs) -> np.ndarray:
    """Smallest position of each node's component, for nodes 0..n-1 and batches (a, b) of links."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
    return root


def radius_links(df: DataFrame, eps: float, p: int = 2, grid_dims: int = 3, block_rows: int = 512) -> DataFrame:
    """Links of the rows of ``df`` (id, vec, core): (src, dst, border). Of the pairs of core rows within eps
    only a star for every component inside a pair of units (border false), which joins the same rows;
    all pairs of another row (src) and a core row within eps (border true)."""
    left, right, keys = _radius_units(df.select("id", "vec", "core"), eps, grid_dims, block_rows)

    def links(key, l: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if l.empty or r.empty:
            return pd.DataFrame({"src": [], "dst": [], "border": []})
        ids = np.concatenate([l["id"].to_numpy(), r["id"].to_numpy()])
        core = np.concatenate([l["core"].to_numpy(), r["core"].to_numpy()]).astype(bool)
        edge = []

        def core_pairs():
            for a, b, _ in within_in_block(_matrix(l["vec"]), _matrix(r["vec"]), eps, p):
                b = b + len(l)
                both = core[a] & core[b]
                one = core[a] != core[b]
                edge.append((np.where(core[a[one]], b[one], a[one]), np.where(core[a[one]], a[one], b[one])))
                yield a[both], b[both]

        root = _local_roots(len(ids), core_pairs())
        far = np.flatnonzero(root != np.arange(len(ids)))
        rim, to = (np.concatenate(c) for c in zip(*edge))
        return pd.DataFrame({"src": ids[np.concatenate([far, rim])], "dst": ids[np.concatenate([root[far], to])],
                             "border": np.concatenate([np.zeros(len(far), bool), np.ones(len(rim), bool)])})

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(links, "src long, dst long, border boolean")


# ---------------------------------------------------------------- K3 silhouette
def silhouette_samples(df: DataFrame, p: int = 2, block_rows: int = 512) -> DataFrame:
    """Exact per-row silhouette (id, cluster, s) of (id, vec, cluster);
    rows of singleton clusters get 0."""
    lx, rx = _self_block_pairs(df.select("id", "vec", "cluster"), _n_blocks(df, block_rows))

    def one_side(left: pd.DataFrame, right: pd.DataFrame, x, y) -> pd.DataFrame:
        total, seen, size = _cluster_sums(x, y, right["cluster"].to_numpy(), p)
        return pd.DataFrame({"id": np.repeat(left["id"].to_numpy(), len(seen)), "other": np.tile(seen.astype(int), len(left)),
                             "dsum": total.ravel(), "cnt": np.tile(size, len(left))})

    def sums(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"id": [], "other": [], "dsum": [], "cnt": []})
        x, y = _matrix(left["vec"]), _matrix(right["vec"])
        out = one_side(left, right, x, y)
        return out if key[0] == key[1] else pd.concat([out, one_side(right, left, y, x)], ignore_index=True)

    part = lx.groupBy("lb", "rb").cogroup(rx.groupBy("lb", "rb")).applyInPandas(
        sums, "id long, other int, dsum double, cnt long")
    per = part.groupBy("id", "other").agg(F.sum("dsum").alias("dsum"), F.sum("cnt").alias("cnt"))
    per = per.join(df.select("id", "cluster"), "id")
    own = F.when(F.col("other") == F.col("cluster"), F.col("dsum") / (F.col("cnt") - 1))
    oth = F.when(F.col("other") != F.col("cluster"), F.col("dsum") / F.col("cnt"))
    ab = per.groupBy("id", "cluster").agg(F.max(own).alias("a"), F.min(oth).alias("b"),
                                          F.max(F.when(F.col("other") == F.col("cluster"), F.col("cnt"))).alias("n"))
    s = F.when((F.col("n") <= 1) | F.col("b").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return ab.select("id", "cluster", s.alias("s"))


def silhouette(df: DataFrame, p: int = 2, block_rows: int = 512) -> DataFrame:
    """K3: mean silhouette (one row); NULL unless 2 <= clusters <= n - 1."""
    ss = silhouette_samples(df, p, block_rows)
    agg = ss.agg(F.avg("s").alias("silhouette"), F.count_distinct("cluster").alias("k"),
                 F.count(F.lit(1)).alias("n"))
    return agg.select(F.when((F.col("k") >= 2) & (F.col("k") <= F.col("n") - 1), F.col("silhouette"))
                      .alias("silhouette"))


def silhouette_batched(vecs: DataFrame, labels: DataFrame, keys: list, p: int = 2,
                       block_rows: int = 512) -> DataFrame:
    """Mean silhouette for many labelings at once: (cand, silhouette).

    ``labels`` is (cand, id, cluster) over non-noise rows. Each distance block
    is computed once and reused for every labeling (label arrays ride along
    with the rows, -1 where a row is absent from a labeling)."""
    wide = labels.groupBy("id").agg(F.array(*[
        F.coalesce(F.max(F.when(F.col("cand") == F.lit(c), F.col("cluster"))), F.lit(-1)) for c in keys
    ]).alias("labs"))
    rows = vecs.select("id", "vec").join(wide, "id")
    nb = _n_blocks(rows, block_rows)
    lx, rx = _block_pairs(rows, rows, nb, nb)

    def sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"id": [], "cand": [], "other": [], "dsum": [], "cnt": []})
        ll = np.stack(left["labs"].to_numpy()).astype(np.int64)
        rl = np.stack(right["labs"].to_numpy()).astype(np.int64)
        lid = left["id"].to_numpy()
        cuts = []  # of every labeling that both sides have: order of the right rows, where clusters begin, clusters, sizes
        for c in range(ll.shape[1]):
            if (ll[:, c] != -1).any() and (rl[:, c] != -1).any():
                order = np.argsort(rl[:, c], kind="stable")
                order = order[rl[order, c] != -1]
                seen, start, size = np.unique(rl[order, c], return_index=True, return_counts=True)
                cuts.append((c, order, start, seen, size))
        parts = []
        for s, d in distances_in_block(_matrix(left["vec"]), _matrix(right["vec"]), p):
            for c, order, start, seen, size in cuts:
                lm = np.flatnonzero(ll[s:s + len(d), c] != -1)
                if len(lm):
                    total = np.add.reduceat(d[np.ix_(lm, order)], start, axis=1)
                    parts.append(pd.DataFrame({"id": np.repeat(lid[s + lm], len(seen)), "cand": c, "other": np.tile(seen, len(lm)),
                                               "dsum": total.ravel(), "cnt": np.tile(size, len(lm))}))
        if not parts:
            return pd.DataFrame({"id": [], "cand": [], "other": [], "dsum": [], "cnt": []})
        return pd.concat(parts, ignore_index=True)

    part = lx.groupBy("lb", "rb").cogroup(rx.groupBy("lb", "rb")).applyInPandas(
        sums, "id long, cand int, other int, dsum double, cnt long")
    per = part.groupBy("id", "cand", "other").agg(F.sum("dsum").alias("dsum"), F.sum("cnt").alias("cnt"))
    pos = F.create_map(*[x for i, c in enumerate(keys) for x in (F.lit(i), F.lit(c))])
    per = per.withColumn("cand", pos[F.col("cand")])
    per = per.join(labels.select("cand", "id", "cluster"), ["cand", "id"])
    own = F.when(F.col("other") == F.col("cluster"), F.col("dsum") / (F.col("cnt") - 1))
    oth = F.when(F.col("other") != F.col("cluster"), F.col("dsum") / F.col("cnt"))
    ab = per.groupBy("cand", "id", "cluster").agg(
        F.max(own).alias("a"), F.min(oth).alias("b"),
        F.max(F.when(F.col("other") == F.col("cluster"), F.col("cnt"))).alias("n"))
    s = F.when((F.col("n") <= 1) | F.col("b").isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return ab.groupBy("cand").agg(F.avg(s).alias("silhouette"))


def _segments(d: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the columns of ``d`` from each start to the next one."""
    return d if len(starts) == d.shape[1] else np.add.reduceat(d, starts, axis=1)


class Labelings:
    """Silhouettes of a table that a task holds whole, under many labelings (columns of ``labs``, -1: row left out). Rows
    that all labelings treat alike are kept side by side: a distance is summed once for all of them."""

    def __init__(self, x: np.ndarray, labs: np.ndarray, p: int = 2):
        self.kinds, place = np.unique(labs, axis=0, return_inverse=True)
        place = place.ravel()
        order = np.argsort(place, kind="stable")
        self.x, self.place, self.p = np.ascontiguousarray(x[order]), place[order], p
        self.first = np.searchsorted(self.place, np.arange(len(self.kinds) + 1))
        rows = np.diff(self.first)
        self.cuts = []  # by labeling: kinds by cluster, where clusters begin, sizes, each kind's cluster (-1: none)
        for lab in self.kinds.T:
            by = np.argsort(lab, kind="stable")
            by = by[lab[by] != -1]
            _, start, to = np.unique(lab[by], return_index=True, return_inverse=True)
            own = np.full(len(lab), -1)
            own[by] = to.ravel()
            self.cuts.append((by, start, np.add.reduceat(rows[by], start) if len(by) else rows[:0], own))

    def sums(self, a: int, b: int) -> np.ndarray:
        """Sums of the silhouettes of the rows at places ``a``..``b`` - 1, by labeling."""
        out = np.zeros(len(self.cuts))
        step = max(1, min(256, _CHUNK // max(1, len(self.kinds))))
        for s in range(a, b, step):
            x = self.x[s:min(b, s + step)]
            total = np.zeros((len(x), len(self.kinds)))
            for c in range(0, len(self.x), _BLOCK_LOCAL):
                y = self.x[c:c + _BLOCK_LOCAL]
                lo, hi = self.place[c], self.place[min(c + _BLOCK_LOCAL, len(self.x)) - 1]
                starts = np.maximum(self.first[lo:hi + 1] - c, 0)
                for at, d in distances_in_block(x, y, self.p):
                    total[at:at + len(d), lo:hi + 1] += _segments(d, starts)
            kind = self.place[s:s + len(x)]
            for n, (by, start, size, own) in enumerate(self.cuts):
                mine = np.flatnonzero(own[kind] >= 0)
                if not len(mine) or len(size) < 2:
                    continue  # one cluster: silhouettes are 0
                per = _segments(total[np.ix_(mine, by)], start)
                at = np.arange(len(mine)), own[kind[mine]]
                few = size[at[1]] <= 1
                near = per[at] / np.maximum(size[at[1]] - 1, 1)
                per /= size
                per[at] = np.inf
                far = per.min(axis=1)
                top = np.maximum(near, far)
                out[n] += np.where(few | (top == 0), 0.0, (far - near) / np.where(top == 0, 1.0, top)).sum()
        return out


#: Rows that a task of a table held whole measures at a time, and the bytes of such a table at most.
_BLOCK_LOCAL, LOCAL_BYTES = 2048, 64 << 20


def held_vectors(df: DataFrame, extra: int = 0, local_bytes: int = LOCAL_BYTES) -> tuple[np.ndarray, np.ndarray] | None:
    """(ids, vectors) of (id, vec) by id, where ids differ, no value is null or not finite, and the table with ``extra`` bytes a
    row is proven to be at most ``local_bytes``; else None."""
    width = F.size("vec")
    h = df.agg(F.count(F.lit(1)).alias("n"), F.count("id").alias("ids"), F.count_distinct("id").alias("differ"), F.min(width).alias("least"),
               F.max(width).alias("most"), F.count("vec").alias("vecs")).first()
    if not h["n"] or len({h["n"], h["ids"], h["differ"], h["vecs"]}) > 1 or h["least"] != h["most"] or h["least"] < 1:
        return None
    if h["n"] * (8 * (h["least"] + 1) + extra) > local_bytes:
        return None

    def pack(batches):
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"id": [pdf["id"].to_numpy(np.int64).tobytes()], "vec": [_matrix(pdf["vec"]).tobytes()]})

    got = df.select(F.col("id").cast("long").alias("id"), "vec").mapInPandas(pack, "id binary, vec binary").collect()
    ids = np.frombuffer(b"".join(bytes(r["id"]) for r in got), np.int64)
    x = np.frombuffer(b"".join(bytes(r["vec"]) for r in got), np.float64).reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    return (ids[order], x[order]) if np.isfinite(x).all() else None


def dealt(spark, n: int, run, parts: int | None = None) -> list:
    """Results of ``run(a, b)`` over parts of 0..``n`` - 1, one a task, in order."""
    parts = max(1, min(n, parts or 8 * spark.sparkContext.defaultParallelism))
    cuts = [(n * i // parts, n * (i + 1) // parts) for i in range(parts)]
    return spark.sparkContext.parallelize(cuts, parts).map(lambda c: run(*c)).collect()


def silhouettes_held(spark, x: np.ndarray, labs: np.ndarray, p: int = 2) -> list[float | None]:
    """Mean silhouette of the rows of every labeling (column of ``labs``, -1: row left out); None for one without rows."""
    shared = spark.sparkContext.broadcast(Labelings(x, labs, p))
    total = sum(dealt(spark, len(x), lambda a, b: shared.value.sums(a, b)))
    shared.unpersist()
    rows = (labs != -1).sum(axis=0)
    return [float(t / n) if n else None for t, n in zip(total, rows)]


def mreach_min_edges(rows: DataFrame, max_w: float, p: int = 2, block_rows: int = 512) -> DataFrame:
    """Cheapest outgoing mutual-reachability edge per row and per graph.

    ``rows`` is (id, vec, kds array<double>, comps array<long>): for graph m the
    core distance kds[m] and the current component comps[m]. The weight of
    (u, v) in graph m is max(kds_u[m], kds_v[m], d(u, v)); edges inside a
    component or heavier than ``max_w`` are ignored. Returns (m, u, v, w) with
    ties broken by the smaller v; nothing is materialised per pair."""
    nb = _n_blocks(rows, block_rows)
    lx, rx = _block_pairs(rows, rows, nb, nb)

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"m": [], "u": [], "v": [], "w": []})
        x, y = _matrix(left["vec"]), _matrix(right["vec"])
        kl, kr = _matrix(left["kds"]), _matrix(right["kds"])
        cl = np.stack(left["comps"].to_numpy()).astype(np.int64)
        cr = np.stack(right["comps"].to_numpy()).astype(np.int64)
        lid, rid = left["id"].to_numpy(), right["id"].to_numpy()
        near = Near(x, y, p)
        blocks = near.parts() if near.ok else ((s, pair_distances(x[s:s + near.step], y, p), np.zeros(len(x[s:s + near.step])))
                                               for s in range(0, len(x), near.step))
        parts = []
        for s, d, error in blocks:
            if near.ok and p == 2:
                np.sqrt(np.maximum(d, 0, out=d), out=d)
                error = np.sqrt(error)  # |sqrt(a) - sqrt(b)| <= sqrt(|a - b|)
            to = slice(s, s + len(d))
            for m in range(kl.shape[1]):
                w = np.maximum(kl[to, m, None], kr[:, m])
                np.maximum(w, d, out=w)
                w[(cl[to, m, None] == cr[:, m]) | (w > max_w + error[:, None])] = np.inf
                least = w.min(axis=1, initial=np.inf)
                at = np.flatnonzero(w <= np.where(np.isfinite(least), least + 2 * error, -np.inf)[:, None])
                # what the bound can't decide: weights by direct differences, ties to the smaller id
                i, j = np.divmod(at, len(rid))
                wij = np.maximum(np.maximum(kl[i + s, m], kr[j, m]), exact_distances(x, y, i + s, j, p))
                ok = wij <= max_w
                i, j, wij = i[ok], j[ok], wij[ok]
                order = np.lexsort((rid[j], wij, i))
                i, j, wij = i[order], j[order], wij[order]
                one = np.searchsorted(i, np.unique(i))
                if len(one):
                    parts.append(pd.DataFrame({"m": m, "u": lid[i[one] + s], "v": rid[j[one]], "w": wij[one]}))
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"m": [], "u": [], "v": [], "w": []})

    return lx.groupBy("lb", "rb").cogroup(rx.groupBy("lb", "rb")).applyInPandas(
        best, "m int, u long, v long, w double")


def silhouette_squared(df: DataFrame, features: str = "features", cluster: str = "cluster") -> float:
    """Scale option for K3: Spark's O(n k) silhouette with squared Euclidean
    distance (not the exact Euclidean value). ``df`` has a vector column."""
    from pyspark.ml.evaluation import ClusteringEvaluator

    ev = ClusteringEvaluator(featuresCol=features, predictionCol=cluster, metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(df.withColumn(cluster, F.col(cluster).cast("double"))))
