"""Clustering (K1-K6, K8) and cluster tables.

* K-Means: Spark ML ``KMeans`` restarted over seeds (best training cost wins),
  plus a deterministic Lloyd variant whose assignment is a built-in
  expression (nearest centre, ties to the smaller id) used for exact checks.
* DBSCAN: radius self-join -> neighbour counts -> core rows -> connected
  components of the core graph (alternating large-star / small-star rounds,
  O(log^2 n) rounds, lineage cut by checkpoint) -> border rows take the
  smallest neighbouring cluster -> clusters numbered by their smallest core id,
  which is the numbering of a sequential scan in id order.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmetric.operators.distance import (LOCAL_BYTES, held_vectors, knn_join, radius_counts, radius_links, silhouette, silhouette_batched,
                                          silhouettes_held)
from segmetric.operators.ordered import group_rank
from segmetric.operators.quantiles import quantiles_long, to_long


# ---------------------------------------------------------------- K-Means
def nearest_centre(cols: list[str], centres: list[list[float]]) -> F.Column:
    """Index of the nearest centre (squared Euclidean), ties to the smaller index."""
    far = [reduce(lambda a, b: a + b, [(F.col(x) - F.lit(float(v))) * (F.col(x) - F.lit(float(v))) for x, v in zip(cols, c)])
           for c in centres]
    least = F.least(*far) if len(far) > 1 else far[0]
    found = F.when(far[0] == least, F.lit(0))
    for i, d in enumerate(far[1:], 1):
        found = found.when(d == least, F.lit(i))
    return found.otherwise(F.lit(0))


def lloyd_kmeans(df: DataFrame, cols: list[str], init: list[list[float]]):
    """Deterministic Lloyd iterations from given centres until no row changes its cluster; an empty
    cluster keeps its centre. Returns (labels DataFrame with 'cluster', centres). One pass over the ``cols`` of ``df`` a
    round, kept by column (materialise ``df`` first): it counts the rows that the last centres moved and sums up the next ones."""
    centres, before = [list(map(float, c)) for c in init], None
    kept = df.select(*cols).persist()
    while True:
        now = nearest_centre(cols, centres)
        moved = F.lit(1) if before is None else (now != nearest_centre(cols, before)).cast("int")
        assigned = kept.select(*cols, now.alias("cluster"), moved.alias("__moved"))
        rows = assigned.groupBy("cluster").agg(F.sum("__moved").alias("__moved"), *[F.avg(c).alias(c) for c in cols]).collect()
        if not sum(r["__moved"] for r in rows):
            kept.unpersist()
            return df.withColumn("cluster", now), centres
        new = {r["cluster"]: [r[c] for c in cols] for r in rows}
        before, centres = centres, [new.get(i, c) for i, c in enumerate(centres)]


@dataclass(frozen=True)
class KMeansFit:
    model: object
    cost: float
    seed: int


def fit_kmeans(df: DataFrame, k: int, features: str = "features", n_init: int = 10, seed: int = 42,
               max_iter: int = 300, parallelism: int = 8) -> KMeansFit:
    """K1: best of ``n_init`` seeded runs by training cost (inertia); the runs are
    independent Spark jobs submitted concurrently. Ties keep the earliest seed."""
    from concurrent.futures import ThreadPoolExecutor

    from segmetric.sources.tables import spread

    # a round sends the driver a few kB a task: tasks are bounded by the cores, whatever the table's size
    data = spread(df.select(features)).coalesce(2 * df.sparkSession.sparkContext.defaultParallelism).cache()

    def run(s):
        m = KMeans(k=k, featuresCol=features, seed=seed + s, maxIter=max_iter, tol=1e-4,
                   predictionCol="cluster").fit(data)
        return KMeansFit(m, m.summary.trainingCost, seed + s)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        fits = list(pool.map(run, range(n_init)))
    data.unpersist()
    return min(fits, key=lambda f: (f.cost, f.seed))


def canonical_labels(fit: KMeansFit, df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Cluster ids renumbered by sorted centres, so equal fits give equal ids."""
    centres = [list(map(float, c)) for c in fit.model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: centres[i])
    remap = F.create_map(*[x for new, old in enumerate(order) for x in (F.lit(old), F.lit(new))])
    return fit.model.transform(df).select(id_col, remap[F.col("cluster")].cast("int").alias("cluster"))


class Centres:
    """A fitted K-Means: ``transform`` adds the index of the nearest centre as ``cluster``."""

    def __init__(self, centres: np.ndarray, features: str):
        self.centres, self.features = centres, features

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)

    def labels(self, x: np.ndarray) -> np.ndarray:
        mid = self.centres.mean(axis=0)
        c = self.centres - mid
        return ((x - mid) @ (-2 * c.T) + np.einsum("ij,ij->i", c, c)).argmin(axis=1)

    def transform(self, df: DataFrame) -> DataFrame:
        @F.pandas_udf("int")
        def nearest(v: pd.Series) -> pd.Series:
            return pd.Series(self.labels(np.stack(v.to_numpy())) if len(v) else [], dtype="int32")

        return df.withColumn("cluster", nearest(vector_to_array(self.features)))


def _lloyd_sums(x: np.ndarray, centres: list[np.ndarray]) -> list[np.ndarray]:
    """Of every run, by its centres: rows nearest to each (column 0), the sums of those rows, and in a last row the cost."""
    every = np.concatenate(centres)
    cuts = np.cumsum([0, *[len(c) for c in centres]])
    left, norm = -2 * every, np.einsum("ij,ij->i", every, every)[:, None]
    out = [np.zeros((len(c) + 1, x.shape[1] + 1)) for c in centres]
    for s in range(0, len(x), 2048):
        rows = x[s:s + 2048]
        whole = np.column_stack([np.ones(len(rows)), rows])
        far = left @ rows.T + norm
        size = np.einsum("ij,ij->", rows, rows)
        for o, a, b in zip(out, cuts, cuts[1:]):
            at = far[a:b].argmin(axis=0)
            o[:-1] += (at == np.arange(b - a)[:, None]).astype(np.float64) @ whole
            o[-1, 0] += size + far[a:b].min(axis=0).sum()
    return out


def fit_kmeans_all(df: DataFrame, k_values: list[int], features: str = "features", n_init: int = 10, seed: int = 42,
                   max_iter: int = 300, tol: float = 1e-4, parallelism: int = 16) -> dict[int, KMeansFit]:
    """K1 for every k of ``k_values``: the starts are those of Spark ML (k-means||, one a seed), the rounds of all runs share one
    pass over the rows. A run ends when no centre moves by more than ``tol``; its cost is that of its last pass."""
    from concurrent.futures import ThreadPoolExecutor

    from segmetric.sources.tables import spread

    data = spread(df.select(features)).coalesce(2 * df.sparkSession.sparkContext.defaultParallelism).cache()
    runs = [(k, seed + s) for k in k_values for s in range(n_init)]

    def start(run):
        m = KMeans(k=run[0], featuresCol=features, seed=run[1], maxIter=0, predictionCol="cluster").fit(data)
        return np.array(m.clusterCenters(), dtype=np.float64)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        centres = list(pool.map(start, runs))

    def pack(batches):
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"n": [len(pdf)], "x": [np.stack(pdf["x"].to_numpy()).tobytes()]})

    # numbers are taken from the mean of the first run's start: products lose fewer digits there
    mid = centres[0].mean(axis=0)
    centres = [c - mid for c in centres]
    blocks = data.select(vector_to_array(features).alias("x")).mapInPandas(pack, "n int, x binary").rdd.map(
        lambda r: np.frombuffer(bytes(r["x"])).reshape(r["n"], -1) - mid).persist()
    costs, active = [0.0] * len(runs), list(range(len(runs)))
    for _ in range(max_iter):
        now = [centres[i] for i in active]

        def one_pass(part, now=now):
            total = None
            for x in part:
                got = _lloyd_sums(x, now)
                total = got if total is None else [a + b for a, b in zip(total, got)]
            if total is not None:
                yield np.concatenate(total)

        total = sum(blocks.mapPartitions(one_pass).collect())
        at, still = 0, []
        for i in active:
            got = total[at:at + len(centres[i]) + 1]
            at += len(got)
            n = got[:-1, :1]
            new = np.where(n > 0, got[:-1, 1:] / np.maximum(n, 1), centres[i])  # a centre without rows stays
            moved = ((new - centres[i]) ** 2).sum(axis=1).max()
            centres[i], costs[i] = new, float(got[-1, 0])
            if moved > tol * tol:
                still.append(i)
        active = still
        if not active:
            break
    blocks.unpersist()
    data.unpersist()
    fits = {}
    for (k, s), c, cost in zip(runs, centres, costs):
        fit = KMeansFit(Centres(c + mid, features), cost, s)
        if k not in fits or (cost, s) < (fits[k].cost, fits[k].seed):
            fits[k] = fit
    return fits


def kmeans_sweep(df: DataFrame, k_values: list[int], features: str = "features", id_col: str = "row_id",
                 n_init: int = 10, seed: int = 42, vec_col: str | None = None):
    """K2: (k, silhouette, inertia) per k; chosen k = best silhouette, then smaller k.
    Returns (scores, chosen_k, fits). The chosen fit is reused, not refitted."""
    spark = df.sparkSession
    vecs = df.select(F.col(id_col).alias("id"), vector_to_array(features).alias("vec")).cache()
    fits = fit_kmeans_all(df, k_values, features, n_init, seed)
    several = [k for k in k_values if k >= 2]
    sils = dict(zip(several, _sweep_silhouettes(df, vecs, [fits[k] for k in several], id_col)))
    vecs.unpersist()
    rows = [(float(k), sils.get(k), float(fits[k].cost)) for k in k_values]
    scores = spark.createDataFrame(rows, "k double, silhouette double, inertia double")
    ok = [r for r in rows if r[1] is not None]
    chosen = int(sorted(ok, key=lambda r: (-r[1], r[0]))[0][0]) if ok else int(k_values[0])
    return scores, chosen, fits


def _sweep_silhouettes(df: DataFrame, vecs: DataFrame, fits: list[KMeansFit], id_col: str) -> list[float | None]:
    """Silhouettes of several fits; distances are taken once for all of them where the ids differ."""
    spark = df.sparkSession
    if not fits:
        return []
    held = held_vectors(vecs, 8 * len(fits))
    if held is not None:
        labs = np.column_stack([f.model.labels(held[1]) for f in fits])
        found = silhouettes_held(spark, held[1], labs)
        k = [len(np.unique(lab)) for lab in labs.T]
        return [s if 2 <= n <= len(labs) - 1 else None for s, n in zip(found, k)]
    labelled = [canonical_labels(f, df, id_col).withColumnRenamed(id_col, "id") for f in fits]
    n = vecs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids")).first()
    if n["n"] != n["ids"]:
        return [silhouette(vecs.join(lab, "id")).first()["silhouette"] for lab in labelled]
    every = reduce(DataFrame.unionByName, [lab.select(F.lit(i).alias("cand"), "id", "cluster") for i, lab in enumerate(labelled)]).cache()
    k = {r["cand"]: r["k"] for r in every.groupBy("cand").agg(F.count_distinct("cluster").alias("k")).collect()}
    found = {r["cand"]: r["silhouette"] for r in silhouette_batched(vecs, every, list(range(len(fits)))).collect()}
    every.unpersist()
    return [found.get(i) if 2 <= k.get(i, 0) <= n["n"] - 1 else None for i in range(len(fits))]


# ---------------------------------------------------------------- K4 eps candidates
# fixed values: factors of the searched eps candidates
EPS_MULTIPLIERS = [0.7, 0.85, 1.0, 1.2, 1.5, 2.0]


def kth_neighbour_distance(vecs: DataFrame, k: int, block_rows: int = 512) -> DataFrame:
    """(id, kdist): distance to the k-th neighbour, the row itself counting as the first."""
    nn = knn_join(vecs, vecs, k, block_rows=block_rows)
    return nn.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("distance").alias("kdist"))


def eps_candidates(vecs: DataFrame, min_samples: int, probs: list[float],
                   multipliers: list[float] = EPS_MULTIPLIERS) -> DataFrame:
    """Quantiles of the k-th neighbour distance times multipliers;
    positive, distinct, sorted."""
    kd = kth_neighbour_distance(vecs, min_samples).withColumn("column", F.lit("kdist"))
    q = quantiles_long(kd.withColumnRenamed("kdist", "x"), ["column"], probs)
    cand = q.select(F.explode(F.array(*[F.col("value") * F.lit(m) for m in multipliers])).alias("eps"))
    return cand.where(F.col("eps") > 0).distinct().orderBy("eps")


# ---------------------------------------------------------------- connected components
def connected_components(vertices: DataFrame, edges: DataFrame,
                         keys: list[str] | None = None) -> DataFrame:
    """(keys..., id, root) with root = smallest id of the component.

    ``edges`` (keys..., src, dst) are undirected; ``keys`` run many independent
    graphs in one pass (e.g. one per parameter candidate)."""
    keys = keys or []
    e = edges.where(F.col("src") != F.col("dst")).select(
        *keys, F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).distinct()
    e = e.checkpoint(eager=True)
    while True:  # until a round changes nothing
        both = e.select(*keys, "u", "v").unionByName(e.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours of a node link to the node's smallest neighbour (or itself)
        mn = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.col("u")).alias("__mn"))
        ls = both.join(mn, [*keys, "u"]).where(F.col("v") > F.col("u")).select(
            *keys, F.least("v", "__mn").alias("u"), F.greatest("v", "__mn").alias("v")).where(
            F.col("u") != F.col("v")).distinct()
        # small star: a node and its smaller neighbours link to the smallest of them
        down = ls.select(*keys, F.col("v").alias("node"), F.col("u").alias("nb"))
        mn2 = down.groupBy(*keys, "node").agg(F.min("nb").alias("__mn"))
        ss = (down.join(mn2, [*keys, "node"]).select(*keys, F.col("nb").alias("a"), "__mn")
              .unionByName(mn2.select(*keys, F.col("node").alias("a"), "__mn"))
              .where(F.col("a") != F.col("__mn"))
              .select(*keys, F.least("a", "__mn").alias("u"), F.greatest("a", "__mn").alias("v")).distinct())
        ss = ss.checkpoint(eager=True)
        if ss.exceptAll(e).isEmpty() and e.exceptAll(ss).isEmpty():
            e = ss
            break
        e = ss
    root = e.groupBy(*keys, F.col("v").alias("id")).agg(F.min("u").alias("root"))
    out = vertices.select(*keys, "id").join(root, [*keys, "id"], "left")
    return out.select(*keys, "id", F.coalesce("root", "id").alias("root"))


# ---------------------------------------------------------------- K5 DBSCAN
def dbscan_from_pairs(vecs: DataFrame, pairs: DataFrame, min_samples, keys: list[str] | None = None,
                      key_values: list | None = None) -> DataFrame:
    """Labels (keys..., id, cluster) from all ordered pairs (keys..., i, j) within
    eps (self included); -1 = noise. ``min_samples`` is a number or a column
    name present on ``pairs`` (one value per key). With ``keys`` (one column),
    ``key_values`` lists the key values, and every candidate is labelled at once."""
    keys = keys or []
    if len(keys) > 1:
        raise ValueError("one key column at most")
    ms = F.col(min_samples) if isinstance(min_samples, str) else F.lit(int(min_samples))
    counts = pairs.groupBy(*keys, F.col("i").alias("id")).agg(F.count(F.lit(1)).alias("nn"),
                                                             F.first(ms).alias("__ms"))
    core = counts.where(F.col("nn") >= F.col("__ms")).select(*keys, "id").checkpoint(eager=True)
    c1 = core.select(*keys, F.col("id").alias("i"))
    c2 = core.select(*keys, F.col("id").alias("j"))
    core_edges = pairs.join(c1, [*keys, "i"]).join(c2, [*keys, "j"]).where(F.col("i") < F.col("j")).select(
        *keys, F.col("i").alias("src"), F.col("j").alias("dst"))
    comp = connected_components(core, core_edges, keys=keys)
    roots = comp.select(*keys, "root").distinct()
    numbered = group_rank(roots, keys, ["root"]).select(*keys, "root", F.col("grp_rank").cast("int").alias("cluster"))
    core_lab = comp.join(numbered, [*keys, "root"]).select(*keys, "id", "cluster")
    # border rows: smallest cluster among core neighbours
    nb = pairs.join(core_lab.select(*keys, F.col("id").alias("j"), "cluster"), [*keys, "j"]).groupBy(
        *keys, F.col("i").alias("id")).agg(F.min("cluster").alias("bc"))
    if keys:
        # every row once per key value (a literal list, e.g. the candidate ids)
        lab = vecs.select("id", F.explode(F.array(*[F.lit(v) for v in key_values])).alias(keys[0]))
    else:
        lab = vecs.select("id")
    lab = lab.join(core_lab, [*keys, "id"], "left").join(nb, [*keys, "id"], "left")
    return lab.select(*keys, "id", F.coalesce("cluster", "bc", F.lit(-1)).cast("int").alias("cluster"))


def dbscan(vecs: DataFrame, eps: float, min_samples: int, p: int = 2, block_rows: int = 512) -> DataFrame:
    """K5 on (id, vec), without a table of pairs: one distance pass counts neighbours, a second one links core
    rows (a star for every component inside a pair of blocks) and lists the few core neighbours of other rows."""
    counts = radius_counts(vecs, eps, p=p, block_rows=block_rows)
    core = counts.where(F.col("nn") >= int(min_samples)).select("id").checkpoint(eager=True)
    flagged = vecs.select("id", "vec").join(core.withColumn("core", F.lit(True)), "id", "left").select(
        "id", "vec", F.coalesce("core", F.lit(False)).alias("core"))
    links = radius_links(flagged, eps, p=p, block_rows=block_rows).checkpoint(eager=True)
    comp = connected_components(core, links.where(~F.col("border")).select("src", "dst"))
    numbered = group_rank(comp.select("root").distinct(), [], ["root"]).select("root", F.col("grp_rank").cast("int").alias("cluster"))
    core_lab = comp.join(numbered, "root").select("id", "cluster")
    # border rows: smallest cluster among core neighbours
    nb = links.where("border").join(core_lab.select(F.col("id").alias("dst"), "cluster"), "dst").groupBy(
        F.col("src").alias("id")).agg(F.min("cluster").alias("bc"))
    lab = vecs.select("id").join(core_lab, "id", "left").join(nb, "id", "left")
    return lab.select("id", F.coalesce("cluster", "bc", F.lit(-1)).cast("int").alias("cluster"))


def clustering_quality(vecs: DataFrame, labels: DataFrame, min_points: int = 10) -> DataFrame:
    """n_clusters (excluding -1), noise_ratio, silhouette over non-noise rows
    when there are >= 2 clusters and >= min_points such rows (else NULL)."""
    lab = labels.checkpoint(eager=True)
    stats = lab.agg(F.count_distinct(F.when(F.col("cluster") != -1, F.col("cluster"))).alias("n_clusters"),
                    F.avg((F.col("cluster") == -1).cast("double")).alias("noise_ratio"),
                    F.count(F.when(F.col("cluster") != -1, 1)).alias("n_core")).first()
    sil = None
    if stats["n_clusters"] >= 2 and stats["n_core"] >= min_points:
        sil = silhouette(vecs.join(lab.where(F.col("cluster") != -1), "id")).first()["silhouette"]
    return vecs.sparkSession.createDataFrame(
        [(int(stats["n_clusters"]), float(stats["noise_ratio"]), sil)],
        "n_clusters long, noise_ratio double, silhouette double")


def mreach_forest(vecs: DataFrame, kd: DataFrame, n_graphs: int, max_w: float, block_rows: int = 512) -> DataFrame:
    """Minimum spanning forest (m, u, v, w) of every mutual-reachability graph m
    (weights max(kd_u, kd_v, d) up to ``max_w``), by Boruvka rounds: each round
    takes the cheapest outgoing edge of every component (blocked distance
    kernel, no pair table) and merges the linked components."""
    from segmetric.operators.distance import mreach_min_edges

    ms = list(range(n_graphs))
    kds = kd.groupBy("id").agg(F.array(*[F.max(F.when(F.col("m") == m, F.col("kd"))) for m in ms]).alias("kds"))
    comp = vecs.select("id", F.explode(F.array(*[F.lit(m) for m in ms])).alias("m"), F.col("id").alias("c"))
    comp = comp.checkpoint(eager=True)
    forest = []
    while True:  # each round at least halves the components that have an outgoing edge
        comps = comp.groupBy("id").agg(F.array(*[F.max(F.when(F.col("m") == m, F.col("c"))) for m in ms])
                                       .alias("comps"))
        rows = vecs.select("id", "vec").join(kds, "id").join(comps, "id")
        cand = mreach_min_edges(rows, max_w, block_rows=block_rows)
        edge = F.struct("w", F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
        cu = comp.select("m", F.col("id").alias("u"), F.col("c").alias("cu"))
        best = cand.join(cu, ["m", "u"]).groupBy("m", "cu").agg(F.min(edge).alias("e"))
        best = best.select("m", F.col("e.a").alias("a"), F.col("e.b").alias("b"), F.col("e.w").alias("w"))
        best = best.distinct().checkpoint(eager=True)
        if best.isEmpty():
            break
        forest.append(best)
        ca = comp.select("m", F.col("id").alias("a"), F.col("c").alias("src"))
        cb = comp.select("m", F.col("id").alias("b"), F.col("c").alias("dst"))
        links = best.join(ca, ["m", "a"]).join(cb, ["m", "b"]).select("m", "src", "dst")
        nodes = comp.select("m", F.col("c").alias("id")).distinct()
        merged = connected_components(nodes, links, keys=["m"]).select("m", F.col("id").alias("c"), "root")
        comp = comp.join(merged, ["m", "c"]).select("id", "m", F.col("root").alias("c")).checkpoint(eager=True)
    out = forest[0] if forest else vecs.sparkSession.createDataFrame([], "m int, a long, b long, w double")
    for f in forest[1:]:
        out = out.unionByName(f)
    return out.select("m", F.col("a").alias("u"), F.col("b").alias("v"), "w")


def dbscan_grid_labels(vecs: DataFrame, nn: DataFrame, cands: list[tuple], ms_list: list[int],
                       block_rows: int = 512) -> DataFrame:
    """(cand, id, cluster) for every candidate (cand, eps, min_samples) at once.

    Core rows of a candidate are those whose min_samples-th neighbour (the row
    itself first) is within eps; two cores are linked iff their
    mutual-reachability weight is <= eps, so the core components are the
    forest edges of weight <= eps. A border row can only reach cores closer
    than its own core distance, i.e. among its min_samples - 1 nearest rows."""
    gi = {ms: i for i, ms in enumerate(ms_list)}
    kd = nn.select(F.col("query_id").alias("id"), "rank", "distance")
    kd = kd.where(F.col("rank").isin(ms_list)).select(
        "id", F.create_map(*[x for ms, i in gi.items() for x in (F.lit(ms), F.lit(i))])[F.col("rank")].alias("m"),
        F.col("distance").alias("kd")).checkpoint(eager=True)
    max_eps = max(c[1] for c in cands)
    forest = mreach_forest(vecs, kd, len(ms_list), max_eps, block_rows)
    arr = F.array(*[F.struct(F.lit(c).alias("cand"), F.lit(e).alias("eps"), F.lit(gi[m]).alias("g"))
                    for c, e, m in cands])
    # core rows per candidate
    core = kd.select("id", "m", "kd", F.explode(F.filter(arr, lambda c: (c["g"] == F.col("m")) & (c["eps"] >= F.col("kd"))))
                     .alias("c")).select(F.col("c.cand").alias("cand"), "id").checkpoint(eager=True)
    # forest edges active per candidate
    act = forest.select("u", "v", "w", "m", F.explode(F.filter(arr, lambda c: (c["g"] == F.col("m"))
                                                              & (c["eps"] >= F.col("w")))).alias("c"))
    edges = act.select(F.col("c.cand").alias("cand"), F.col("u").alias("src"), F.col("v").alias("dst"))
    comp = connected_components(core, edges, keys=["cand"])
    roots = comp.select("cand", "root").distinct()
    numbered = group_rank(roots, ["cand"], ["root"]).select("cand", "root", F.col("grp_rank").cast("int").alias("cluster"))
    core_lab = comp.join(numbered, ["cand", "root"]).select("cand", "id", "cluster").checkpoint(eager=True)
    # border rows: nearest rows strictly inside the row's own core distance
    own = kd.select(F.col("id").alias("b"), F.col("m").alias("m"), F.col("kd").alias("kd_b"))
    near = nn.select(F.col("query_id").alias("b"), F.col("neighbor_id").alias("j"), F.col("distance").alias("d"))
    other = kd.select(F.col("id").alias("j"), F.col("m").alias("m"), F.col("kd").alias("kd_j"))
    near = near.join(own, "b").where(F.col("d") < F.col("kd_b")).join(other, ["j", "m"])
    bc = near.select("b", "j", F.explode(F.filter(arr, lambda c: (c["g"] == F.col("m")) & (c["eps"] >= F.col("d"))
                                                  & (c["eps"] >= F.col("kd_j")) & (c["eps"] < F.col("kd_b"))))
                     .alias("c")).select(F.col("c.cand").alias("cand"), "b", "j")
    border = bc.join(core_lab.select("cand", F.col("id").alias("j"), "cluster"), ["cand", "j"]).groupBy(
        "cand", F.col("b").alias("id")).agg(F.min("cluster").alias("bc"))
    ids = vecs.select("id", F.explode(F.array(*[F.lit(c[0]) for c in cands])).alias("cand"))
    lab = ids.join(core_lab, ["cand", "id"], "left").join(border, ["cand", "id"], "left")
    return lab.select("cand", "id", F.coalesce("cluster", "bc", F.lit(-1)).cast("int").alias("cluster"))


#: Bytes that the density search keeps of a row besides its vector: labels of some 126 candidates.
_SEARCH_ROW = 4 * 126


def _searched_in_blocks(vecs: DataFrame, nn: DataFrame, cands: list[tuple], ms_list: list[int], block_rows: int) -> tuple[dict, dict]:
    """(n_clusters, noise_ratio and n_core, silhouettes of the eligible ones) by candidate, for a table of any size."""
    ids = [c[0] for c in cands]
    labels = dbscan_grid_labels(vecs, nn, cands, ms_list, block_rows).checkpoint(eager=True)
    stats = {r["cand"]: r for r in labels.groupBy("cand").agg(
        F.count_distinct(F.when(F.col("cluster") != -1, F.col("cluster"))).alias("n_clusters"),
        F.avg((F.col("cluster") == -1).cast("double")).alias("noise_ratio"),
        F.count(F.when(F.col("cluster") != -1, 1)).alias("n_core")).collect()}
    eligible = [c for c in ids if stats[c]["n_clusters"] >= 2 and stats[c]["n_core"] >= 10]
    sil = {}
    if eligible:
        nz = labels.where(F.col("cand").isin(eligible) & (F.col("cluster") != -1))
        sil = {r["cand"]: r["silhouette"] for r in silhouette_batched(vecs, nz, eligible, block_rows=block_rows)
               .collect()}
    return stats, sil


def _searched_whole(held: tuple, nn: DataFrame, cands: list[tuple], ms_list: list[int]) -> tuple[dict, dict]:
    """The same for a table that a task holds whole."""
    from segmetric.operators.held_density import grid_labels

    spark = nn.sparkSession
    ids, x = held
    got = nn.select("query_id", "neighbor_id", "rank", "distance").toPandas()
    at = np.searchsorted(ids, got["query_id"]), got["rank"].to_numpy() - 1
    near, far = np.full((len(ids), max(ms_list)), -1), np.full((len(ids), max(ms_list)), np.inf)
    near[at], far[at] = np.searchsorted(ids, got["neighbor_id"]), got["distance"]
    labs = grid_labels(spark, x, near, far, cands, ms_list)
    stats = {c: {"n_clusters": int(lab.max()) + 1, "noise_ratio": float((lab == -1).mean()), "n_core": int((lab != -1).sum())}
             for (c, _, _), lab in zip(cands, labs.T)}
    eligible = [c for c in stats if stats[c]["n_clusters"] >= 2 and stats[c]["n_core"] >= 10]
    return stats, dict(zip(eligible, silhouettes_held(spark, x, labs[:, eligible]) if eligible else []))


def dbscan_search(vecs: DataFrame, min_samples_grid: list[int], eps_quantiles: list[float],
                  block_rows: int = 512, strict: bool = True):
    """K6: DBSCAN over min_samples x eps candidates, all candidates in one pass.

    One kNN join (k = largest min_samples) gives the core distances and every
    candidate list; a mutual-reachability spanning forest per min_samples gives
    the core components of every eps; the silhouettes of all eligible
    candidates share one blocked distance pass. Returns (scores sorted by
    silhouette desc then n_clusters desc, chosen_eps, chosen_min_samples); when
    every candidate is degenerate it raises, or with ``strict=False`` returns no choice."""
    spark = vecs.sparkSession
    vecs = vecs.select("id", "vec").checkpoint(eager=True)
    held = held_vectors(vecs, _SEARCH_ROW, 2 * LOCAL_BYTES)
    nn = knn_join(vecs, vecs, max(min_samples_grid), block_rows=block_rows).checkpoint(eager=True)
    cands = []
    for ms in min_samples_grid:
        kdm = nn.where(F.col("rank") == ms).select(F.lit("kdist").alias("column"), F.col("distance").alias("x"))
        q = quantiles_long(kdm, ["column"], eps_quantiles)
        e = q.select(F.explode(F.array(*[F.col("value") * F.lit(m) for m in EPS_MULTIPLIERS])).alias("eps"))
        for r in e.where(F.col("eps") > 0).distinct().orderBy("eps").collect():
            cands.append((len(cands), float(r["eps"]), int(ms)))
    stats, sil = _searched_whole(held, nn, cands, list(min_samples_grid)) if held is not None and cands else \
        _searched_in_blocks(vecs, nn, cands, list(min_samples_grid), block_rows)
    rows = [(e, float(m), float(stats[c]["n_clusters"]), float(stats[c]["noise_ratio"]), sil.get(c))
            for c, e, m in cands]
    scores = spark.createDataFrame(rows, "eps double, min_samples double, n_clusters double, "
                                         "noise_ratio double, silhouette double")
    ordered = scores.orderBy(F.desc_nulls_last("silhouette"), F.desc("n_clusters"), "eps", "min_samples")
    elig = [r for r in rows if r[2] >= 2 and r[3] < 0.8 and r[4] is not None]
    if elig:
        best = sorted(elig, key=lambda r: (-r[4], r[3], r[1], r[0]))[0]
    else:
        nondeg = [r for r in rows if r[2] >= 2]
        if not nondeg:
            if strict:
                raise ValueError("no candidate of the density search has two clusters or more")
            return ordered, None, None
        best = sorted(nondeg, key=lambda r: (r[4] is None, -(r[4] or 0.0), r[3], r[1], r[0]))[0]
    return ordered, best[0], int(best[1])


# ---------------------------------------------------------------- A6-A9, J1
def attach_labels(rows: DataFrame, labels: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Labels joined to rows by key (never by position)."""
    return rows.join(labels, id_col)


def cluster_sizes(labels: DataFrame) -> DataFrame:
    """A6."""
    return labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("count")).orderBy("cluster")


def outcome_by_cluster(labelled: DataFrame, outcome: str = "label") -> DataFrame:
    """Outcome rate and count per cluster, rate descending."""
    return labelled.groupBy("cluster").agg(F.avg(F.col(outcome).cast("double")).alias("outcome_rate"),
                                           F.count(F.lit(1)).alias("count")).orderBy(F.desc("outcome_rate"),
                                                                                      "cluster")


def profile_numeric(labelled: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and exact median of every numeric column per cluster, wide
    (``col__mean``, ``col__median``)."""
    long = to_long(labelled, cols, ["cluster"])
    means = long.groupBy("cluster", "column").agg(F.avg("x").alias("mean"))
    med = quantiles_long(long, ["cluster", "column"], [0.5]).select("cluster", "column", F.col("value").alias("median"))
    j = means.join(med, ["cluster", "column"], "full")
    wide = j.groupBy("cluster").pivot("column", cols).agg(F.first("mean").alias("mean"),
                                                          F.first("median").alias("median"))
    return wide.toDF("cluster", *[f"{c}__{s}" for c in cols for s in ("mean", "median")]).orderBy("cluster")


def profile_categorical(labelled: DataFrame, cols: list[str], top_n: int = 5) -> DataFrame:
    """Share of each category within its cluster, top n per (cluster, feature)."""
    long = labelled.select("cluster", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in cols])).alias("p"))
    counts = long.where(F.col("p.category").isNotNull()).groupBy("cluster", "p.feature", "p.category").agg(
        F.count(F.lit(1)).alias("count"))
    share = counts.withColumn("pct_in_cluster",
                              F.col("count") / F.sum("count").over(Window.partitionBy("cluster", "feature")))
    w = Window.partitionBy("cluster", "feature").orderBy(F.desc("pct_in_cluster"), "category")
    top = share.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= top_n).drop("__r")
    return top.select("cluster", "feature", "category", "pct_in_cluster", F.col("count").cast("long"))
