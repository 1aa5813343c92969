"""Blocked distance operators and DBSCAN against brute force on small fixtures.

Tiny block sizes force many blocks and split hot grid cells, so the salting
and merge paths run even on a few hundred rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmetric.operators import cluster as K
from segmetric.operators import distance as D


def _points(spark, pts):
    return spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(pts)], "id long, vec array<double>")


def _fixture(n=220, seed=7):
    rng = np.random.default_rng(seed)
    hot = rng.normal(0, 0.05, size=(n // 3, 2))           # one dense cell holding a third of the rows
    rest = rng.uniform(-2, 2, size=(n - n // 3, 2))
    return np.vstack([hot, rest])


def _sk_dbscan(x, eps, ms):
    """Sequential DBSCAN in id order (the semantics to match)."""
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    nb = [np.nonzero(d[i] <= eps)[0] for i in range(len(x))]
    core = np.array([len(v) >= ms for v in nb])
    lab = -np.ones(len(x), int)
    c = 0
    for i in range(len(x)):
        if lab[i] != -1 or not core[i]:
            continue
        lab[i] = c
        stack = [i]
        while stack:
            j = stack.pop()
            for k in nb[j]:
                if lab[k] == -1:
                    lab[k] = c
                    if core[k]:
                        stack.append(k)
        c += 1
    return lab


def test_radius_join_matches_brute_force(spark):
    x = _fixture()
    got = {(r.i, r.j) for r in D.radius_join(_points(spark, x), 0.3, block_rows=16).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    exp = {(int(i), int(j)) for i, j in zip(*np.nonzero(d <= 0.3))}
    assert got == exp


def test_knn_join_matches_brute_force(spark):
    x = _fixture(150)
    got = {(r.query_id, r.rank): r.neighbor_id for r in D.knn_join(_points(spark, x), _points(spark, x), 4,
                                                                      block_rows=20).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    for i in range(len(x)):
        order = np.lexsort((np.arange(len(x)), d[i]))[:4]
        assert [got[(i, r + 1)] for r in range(4)] == list(order)


def test_silhouette_matches_brute_force(spark):
    x = _fixture(120)
    lab = (x[:, 0] > 0).astype(int) + (x[:, 1] > 1).astype(int)
    df = spark.createDataFrame([(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(x, lab))],
                               "id long, vec array<double>, cluster int")
    got = D.silhouette(df, block_rows=17).first().silhouette
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) - {lab[i]})
        s.append((b - a) / max(a, b))
    assert got == pytest.approx(np.mean(s))


def test_dbscan_matches_sequential_scan(spark):
    x = _fixture()
    v = _points(spark, x)
    got = dict(K.dbscan(v, 0.25, 4, block_rows=16).select("id", "cluster").collect())
    exp = _sk_dbscan(x, 0.25, 4)
    assert [got[i] for i in range(len(x))] == list(exp)


def test_dbscan_search_batched_equals_single_runs(spark):
    x = _fixture(160, seed=3)
    v = _points(spark, x)
    scores, eps, ms = K.dbscan_search(v, [3, 5], [0.5, 0.9], block_rows=32)
    rows = scores.collect()
    for r in rows[:3] + rows[-3:]:
        lab = K.dbscan(v, r.eps, int(r.min_samples), block_rows=32)
        q = K.clustering_quality(v, lab).first()
        assert q.n_clusters == r.n_clusters and q.noise_ratio == pytest.approx(r.noise_ratio)
        if q.silhouette is None:
            assert r.silhouette is None
        else:
            assert q.silhouette == pytest.approx(r.silhouette)


def test_connected_components_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101)], "src long, dst long")
    verts = spark.range(0, 102).select(F.col("id"))
    cc = {r.id: r.root for r in K.connected_components(verts, edges).collect()}
    assert all(cc[i] == 0 for i in range(61)) and cc[100] == cc[101] == 100 and cc[80] == 80


def test_scale_options_run(spark):
    """LSH kNN can only miss neighbours (its k-th distance is never smaller);
    the squared-distance silhouette is in [-1, 1]."""
    x = _fixture(120)
    v = _points(spark, x)
    exact = {r.query_id: r.distance for r in D.knn_join(v, v, 3, block_rows=40).where("rank = 3").collect()}
    approx = D.approx_knn_join(v, v, 3, bucket_length=1.0, num_hash_tables=4)
    for r in approx.where("rank = 3").collect():
        assert r.distance >= exact[r.query_id] - 1e-12
    from pyspark.ml.functions import array_to_vector

    lab = (x[:, 0] > 0).astype(int)
    df = spark.createDataFrame([(i, [float(a) for a in p], int(c)) for i, (p, c) in enumerate(zip(x, lab))],
                               "id long, vec array<double>, cluster int").withColumn("features", array_to_vector("vec"))
    s = D.silhouette_squared(df)
    assert -1.0 <= s <= 1.0


def test_self_knn_symmetric_blocks_match_general_path(spark):
    """The self-join path (pairs lb <= rb) equals the general two-sided path."""
    x = _fixture(170, seed=11)
    v = _points(spark, x)
    w = _points(spark, x)  # a different object: general path
    a = sorted((r.query_id, r.rank, r.neighbor_id) for r in D.knn_join(v, v, 5, block_rows=23).collect())
    b = sorted((r.query_id, r.rank, r.neighbor_id) for r in D.knn_join(v, w, 5, block_rows=23).collect())
    assert a == b and len(a) == 5 * len(x)
