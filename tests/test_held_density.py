"""The density search of a table held whole is that of the blocked plan."""

import numpy as np
import pytest

from segmetric.operators import cluster as K
from segmetric.operators import held_density as H
from segmetric.operators.distance import pair_distances


def _points(seed=2):
    rnd = np.random.default_rng(seed)
    x = np.concatenate([rnd.normal(size=(40, 2)), 6 + 0.5 * rnd.normal(size=(30, 2)), rnd.uniform(-9, 14, size=(25, 2)),
                        np.round(rnd.normal(size=(25, 2))) - 9])  # ties and equal points
    return x


def _vecs(spark, x, twice=False):
    rows = [(3 * i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows + rows[:7] * twice, "id long, vec array<double>").repartition(3)


def test_search_of_a_held_table_equals_the_blocked_one(spark, monkeypatch):
    v = _vecs(spark, _points())
    with monkeypatch.context() as m:
        m.setattr(K, "held_vectors", lambda *a, **k: None)
        want = K.dbscan_search(v, [2, 4], [0.5, 0.9, 0.99])
    with monkeypatch.context() as m:
        m.setattr(K, "dbscan_grid_labels", lambda *a, **k: pytest.fail("the table fits a task"))
        got = K.dbscan_search(v, [2, 4], [0.5, 0.9, 0.99])
    assert got[1:] == want[1:]
    a, b = (sorted(tuple(r)[:4] + (r.silhouette if r.silhouette is None else round(r.silhouette, 9),) for r in s[0].collect()) for s in (got, want))
    assert a == b and any(r[2] >= 2 for r in a)


def test_repeated_ids_take_the_blocked_plan(spark, monkeypatch):
    called, plain = [], K.dbscan_grid_labels
    monkeypatch.setattr(K, "dbscan_grid_labels", lambda *a, **k: called.append(1) or plain(*a, **k))
    K.dbscan_search(_vecs(spark, _points(), twice=True), [2], [0.9], strict=False)
    assert called == [1]


def test_forest_has_the_components_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(H, "_COLUMNS", 16)
    x = _points(5)
    d = pair_distances(x, x)
    for ms in (1, 3):
        kd = np.sort(d, axis=1)[:, ms - 1]
        kd[:3] = np.inf  # never core
        w = np.maximum(d, np.maximum(kd[:, None], kd))
        shared = spark.sparkContext.broadcast(x)
        u, v, got = H.forest(spark, shared, kd, 5.0)
        assert np.allclose(got, w[u, v], rtol=0, atol=0) and len(u) < 2 * len(x)  # both ends may name an edge
        for eps in (*np.unique(got)[::7], 5.0):
            core = kd <= eps
            root = H._local_roots(len(x), [(u[got <= eps], v[got <= eps])])
            i, j = np.nonzero((w <= eps) & core[:, None] & core)
            true = H._local_roots(len(x), [(i, j)])
            assert root[core].tolist() == true[core].tolist()
