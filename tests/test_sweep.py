"""All runs of a K-Means sweep share their passes; silhouettes of many labelings share the distances."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from segmetric.operators import cluster as K
from segmetric.operators import distance as D


def _rows(spark, n=150, d=4, seed=7, twice=False):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, d)) + 3 * rnd.integers(0, 2, size=(n, d))
    ids = [i // 2 if twice else i for i in range(n)]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in zip(ids, x)], "row_id long, x array<double>").repartition(3)
    return df.withColumn("features", array_to_vector("x")).drop("x").checkpoint()


def test_sweep_runs_its_rounds_together_and_finds_what_single_fits_find(spark, monkeypatch):
    df, asked = _rows(spark), []
    single = {k: K.fit_kmeans(df, k, n_init=3, seed=42) for k in (2, 3, 5)}
    vecs = df.select("row_id", "features").withColumnRenamed("row_id", "id")
    want = {}
    for k, f in single.items():
        lab = K.canonical_labels(f, df)
        v = vecs.join(lab.withColumnRenamed("row_id", "id"), "id").select("id", K.vector_to_array("features").alias("vec"), "cluster")
        want[k] = D.silhouette(v).first()["silhouette"]

    class Counted(K.KMeans):
        def fit(self, *a, **k):
            asked.append(self.getMaxIter())
            return super().fit(*a, **k)

    monkeypatch.setattr(K, "KMeans", Counted)
    scores, chosen, fits = K.kmeans_sweep(df, [2, 3, 5], n_init=3, seed=42)
    assert asked == [0] * 9  # Spark ML gives the starts alone
    got = {int(r.k): r for r in scores.collect()}
    for k, f in single.items():
        assert fits[k].cost == pytest.approx(f.cost, rel=1e-9)  # seeds that end alike differ in the last digits only
        a, b = (sorted(map(tuple, np.round(m.model.clusterCenters(), 9))) for m in (fits[k], f))
        assert np.allclose(a, b)
        assert got[k].silhouette == pytest.approx(want[k], abs=1e-9)
        told = {r.row_id: r.cluster for r in K.canonical_labels(fits[k], df).collect()}
        assert told == {r.row_id: r.cluster for r in K.canonical_labels(f, df).collect()}
    assert chosen == min(want, key=lambda k: (-want[k], k))


def test_repeated_ids_and_large_tables_give_the_silhouettes_of_before(spark, monkeypatch):
    for twice in (False, True):
        df = _rows(spark, n=60, twice=twice)
        fits = [K.fit_kmeans(df, k, n_init=2) for k in (2, 4)]
        fits = [K.KMeansFit(K.Centres(np.array(f.model.clusterCenters()), "features"), f.cost, f.seed) for f in fits]
        vecs = df.select(K.F.col("row_id").alias("id"), K.vector_to_array("features").alias("vec"))
        want = [D.silhouette(vecs.join(K.canonical_labels(f, df).withColumnRenamed("row_id", "id"), "id")).first()["silhouette"] for f in fits]
        assert K._sweep_silhouettes(df, vecs, fits, "row_id") == pytest.approx(want, abs=1e-9)
        monkeypatch.setattr(K, "held_vectors", lambda *a, **k: None)
        assert K._sweep_silhouettes(df, vecs, fits, "row_id") == pytest.approx(want, abs=1e-9)
        monkeypatch.undo()


def test_silhouettes_held_whole_leave_out_rows_and_know_single_rows(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(90, 3))
    labs = np.column_stack([rnd.integers(-1, 4, 90), np.where(np.arange(90) < 1, 7, rnd.integers(0, 2, 90)), np.zeros(90, int),
                            np.full(90, -1)])
    got = D.silhouettes_held(spark, x, labs)
    for c in (0, 1):
        use = np.flatnonzero(labs[:, c] >= 0)
        d, lab = np.sqrt(((x[use][:, None] - x[use]) ** 2).sum(-1)), labs[use, c]
        s = []
        for i in range(len(use)):
            own = (lab == lab[i]).sum()
            a = d[i, lab == lab[i]].sum() / (own - 1) if own > 1 else 0
            b = min(d[i, lab == o].mean() for o in set(lab) - {lab[i]})
            s.append((b - a) / max(a, b) if own > 1 else 0.0)
        assert got[c] == pytest.approx(np.mean(s))
    assert got[2] == 0.0 and got[3] is None
