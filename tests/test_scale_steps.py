"""Steps whose cost must not grow with rounds, partitions or repeated values."""

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from segmetric.operators import association as A
from segmetric.operators import cluster as K
from segmetric.operators import logistic as L


def test_neighbour_information_runs_over_different_values(spark, monkeypatch):
    rnd = np.random.default_rng(2)
    rows = [(i, f, float(v), int(i % 3 == 0)) for i in range(120) for f, v in (("two", i % 2), ("many", round(rnd.normal(), 1)), ("one", 7))]
    long = spark.createDataFrame(rows, "row_id long, feature string, x double, label int")
    ranked, plain = [], A.group_rank
    monkeypatch.setattr(A, "group_rank", lambda df, *a, **k: ranked.append(df.count()) or plain(df, *a, **k))
    got = {r.feature: r.mi for r in A.mutual_info_knn(long, 3).collect()}
    assert ranked == [len({(f, y, x) for _, f, x, y in rows})]

    def psi(n):
        return -0.5772156649015329 + sum(1 / j for j in range(1, int(n)))

    for f in got:
        x, y = (np.array([r[c] for r in rows if r[1] == f]) for c in (2, 3))
        k = {c: min(3, (y == c).sum() - 1) for c in (0, 1)}
        rad = [np.sort(np.abs(x[y == y[i]] - x[i]))[k[y[i]]] for i in range(len(x))]
        m = [(np.abs(x - x[i]) < r).sum() if r > 0 else (x == x[i]).sum() for i, r in enumerate(rad)]
        want = psi(len(x)) + np.mean([psi(k[c]) - psi((y == c).sum()) for c in y]) - np.mean([psi(c) for c in m])
        assert abs(got[f] - max(want, 0)) < 1e-6, f


def test_a_row_that_comes_twice_is_averaged_once(spark):
    rnd = np.random.default_rng(8)
    rows = [(i, "f", float(round(rnd.normal(), 2)), i % 2) for i in range(60)]
    rows += rows[::5]
    long = spark.createDataFrame(rows, "row_id long, feature string, x double, label int")
    x, y, ids = (np.array([r[c] for r in rows]) for c in (2, 3, 0))

    def psi(n):
        return -0.5772156649015329 + sum(1 / j for j in range(1, int(n)))

    terms = []
    for i in np.unique(ids):
        copies = np.flatnonzero(ids == i)
        n_c = (y == y[copies[0]]).sum()
        far = np.sort(np.concatenate([np.abs(x - x[c])[(y == y[c]) & (np.arange(len(x)) != c)] for c in copies]))
        r = far[2]
        m = (np.abs(x - x[copies[0]]) < r).sum() if r > 0 else (x == x[copies[0]]).sum()
        terms.append(psi(3) - psi(n_c) - psi(m))
    assert abs(A.mutual_info_knn(long, 3).first().mi - max(psi(60) + np.mean(terms), 0)) < 1e-6


def test_lloyd_rounds_compute_their_columns_once(spark):
    rnd = np.random.default_rng(4)
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        read.add(1)
        return x

    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rnd.normal(size=90))], "row_id long, a double")
    df = df.withColumn("b", seen("a"))
    labels, centres = K.lloyd_kmeans(df, ["b"], [[0.0], [0.01], [0.02]])
    assert read.value == 90 and len(centres) == 3
    assert all(r.cluster == int(np.argmin([(r.a - c[0]) ** 2 for c in centres])) for r in labels.collect())


def test_nearest_centre_takes_the_smaller_of_equal_ones(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (None,), (float("nan"),)], "a double")
    got = [r[0] for r in df.select(K.nearest_centre(["a"], [[2.0], [0.0], [0.0]])).collect()]
    assert got == [1, 0, 0, 0, 0]


def test_kmeans_fits_use_no_more_tasks_than_two_a_core(spark, monkeypatch):
    df = spark.range(400).repartition(90).select(array_to_vector(F.array((F.col("id") % 7).cast("double"))).alias("features"))
    seen, plain = [], K.KMeans.fit
    monkeypatch.setattr(K.KMeans, "fit", lambda self, data, *a: seen.append(data.rdd.getNumPartitions()) or plain(self, data, *a))
    K.fit_kmeans(df, 2, n_init=2)
    assert len(seen) == 2 and max(seen) <= 2 * spark.sparkContext.defaultParallelism


def test_logistic_sums_take_one_exponential_and_hold_far_out(monkeypatch):
    import pandas as pd
    def refused(*_):
        raise AssertionError("a second exponential")
    monkeypatch.setattr(np, "logaddexp", refused)
    x, y = np.array([[-900.0], [-3.0], [0.0], [2.0], [800.0]]), np.array([1.0, 0.0, 1.0, 1.0, 0.0])
    pdf = pd.DataFrame({"x": list(x), "label": y, "fold": 0})
    out = next(L._sums([(0, L.LogisticModel("x"), np.array([1.0, 0.0]), (1.0, 1.0))])([pdf]))["value"].to_numpy()
    z = x[:, 0]
    loss = np.where(z > 0, z + np.log1p(np.exp(-np.abs(z))), np.log1p(np.exp(-np.abs(z)))) - y * z
    assert abs(out[0] - loss.sum()) < 1e-9 and abs(out[2] - (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y).sum()) < 1e-12
