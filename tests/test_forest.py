"""Forests grown in tasks: against plain cuts, against Spark ML's forests, and whatever the partitions."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from segmetric.operators import classify as C
from segmetric.operators import forest as T


def table(spark, n=400, seed=3):
    rnd = np.random.default_rng(seed)
    x = np.round(rnd.normal(size=(n, 5)), 1)
    x[:, 4] = 7.0  # constant
    y = ((x[:, 0] + x[:, 1] > 0) ^ (rnd.random(n) < 0.1)).astype(int)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i])) for i in range(n)], "row_id long, x array<double>, label int")
    return df.select("row_id", "label", array_to_vector("x").alias("features")), x, y


def gini_gain(y, w, lo):
    def imp(part):
        a, b = w[0] * (y[part] == 0).sum(), w[1] * (y[part] == 1).sum()
        return 2 * a * b / (a + b)
    return imp(np.ones(len(y), bool)) - imp(lo) - imp(~lo)


@pytest.mark.parametrize("dense", [True, False])
def test_the_first_cut_is_the_best_of_all_cuts(dense, monkeypatch):
    rnd = np.random.default_rng(5)
    bins = rnd.integers(0, 6, (60, 3)).astype(np.uint8)
    y = (rnd.random(60) < bins[:, 1] / 6).astype(np.int64)
    if not dense:  # sums by sorting in place of counting by cell
        whole = T._cells
        monkeypatch.setattr(T, "_cells", lambda key, count, size: whole(key, count, 10 ** 9))
    model = T.Forest(1, 2, 4, 3, False, (0.7, 1.9), 1)
    tree = T.grow(bins, y, model, 0)
    best = max((gini_gain(y, model.weights, bins[:, s] <= c), s, c) for s in range(3) for c in range(5)
               if min((bins[:, s] <= c).sum(), (bins[:, s] > c).sum()) >= 4)
    mine = gini_gain(y, model.weights, bins[:, tree["slot"][0]] <= tree["bin"][0])
    assert mine == pytest.approx(best[0]) and tree["left"][0] == 1
    # a leaf's share is that of the rows that reach it
    from segmetric.operators.boosting import descend
    at = descend(tree, bins)
    for leaf in np.unique(at):
        w1, w0 = 1.9 * (y[at == leaf] == 1).sum(), 0.7 * (y[at == leaf] == 0).sum()
        assert tree["value"][leaf] / T.SHARE == pytest.approx(w1 / (w0 + w1)) and (at == leaf).sum() >= 4


def test_deep_trees_without_draws_fit_their_rows():
    rnd = np.random.default_rng(6)
    bins = np.unique(rnd.integers(0, 32, (3000, 4)).astype(np.uint8), axis=0)
    y = rnd.integers(0, 2, len(bins))
    tree = T.grow(bins, y, T.Forest(1, 30, 1, 2, False, (1.0, 1.0), 1), 0)
    from segmetric.operators.boosting import descend
    # a node whose drawn columns give no gain stays a leaf, as in Spark ML
    assert (tree["value"][descend(tree, bins)] == y * T.SHARE).mean() > 0.98 and len(tree) > 1000


@pytest.mark.parametrize("kind", ["rf", "et"])
def test_scores_agree_with_spark_ml_and_do_not_depend_on_partitions(spark, kind):
    train, x, y = table(spark)
    spec = {"kind": kind, "params": dict(n_estimators=60, max_depth=5, min_samples_leaf=3, seed=7), "class_weight": "balanced"}
    got = {r.row_id: r for r in C.fit_and_score(spec, train, train).collect()}
    again = {r.row_id: r for r in C.fit_and_score(spec, train.repartition(5), train.repartition(3)).collect()}
    assert got == again and len(got) == 400
    assert all(r.pred == int(r.score > 0.5) for r in got.values())
    tw = C.with_class_weight(train.withColumn("label", F.col("label").cast("double")), "label", "weight")
    old = C.positive_score(C._BUILDERS[kind](**spec["params"]).setWeightCol("weight").fit(tw).transform(train)).collect()
    apart = [abs(r.score - got[r.row_id].score) for r in old]
    assert np.mean(apart) < 0.05, np.mean(apart)
    same = np.mean([r.pred == got[r.row_id].pred for r in old])
    assert same > 0.95


def test_tables_too_large_for_a_task_go_to_spark_ml(spark):
    train, _, _ = table(spark)
    train = train.withColumn("label", F.col("label").cast("double"))
    assert C._fit_local_forest("rf", dict(n_estimators=4, seed=1), True, train, train, local_bytes=400 * (5 + 16) - 1) is None
    assert C._fit_local_forest("rf", dict(n_estimators=4, seed=1), True, train, train, local_bytes=400 * (5 + 16)) is not None


def test_drawn_slots_read_the_settings_as_spark_does():
    assert [T.drawn_slots(v, 43) for v in ("sqrt", "log2", None, 5, 0.5, 100)] == [7, 6, 43, 5, 22, 43]
    with pytest.raises(ValueError):
        T.drawn_slots(0, 43)
