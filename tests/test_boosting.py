"""Boosting: both ways of fitting against each other and against a plain booster."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from segmetric.operators import boosting as B
from segmetric.operators import tune as M
from segmetric.operators.classify import boosted_model, fit_and_score


def table(spark, n=300, seed=1):
    rnd = np.random.default_rng(seed)
    x = np.round(rnd.normal(size=(n, 4)) * [1, 1, 5, 1], [1, 2, 0, 1][0])
    x[:, 3] = 7.0  # constant
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rnd.random(n) < 0.1)).astype(int)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i]), i % 3) for i in range(n)],
                               "row_id long, x array<double>, label int, fold int")
    return df, x, y


def bins_of(df, fold=None):
    rows = df.withColumn("key", F.xxhash64("row_id"))
    edges = B.bin_edges(rows, {"x": fold})["x"]
    return rows.withColumn("x", B.binned("x", edges)).cache(), edges


@pytest.mark.parametrize("form", [
    dict(rounds=3, depth=3, leaves=31, least_rows=5), dict(rounds=3, depth=None, leaves=6, least_rows=2, l2=0.5, held_out=1),
    dict(rounds=3, depth=4, leaves=None, least_rows=1, least_hessian=1.0, l2=1.0, least_gain=0.2, subsample=0.7, colsample=0.5,
         balanced=True)])
def test_a_gathered_and_a_spread_table_give_the_same_trees(spark, form):
    rows, _ = bins_of(table(spark)[0])
    models = [B.BoostedModel("x", **form), B.BoostedModel("x", rounds=2, size=2)]
    one = B.fit_boosted(rows, models)
    many = B.fit_boosted(rows.repartition(7), models, local_bytes=0)
    for a, b in zip(one, many):
        assert a.start == b.start and len(a.trees) == len(b.trees) == a.model.rounds
        assert all((s == t).all() for s, t in zip(a.trees, b.trees))
    assert max(len(t) for t in one[0].trees) > 1


def plain(x, y, rounds, rate, leaves, least_rows, l2):
    """Best-first trees by trying every cut of every leaf, in floating point."""
    start = np.log(y.mean() / (1 - y.mean()))
    margin = np.full(len(y), start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h, parts = p - y, p * (1 - p), [np.arange(len(y))]

        def best(part):
            top = (1e-9, None)
            for s in range(x.shape[1]):
                for v in np.unique(x[part, s])[:-1]:
                    lo, hi = part[x[part, s] <= v], part[x[part, s] > v]
                    if min(len(lo), len(hi)) >= least_rows:
                        gain = sum(g[q].sum() ** 2 / (h[q].sum() + l2) for q in (lo, hi)) - g[part].sum() ** 2 / (h[part].sum() + l2)
                        if gain > top[0] + 1e-9:
                            top = (gain, (lo, hi))
            return top

        cuts = [best(parts[0])]
        while len(parts) < leaves and max(c[0] for c in cuts) > 1e-9 and any(c[1] for c in cuts):
            i = int(np.argmax([c[0] if c[1] else 0 for c in cuts]))
            lo, hi = cuts[i][1]
            parts[i:i + 1], cuts[i:i + 1] = [lo, hi], [best(lo), best(hi)]
        for q in parts:
            margin[q] -= rate * g[q].sum() / (h[q].sum() + l2)
    return margin


def test_leaf_wise_trees_equal_a_plain_booster(spark):
    df, x, y = table(spark, 150)
    rows, edges = bins_of(df)
    f = B.fit_boosted(rows, [B.BoostedModel("x", rounds=4, rate=0.3, leaves=7, least_rows=4, l2=0.7)])[0]
    got = rows.select("row_id", B.score(f).alias("s")).orderBy("row_id").toPandas()["s"].to_numpy()
    assert np.allclose(got, 1 / (1 + np.exp(-plain(x, y, 4, 0.3, 7, 4, 0.7))), atol=1e-6)
    assert len(edges[3]) == 0


def test_stages_equal_separate_fits(spark):
    df, _, _ = table(spark)
    data = df.select("row_id", array_to_vector("x").alias("features"), "label", "fold").cache()
    cands = [{"max_iter": n, "max_depth": d, "learning_rate": 0.2} for n in (2, 5) for d in (2, 3)]
    got = {(r.param_id, r.fold): (r.train_f1, r.test_f1) for r in M.fold_scores(data, "xgb", cands, k=3, balance_rows=False).collect()}
    for pid, c in enumerate(cands):
        for i in (0, 2):
            s = fit_and_score({"kind": "xgb", "params": c, "class_weight": None}, data.where(F.col("fold") != i), data)
            r = s.join(data, "row_id").where(F.col("fold") == i).agg(
                F.sum(F.col("pred") * F.col("label")).alias("tp"), F.sum(F.col("pred") + F.col("label")).alias("both")).first()
            assert got[pid, i][1] == pytest.approx(2 * r["tp"] / r["both"])


def test_many_values_are_cut_at_quantiles_and_rare_cases(spark):
    df = spark.range(2000).select(F.col("id").alias("row_id"), F.array(F.col("id") * 1.0, F.lit(2.0)).alias("x"),
                                  (F.col("id") >= 1500).cast("int").alias("label"), F.lit(0).alias("fold"))
    rows, edges = bins_of(df)
    assert len(edges[0]) == 255 and len(edges[1]) == 0
    f = B.fit_boosted(rows, [B.BoostedModel("x", rounds=1, rate=1.0)])[0]
    assert f.trees[0]["left"][0] == 1
    with pytest.raises(ValueError):
        B.fit_boosted(rows.limit(0), [B.BoostedModel("x")])
    only = B.fit_boosted(rows.where("label = 1"), [B.BoostedModel("x", rounds=2)])[0]  # one class: no cut
    assert [len(t) for t in only.trees] == [1, 1]


def test_settings_of_another_form_are_refused():
    with pytest.raises(ValueError):
        boosted_model("hgb", "x", subsample=0.5)
    with pytest.raises(ValueError):
        boosted_model("xgb", "x", max_leaf_nodes=5)
    assert boosted_model("hgb", "x").depth is None and boosted_model("xgb", "x").least_rows == 1


@pytest.mark.parametrize("slots", [np.arange(14), np.array([0, 4, 11, 13])])
def test_packed_sums_are_those_of_every_slot_and_siblings_are_known_by_difference(slots, monkeypatch):
    rnd = np.random.default_rng(4)
    bins = np.column_stack([rnd.integers(0, 256, (500, 2)), rnd.integers(0, 2, (500, 11)), np.zeros(500)]).astype(np.uint8)
    g, h, node = np.rint(rnd.normal(size=500) * B.SCALE), np.rint(rnd.random(500) * B.SCALE), rnd.integers(0, 5, 500)
    got = B.partial_sums(B.Packed(bins), g, h, node, [4, 1], slots)
    for i, n in enumerate([4, 1]):
        for j, s in enumerate(slots):
            for k, v in enumerate((g, h, np.ones(500))):
                assert (got[k, i, j] == np.bincount(bins[node == n, s], v[node == n], 256)).all()
    m, two = B.BoostedModel("x", least_rows=5), B.Packed(bins).two[slots]
    for a, b in zip(B.best_cuts(got, m, two), B.best_bins(got, m)):
        assert (a == b).all()
    read, plain = [], B.partial_sums
    monkeypatch.setattr(B, "partial_sums", lambda p, g, h, at, ask, slots: read.append(np.isin(at, ask).sum()) or plain(p, g, h, at, ask, slots))
    table = {"label": (bins[:, 0] > 100).astype(int) ^ (rnd.random(500) < 0.2), "fold": np.zeros(500, int), "key": np.arange(500), "x": bins}
    B._fit_one(B.BoostedModel("x", rounds=1, depth=2, leaves=None, least_rows=1), 0.0, (1.0, 1.0), table)
    assert read[0] == 500 and read[1] <= 250  # the larger child is not read again
