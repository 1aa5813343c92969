"""Boosted fits over tables of any size leave nothing behind that grows with the rounds."""

import os

import numpy as np
from pyspark.sql import functions as F

from segmetric.operators import boosting as B


def _rows(spark, n=300, seed=4):
    rnd = np.random.default_rng(seed)
    x = np.column_stack([rnd.integers(0, 40, (n, 2)), rnd.integers(0, 2, (n, 3))]).astype(np.uint8)
    y = (x[:, 0] + 9 * x[:, 2] + rnd.normal(0, 8, n) > 24).astype(int)
    rows = [(i * 31, int(y[i]), i % 3, bytearray(x[i].tobytes())) for i in range(n)]
    return spark.createDataFrame(rows, "key long, label int, fold int, x binary").repartition(3).cache()


def _folders(spark):
    top = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {d for d in os.listdir(top) if d.startswith("rdd-")}


def test_passes_over_large_tables_make_no_plans_and_keep_no_checkpoint(spark, monkeypatch):
    rows = _rows(spark)
    models = [B.BoostedModel("x", rounds=12, depth=3, leaves=None, least_rows=5, held_out=1),
              B.BoostedModel("x", rounds=11, leaves=6, least_rows=5, subsample=0.7, colsample=0.6, size=4)]
    whole = B.fit_boosted(rows, models)
    planned, plain, before = [], type(rows).mapInPandas, _folders(spark)
    monkeypatch.setattr(type(rows), "mapInPandas", lambda *a, **k: planned.append(1) or plain(*a, **k))
    steps = B.fit_boosted(rows, models, local_bytes=0)
    assert len(planned) == 1  # the rows are packed once; passes are no SQL jobs
    assert _folders(spark) == before
    for a, b in zip(whole, steps):
        assert a.start == b.start and len(a.trees) == len(b.trees)
        assert all(np.array_equal(s, t) for s, t in zip(a.trees, b.trees))


def test_a_model_without_rows_in_a_block_still_grows(spark):
    rows = _rows(spark, 60).unionByName(_rows(spark, 1).withColumn("fold", F.lit(1)))
    m = [B.BoostedModel("x", rounds=2, depth=2, least_rows=3, held_out=1)]
    a, b = B.fit_boosted(rows, m)[0], B.fit_boosted(rows, m, local_bytes=0)[0]
    assert all(np.array_equal(s, t) for s, t in zip(a.trees, b.trees))


def test_margins_and_sums_come_from_row_lists(monkeypatch):
    rnd = np.random.default_rng(9)
    bins = np.column_stack([rnd.integers(0, 200, (900, 3)), rnd.integers(0, 2, (900, 3))]).astype(np.uint8)
    y = (bins[:, 0] + 40 * bins[:, 4] + rnd.normal(0, 30, 900) > 120).astype(int)
    table = {"label": y, "fold": np.arange(900) % 3, "key": np.arange(900), "x": bins}
    m = B.BoostedModel("x", rounds=4, leaves=9, least_rows=5, held_out=2, size=5)
    monkeypatch.setattr(B, "descend", lambda *a: 1 / 0)  # rows are not sent down whole trees
    trees = B._fit_one(m, -0.3, (1.0, 2.0), table)
    monkeypatch.undo()
    keep = np.arange(900) % 3 != 2
    margin = B.Fitted(m, -0.3, trees).margins(bins[keep])[0]
    g, h = B._gradients(B.Fitted(m, -0.3, trees[:3]).margins(bins[keep])[0], y[keep], np.where(y[keep] == 1, 2.0, 1.0))
    at = B.descend(trees[3], bins[keep])
    for leaf in np.flatnonzero(trees[3]["left"] < 0):
        assert np.isclose(trees[3]["value"][leaf], -m.rate * (g[at == leaf].sum() / B.SCALE) / (h[at == leaf].sum() / B.SCALE))
    assert np.isfinite(margin).all() and len({len(t) for t in trees}) == 1


def test_row_lists_follow_the_tree_that_was_tried():
    columns = np.array([[0, 1, 2, 3], [5, 5, 6, 6]], np.uint8)

    class Tried:
        left, cut = [1, -1, 3, -1, -1], [(1, 0, 0, None), None, (1, 1, 5, None), None, None]

    lists = B._RowLists(Tried, columns)
    assert [r.tolist() for r in lists.of([4, 1, 3])] == [[2, 3], [0], [1]] and lists.of([0]) == [None]
