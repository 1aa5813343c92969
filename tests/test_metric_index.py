"""The pivot index against brute force: ties, copies, a hot cell, both metrics, and fewer distances than all pairs."""

import math

import numpy as np
import pytest

from segmetric.operators import distance as D
from segmetric.operators.metric_index import pivot_index


def _points(spark, x, first=0):
    return spark.createDataFrame([(first + i, None if p is None else [float(v) for v in p]) for i, p in enumerate(x)],
                                 "id long, vec array<double>")


def _brute(q, r, k, p, exclude_self, first=0):
    d = D.pair_distances(q, r, p)
    out = set()
    for i in range(len(q)):
        ranked = sorted((d[i, j], j) for j in range(len(r)) if math.isfinite(d[i, j]) and not (exclude_self and first + i == j))
        out |= {(first + i, n + 1, j, round(v, 9)) for n, (v, j) in enumerate(ranked[:k])}
    return out


def _got(df):
    return [(r.query_id, r.rank, r.neighbor_id, round(r.distance, 9)) for r in df.collect()]


def _clumps(n, dim, seed):
    rng = np.random.default_rng(seed)
    hot = rng.normal(0, 0.01, size=(n // 3, dim))             # a third of all rows in one cell
    copies = np.repeat(rng.normal(3, 1, size=(1, dim)), 40, axis=0)
    rest = rng.integers(-6, 7, size=(n - n // 3 - 40, dim)) / 2.0   # a lattice: many ties
    return np.vstack([hot, copies, rest])


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_self_join_with_ties_copies_and_a_hot_cell(spark, p, exclude_self):
    x = _clumps(240, 3, 5)
    rows = _points(spark, x)
    got = _got(pivot_index(rows, p=p, block_rows=16, max_pivots=6, max_units=60).knn(rows, 4, exclude_self))
    assert len(got) == len(set(got))
    assert set(got) == _brute(x, x, 4, p, exclude_self)


def test_other_queries_and_more_neighbours_than_any_unit_holds(spark):
    x = _clumps(200, 2, 9)
    q = np.random.default_rng(1).uniform(-5, 5, size=(30, 2))
    got = _got(pivot_index(_points(spark, x), block_rows=8).knn(_points(spark, q, 1000), 50))
    assert len(got) == len(set(got)) == 30 * 50
    assert set(got) == _brute(q, x, 50, 2, False, 1000)
    few = _got(pivot_index(_points(spark, x[:3]), block_rows=8).knn(_points(spark, q, 1000), 5))
    assert set(few) == _brute(q, x[:3], 5, 2, False, 1000)


def test_null_infinite_and_missing_rows(spark):
    x = [(0.0, 0.0), None, (float("inf"), 0.0), (float("nan"), 1.0), (1.0, 0.0), (0.0, 0.0), (1e200, 0.0)]
    rows = _points(spark, x)
    got = {r[:3] for r in _got(pivot_index(rows, block_rows=2).knn(rows, 2))}
    assert {r for r in got if r[0] in (0, 4, 5)} == {(0, 1, 0), (0, 2, 5), (4, 1, 4), (4, 2, 0), (5, 1, 0), (5, 2, 5)}
    assert not {r[0] for r in got} & {1, 2, 3} and not {r[2] for r in got} & {1, 2, 3}
    empty = rows.where("id < 0")
    assert pivot_index(empty).knn(rows, 2).count() == 0
    assert pivot_index(rows).knn(empty, 2).count() == 0


def test_fewer_distances_than_all_pairs(spark):
    rng = np.random.default_rng(3)
    centres = rng.uniform(-50, 50, size=(12, 4))
    x = np.vstack([c + rng.normal(0, 0.5, size=(50, 4)) for c in centres])
    rows = _points(spark, x)
    index = pivot_index(rows, block_rows=25)
    found = index.first_pass(rows, 5).select("home", "visits").collect()
    seen = sum(int(index.n[r.visits].sum()) for r in found)
    assert seen < 0.35 * len(x) ** 2
    assert set(_got(index.knn(rows, 5))) == _brute(x, x, 5, 2, False)


def test_large_joins_take_the_index(spark):
    x = _clumps(210, 3, 2)
    rows, again = _points(spark, x), _points(spark, x)
    plain = _got(D.knn_join(rows, again, 3, block_rows=30))
    assert sorted(plain) == sorted(_got(D.knn_join(rows, again, 3, block_rows=30, max_block_pairs=4)))
    assert sorted(plain) == sorted(_got(D.knn_join(rows, rows, 3, block_rows=30, max_block_pairs=4)))
