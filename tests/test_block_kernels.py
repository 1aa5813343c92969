"""Block kernels against brute force by direct differences: ties, copies, rows far from the origin, rows without
finite numbers; block sizes; DBSCAN without a table of pairs."""

import numpy as np
import pytest

from segmetric.operators import cluster as K
from segmetric.operators import distance as D
from tests.test_distance_cluster import _fixture, _points, _sk_dbscan


def _blocks(shift=0.0):
    rng = np.random.default_rng(5)
    y = np.round(rng.normal(size=(400, 6)), 1) + shift  # a coarse grid: many equal distances
    y[50:80] = y[20]  # copies
    return np.vstack([y[:90], rng.normal(size=(60, 6)) + shift]), y


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("shift", [0.0, 1e6])
@pytest.mark.parametrize("own", [False, True])
def test_nearest_in_block(p, shift, own):
    x, y = _blocks(shift)
    qid, rid = np.arange(len(x)), np.random.default_rng(1).permutation(len(y))
    d = D.pair_distances(x, y, p)
    if own:
        d[qid[:, None] == rid] = np.inf
    order = np.lexsort((np.broadcast_to(rid, d.shape), d), axis=-1)[:, :7]
    of, to, far = D.nearest_in_block(qid, x, rid, y, 7, p, own)
    assert (of == np.repeat(np.arange(len(x)), 7)).all() and (to == rid[order].ravel()).all()
    assert (far == np.take_along_axis(d, order, 1).ravel()).all()


@pytest.mark.parametrize("p", [1, 2])
def test_within_in_block_is_exact_on_the_border(p):
    x, y = _blocks(1e5)
    d = D.pair_distances(x, y, p)
    eps = float(np.sort(d.ravel())[3000])  # some pairs lie at eps exactly
    i, j, far = (np.concatenate(c) for c in zip(*D.within_in_block(x, y, eps, p)))
    assert {*zip(i, j)} == {*zip(*np.nonzero(d <= eps))} and (far == d[i, j]).all()


def test_blocks_without_finite_numbers():
    x, y = _blocks()
    x, y = x.copy(), y.copy()
    y[3], x[5], y[7] = np.nan, np.inf, 1e200
    with np.errstate(all="ignore"):
        of, to, far = D.nearest_in_block(np.arange(len(x)), x, np.arange(len(y)), y, 3)
    assert 3 not in to and 5 not in of and np.isfinite(far).all()
    d = D.pair_distances(x[:1], y)[0]
    assert list(to[:3]) == list(np.lexsort((np.arange(len(y)), d))[:3])


def test_distances_of_close_pairs():
    x, y = _blocks(1e6)
    got = np.vstack([d for _, d in D.distances_in_block(x, y)])
    assert np.abs(got - D.pair_distances(x, y)).max() < 1e-9 and (got[20, 50:80] == 0).all()


def test_block_size_grows_with_the_table():
    assert D.block_size(2_000, 512) == 512 and D.block_size(120_000, 512) == 5_000 and D.block_size(10 ** 7, 512) == 16_384


def test_local_roots():
    a, b = np.array([5, 3, 9, 4]), np.array([3, 8, 7, 9])
    assert list(D._local_roots(10, [(a[:2], b[:2]), (a[2:], b[2:])])) == [0, 1, 2, 3, 4, 3, 6, 4, 3, 4]


@pytest.mark.parametrize("copies", [False, True])
def test_dbscan_makes_no_table_of_pairs(spark, monkeypatch, copies):
    def refuse(*a, **k):
        raise AssertionError("pairs were listed")

    monkeypatch.setattr(D, "radius_join", refuse)
    monkeypatch.setattr(K, "dbscan_from_pairs", refuse)
    x = _fixture(150, seed=2)
    if copies:
        x[60:100] = x[10]
    got = dict(K.dbscan(_points(spark, x), 0.25, 4, block_rows=16).select("id", "cluster").collect())
    assert [got[i] for i in range(len(x))] == list(_sk_dbscan(x, 0.25, 4))


@pytest.mark.parametrize("shift", [0.0, 1e4])
def test_single_precision_products_decide_nothing_that_their_digits_cannot(shift):
    rnd = np.random.default_rng(11)
    y = np.repeat(rnd.normal(size=(150, 5)), 9, axis=0) + shift
    x = np.concatenate([y[::7], rnd.normal(size=(60, 5)) + shift, y[:40] + 1e-9])
    qid, rid = np.arange(len(x)), np.arange(len(y)) % 700
    near = D.Near(x, y, single=True)
    assert near.left.dtype == np.float32
    for exclude in (False, True):
        want = []
        d = D.pair_distances(x, y)
        d[(qid[:, None] == rid) & exclude] = np.inf
        for i in range(len(x)):
            best = np.lexsort((rid, d[i]))[:6]
            want += [(i, rid[j], d[i, j]) for j in best]
        got = list(zip(*D.nearest_in_block(qid, x, rid, y, 6, exclude_self=exclude)))
        assert got == want
    eps = float(np.quantile(D.pair_distances(x, y), 0.01))
    got = sorted(zip(*(np.concatenate(c) for c in zip(*D.within_in_block(x, y, eps)))))
    d = D.pair_distances(x, y)
    assert got == [(i, j, d[i, j]) for i, j in zip(*np.nonzero(d <= eps))]
