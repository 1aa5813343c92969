"""Isotonic pools against the max-min formula, however rows are partitioned."""

import numpy as np
import pytest

from segmetric.operators.isotonic import isotonic_calibrator, isotonic_pools


def _max_min(scores, labels):
    at = sorted(set(scores))
    n = np.array([sum(s == a for s in scores) for a in at])
    y = np.array([sum(v for s, v in zip(scores, labels) if s == a) for a in at])
    cn, cy = np.r_[0, np.cumsum(n)], np.r_[0, np.cumsum(y)]
    return {a: max(min((cy[k + 1] - cy[j]) / (cn[k + 1] - cn[j]) for k in range(i, len(at))) for j in range(i + 1))
            for i, a in enumerate(at)}


def _rows(seed, n=400):
    rng = np.random.default_rng(seed)
    s = np.where(rng.random(n) < 0.33, 0.5, rng.integers(0, 80, n) / 80.0)   # one score holds a third of the rows
    return s.tolist(), (rng.random(n) < 0.2 + 0.6 * s).astype(int).tolist()


@pytest.mark.parametrize("parts,fan_in", [(1, 2), (7, 2), (30, 4)])
def test_pools_are_the_max_min_fit(spark, parts, fan_in):
    s, y = _rows(parts)
    df = spark.createDataFrame(list(zip(s, y)), "score double, label int")
    pools = isotonic_pools(df, fan_in=fan_in, num_partitions=parts).orderBy("lo").collect()
    want = _max_min(s, y)
    assert all(a["value"] < b["value"] and a["hi"] < b["lo"] for a, b in zip(pools, pools[1:]))
    assert sum(r["n"] for r in pools) == len(s) and sum(r["y"] for r in pools) == sum(y)
    for a, v in want.items():
        assert [r["value"] for r in pools if r["lo"] <= a <= r["hi"]] == [pytest.approx(v, abs=1e-12)]


def test_falling_scores_make_one_pool(spark):
    df = spark.createDataFrame([(i / 50, int(i < 20)) for i in range(50)], "score double, label int")
    got = isotonic_pools(df, num_partitions=9, fan_in=2).collect()
    assert [(r["lo"], r["hi"], r["n"], r["y"]) for r in got] == [(0.0, 0.98, 50, 20)]


def test_calibrator_interpolates_and_keeps_nulls(spark):
    fit = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.6, 1), (0.8, 1), (None, 1), (float("nan"), 1), (0.3, None)],
                                "score double, label int")
    cal = isotonic_calibrator(fit)
    asked = spark.createDataFrame([(1, 0.0), (2, 0.2), (3, 0.4), (4, 0.6), (5, 0.9), (6, None)], "row_id long, score double")
    got = {r.row_id: r.score for r in cal(asked).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: pytest.approx(0.5), 4: 1.0, 5: 1.0, 6: None}
    assert isotonic_pools(fit.where("score > 5")).count() == 0
    with pytest.raises(ValueError):
        isotonic_calibrator(fit.where("label IS NULL"))
