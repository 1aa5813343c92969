"""Decision values and what the calibrators make of them."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from segmetric.operators import tune as M
from segmetric.operators.classify import fit_and_score


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(240, 2))
    y = (rng.random(240) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    return spark.createDataFrame([(i, Vectors.dense(v), int(t)) for i, (v, t) in enumerate(zip(x.tolist(), y))],
                                 ["row_id", "features", "label"]).cache()


@pytest.mark.parametrize("spec", [{"kind": "logreg", "params": {"C": 1.0}}, {"kind": "hgb", "params": {"max_iter": 5}}])
def test_margin_is_the_log_odds_of_the_score(spark, rows, spec):
    p = {r.row_id: (r.score, r.pred) for r in fit_and_score(spec, rows, rows).collect()}
    z = {r.row_id: (r.score, r.pred) for r in fit_and_score(spec, rows, rows, margin=True).collect()}
    assert len(p) == len(z) == 240
    for i, (v, pred) in p.items():
        assert z[i] == (pytest.approx(np.log(v / (1 - v)), abs=1e-6), pred)


def test_learners_without_a_decision_value_keep_their_probability(spark, rows):
    spec = {"kind": "xgb", "params": {"max_iter": 3}}
    plain = {r.row_id: r.score for r in fit_and_score(spec, rows, rows).collect()}
    assert {r.row_id: r.score for r in fit_and_score(spec, rows, rows, margin=True).collect()} == pytest.approx(plain)


def test_sigmoid_is_the_best_fit_to_smoothed_targets(spark, rows):
    """At the minimum the weighted residuals sum to 0, and so do their products with the margin."""
    scored = fit_and_score({"kind": "logreg", "params": {"C": 1.0}}, rows, rows, margin=True).join(rows.select("row_id", "label"), "row_id")
    cal = {r.row_id: r.score for r in M.platt_calibrator(scored)(scored).collect()}
    data = scored.collect()
    pos = sum(r.label for r in data)
    hi, lo = (pos + 1) / (pos + 2), 1 / (len(data) - pos + 2)
    res = np.array([(hi if r.label else lo) - cal[r.row_id] for r in data])
    assert abs(res.mean()) < 1e-4 and abs((res * np.array([r.score for r in data])).mean()) < 1e-4


@pytest.mark.parametrize("how", ["sigmoid", "isotonic"])
def test_calibrated_scores_rise_with_the_margin(spark, rows, how):
    spec = {"kind": "logreg", "params": {"C": 1.0}}
    got = M.calibrated_scores(spec, rows, rows, how)
    flat = {r.row_id: r.score for r in got.collect()}
    assert len(flat) == 240 and all(0 <= v <= 1 for v in flat.values())
    fit_part = M.stratified_split(rows, "label", 0.2, 42).where("part = 'fit'").drop("part")
    z = {r.row_id: r.score for r in fit_and_score(spec, fit_part, rows, margin=True).collect()}
    order = sorted(flat, key=z.get)
    assert all(flat[a] <= flat[b] + 1e-12 for a, b in zip(order, order[1:]))
