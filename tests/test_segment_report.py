"""The segmentation report chooses its settings and reports both segmentations."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from segmetric.operators import cluster as K
from segmetric.plans.q_reports import segment_sections

QUANTILES = [0.9, 0.99]


def _rows(spark, sizes, seed=1):
    """Blobs far apart; the outcome of blob b is 1 in b of every 4 rows."""
    rnd = np.random.default_rng(seed)
    mids = np.array([[0.0, 0.0, 0.0], [40.0, 0.0, 0.0], [0.0, 40.0, 0.0]])
    rows = [(int(i % 4 < b), [float(v) for v in mids[b] + rnd.normal(size=3)]) for b, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "label int, x array<double>").withColumn("features", array_to_vector("x")).drop("x").repartition(3)


def test_report_chooses_k_and_density_settings(spark):
    rows = _rows(spark, (40, 32, 24)).checkpoint()
    got = {(r.section, r["item"], r.metric): r.value
           for r in segment_sections(rows, [2, 3, 4], [3, 5], QUANTILES, n_init=3).collect()}
    assert got["kmeans", "chosen", "k"] == 3 and got["kmeans", "chosen", "silhouette"] > 0.9
    assert got["kmeans", "chosen", "inertia"] > 0
    rates = sorted((got["kmeans", str(c), "outcome_rate"], got["kmeans", str(c), "count"]) for c in range(3))
    assert rates == [(0.0, 40), (0.25, 32), (0.5, 24)]
    assert (got["kmeans", "range", "min_rate"], got["kmeans", "range", "max_rate"]) == (0.0, 0.5)
    eps, ms = got["dbscan", "chosen", "eps"], got["dbscan", "chosen", "min_samples"]
    assert eps > 0 and ms in (3, 5)
    of = {k[1]: v for k, v in got.items() if k[0] == "dbscan" and k[2] == "count"}
    assert sum(of.values()) == 96 and len(set(of) - {"-1"}) == got["dbscan", "quality", "n_clusters"]
    assert got["dbscan", "quality", "noise_ratio"] == pytest.approx(of.get("-1", 0) / 96)
    told = [got["dbscan", c, "outcome_rate"] for c in of]
    assert (got["dbscan", "range", "min_rate"], got["dbscan", "range", "max_rate"]) == (min(told), max(told))


def test_report_without_a_density_choice(spark, monkeypatch):
    rows = _rows(spark, (12, 8, 0))
    monkeypatch.setattr(K, "dbscan_search", lambda *a, **k: (None, None, None))  # every candidate degenerate
    got = {(r.section, r["item"], r.metric): r.value for r in segment_sections(rows, [2, 3], [3], QUANTILES, n_init=2).collect()}
    assert got["kmeans", "chosen", "k"] == 2
    assert got["dbscan", "chosen", "eps"] is None and got["dbscan", "chosen", "min_samples"] is None
    assert {k[1] for k in got if k[0] == "dbscan"} == {"chosen"}
