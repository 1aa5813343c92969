"""End-to-end runs on the smallest tables (small grids), sinks and streaming scoring."""

import json
import os

from pyspark.sql import functions as F

from segmetric.plans import flows
from segmetric.streaming.scoring import read_stream, score_stream, write_stream
from tests.conftest import SF_SMALL


def test_three_runs_write_their_tables(spark, tmp_path):
    prep = str(tmp_path / "prep")
    meta = flows.run_prepare_profile(spark, SF_SMALL, prep)
    assert meta["n_train"] > 0 and meta["n_test"] > 0 and meta["n_features"] == len(meta["feature_names"])
    processed = spark.read.parquet(os.path.join(prep, "processed"))
    assert processed.select("split").distinct().count() == 2
    again = flows.load_preprocessor(os.path.join(prep, "preprocessor"))
    assert len(again.stages) == 5
    for name in ("label_overview", "numeric_summary", "histogram", "box_stats"):
        assert spark.read.parquet(os.path.join(prep, "profile", name)).count() > 0

    seg = str(tmp_path / "seg")
    cfg = flows.SegmentConfig(k_values=(2, 3), n_init=2, min_samples_grid=(3,), eps_quantiles=(0.9, 0.99))
    smeta = flows.run_segmentation(spark, SF_SMALL, prep, seg, cfg)
    assert smeta["chosen_k"] in (2, 3)
    lab = spark.read.parquet(os.path.join(seg, "kmeans", "labels"))
    assert lab.count() == meta["n_train"]
    written = json.loads(open([os.path.join(seg, "meta", f) for f in os.listdir(os.path.join(seg, "meta"))
                               if f.endswith(".json")][0]).readline())
    assert written["chosen_k"] == smeta["chosen_k"]

    sup = str(tmp_path / "sup")
    scfg = flows.SupervisedConfig(n_iter=2, spaces={"logreg": {"C": [0.1, 1.0], "penalty": ["l2"]}},
                                  threshold_models=("logreg",))
    m = flows.run_supervised(spark, prep, sup, scfg).collect()
    variants = {(r.model, r.variant) for r in m}
    assert ("logreg", "threshold_tuned") in variants and ("rf", "baseline") in variants
    assert all(0.0 <= r.f1 <= 1.0 for r in m)


def test_stream_scoring_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 3.0), (3, "a", None)], "row_id long, k string, v double")
    df.write.parquet(str(src))
    from segmetric.operators.prep import build_preprocessor

    model = build_preprocessor(["k"], ["v"]).fit(df)
    q = write_stream(score_stream(read_stream(spark, str(src), df.schema), model),
                     str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("row_id").select("features").collect()
    exp = model.transform(df).orderBy("row_id").select("features").collect()
    assert [r.features.toArray().tolist() for r in got] == [r.features.toArray().tolist() for r in exp]
    assert spark.read.parquet(str(tmp_path / "out")).where(F.col("row_id") == 3).count() == 1
