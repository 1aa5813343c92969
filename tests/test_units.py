"""Hand-written rows for the traps listed in the survey (labels, quantiles, ranks, metrics)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmetric.operators import evaluate as E
from segmetric.operators import ordered as O
from segmetric.operators import prep as X
from segmetric.operators import quantiles as Q
from segmetric.operators import splits as S
from segmetric.operators import threshold as T
from segmetric.operators import validate as V


def test_label_encoding_strict(spark):
    df = spark.createDataFrame([(1, " true "), (2, "False"), (3, "TRUE")], "row_id long, Churn string")
    out = V.load_labelled(df, "Churn")
    assert sorted(r.label for r in out.collect()) == [0, 1, 1]
    bad = spark.createDataFrame([(1, "yes"), (2, None), (3, "true")], "row_id long, Churn string")
    with pytest.raises(ValueError, match="YES"):
        V.load_labelled(bad, "Churn")
    with pytest.raises(ValueError, match="no column"):
        V.load_labelled(df, "label")


def test_schema_check(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(1, 2)], "b int, c int")
    with pytest.raises(ValueError, match="0: a / b; 1: b / c"):
        V.require_aligned_columns(a, b)
    V.require_aligned_columns(a, a.where("a > 1"))


def test_infer_types(spark):
    df = spark.createDataFrame([("x", 408, 1.0, 2.0)], "State string, `Area code` int, m double, c double")
    cat, num = V.infer_feature_types(df, code_like=("Area code",), redundant=("c",))
    assert cat == ["State", "Area code"] and num == ["m"]


@pytest.mark.parametrize("final_rows", [1_000_000, 7])
def test_exact_quantiles_match_numpy(spark, final_rows, monkeypatch):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=300), np.repeat(2.5, 40), rng.integers(0, 5, 60).astype(float)])
    groups = rng.integers(0, 3, len(vals))
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(groups, vals)], "g int, x double")
    monkeypatch.setattr(Q, "_FINAL_ROWS", final_rows)
    monkeypatch.setattr(Q, "_BUCKETS", 4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.g, r.prob): r.value for r in
           Q.quantiles_long(Q.to_long(df, ["x"], ["g"]), ["g", "column"], probs).collect()}
    for g in range(3):
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.quantile(vals[groups == g], p)), rel=1e-12, abs=1e-12)


def test_refinement_rounds_are_exact(spark):
    rng = np.random.default_rng(5)
    vals = rng.exponential(size=500)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    long = Q.to_long(df, ["x"])
    stats = long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("vmin"),
                                       F.max("x").alias("vmax"))
    ranks = stats.select("column", F.lit(123).cast("long").alias("rank"), F.col("vmin").alias("lo"),
                         F.col("vmax").alias("hi"), F.lit(0).cast("long").alias("below"), F.col("n").alias("cnt"))
    out = Q.order_statistics(long, ["column"], ranks, buckets=4, final_rows=3).collect()
    assert out[0].value == np.sort(vals)[123]


def test_group_rank_dense_and_balanced(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("row_id"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    r = O.group_rank(df, ["label"], [S.shuffle_key("row_id", 1), "row_id"], num_partitions=5).collect()
    for lab in (0, 1):
        ranks = sorted(x.grp_rank for x in r if x.label == lab)
        assert ranks == list(range(len(ranks)))
    folds = S.stratified_folds(df, "label", k=5).groupBy("label", "fold").count().collect()
    for lab in (0, 1):
        sizes = [x["count"] for x in folds if x.label == lab]
        assert max(sizes) - min(sizes) <= 1


def test_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    m = X.ModeImputer(inputCols=["c"]).fit(df)
    assert m.getOrDefault(m.fills) == ["a"]
    assert [r.c for r in m.transform(df).collect()].count("a") == 3


def test_one_hot_unknown_is_all_zero_and_scaler_uses_population_std(spark):
    train = spark.createDataFrame([("x", 1.0), ("y", 3.0), ("y", 5.0)], "k string, v double")
    test = spark.createDataFrame([("z", 3.0)], "k string, v double")
    model = X.build_preprocessor(["k"], ["v"]).fit(train)
    names = X.feature_names(model.transform(train))
    assert names == ["cat__k_x", "cat__k_y", "num__v"]
    row = model.transform(test).first().features.toArray()
    assert list(row[:2]) == [0.0, 0.0] and row[2] == pytest.approx(0.0)
    v = model.transform(train).orderBy("v").collect()[0].features.toArray()[2]
    assert v == pytest.approx((1.0 - 3.0) / np.std([1.0, 3.0, 5.0]))


def test_pipeline_save_load(spark, tmp_path):
    train = spark.createDataFrame([("x", 1.0), ("y", None), ("y", 5.0)], "k string, v double")
    model = X.build_preprocessor(["k"], ["v"]).fit(train)
    path = str(tmp_path / "prep")
    model.write().overwrite().save(path)
    from pyspark.ml import PipelineModel
    again = PipelineModel.load(path)
    a = [r.features.toArray().tolist() for r in model.transform(train).orderBy("k", "v").collect()]
    b = [r.features.toArray().tolist() for r in again.transform(train).orderBy("k", "v").collect()]
    assert a == b


def test_golden_confusion_metrics(spark):
    rows = [(0, 0)] * 562 + [(0, 1)] * 10 + [(1, 0)] * 18 + [(1, 1)] * 77
    df = spark.createDataFrame(rows, "label int, pred int")
    m = E.binary_metrics(df, [], score=None).first()
    assert m.accuracy == pytest.approx(0.9580209895)
    assert m.precision == pytest.approx(0.8850574713)
    assert m.recall == pytest.approx(0.8105263158)
    assert m.f1 == pytest.approx(0.8461538462)


def test_auc_with_ties_matches_pairwise(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 200)
    s = np.round(rng.random(200), 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = E.roc_auc(df.withColumn("g", F.lit(1)), ["g"]).first().roc_auc
    pos, neg = s[y == 1], s[y == 0]
    exp = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert got == pytest.approx(exp)


def test_threshold_sweep_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 300)
    s = np.concatenate([rng.random(297), [0.7, 0.005, 1.0]])
    df = spark.createDataFrame([(int(a), float(b), "m") for a, b in zip(y, s)], "label int, score double, model string")
    sweep = {round(r.threshold, 9): r for r in T.threshold_sweep(df, ["model"], steps=201).collect()}
    for i in range(201):
        t = i / 200
        p = s >= t
        tp = int((p & (y == 1)).sum())
        prec = tp / p.sum() if p.sum() else 0.0
        rec = tp / (y == 1).sum()
        r = sweep[round(t, 9)]
        assert r.precision == pytest.approx(prec) and r.recall == pytest.approx(rec)
    best = T.choose_threshold(T.threshold_sweep(df, ["model"]), ["model"]).first()
    assert best.f1 == pytest.approx(max(x.f1 for x in sweep.values()))
