"""End-to-end runs: prepare+profile, segmentation, supervised (the three
command-line entry points of the original project, as functions).

Each run reads the driver tables, keeps everything as DataFrames, and writes
its tables with the Parquet/JSON sinks and its fitted stages with Spark ML
persistence. Nothing is handed over by row position.
"""

from __future__ import annotations

import os
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmetric.operators import classify as C
from segmetric.operators import cluster as K
from segmetric.operators import evaluate as E
from segmetric.operators import prep as X
from segmetric.operators import profiling as P
from segmetric.operators import reduce as R
from segmetric.operators import splits as W
from segmetric.operators import threshold as T
from segmetric.operators import tune as M
from segmetric.operators import validate as V
from segmetric.sources.profile import CATEGORICAL, NUMERIC, customer_profile
from segmetric.sources.tables import load_processed, write_json_record, write_table


@dataclass(frozen=True)
class PrepConfig:
    redundant: tuple[str, ...] = ("net_price",)
    code_like: tuple[str, ...] = ("region_code",)
    high_cardinality: str = "nation"
    top_n: int = 15
    corr_threshold: float = 0.95


def run_prepare_profile(spark: SparkSession, sf_dir: str, out_dir: str, cfg: PrepConfig = PrepConfig()) -> dict:
    """Scan -> label check -> fit the preparation pipeline on train -> transform
    both splits -> persist; then the train-only profile tables."""
    cp = V.load_labelled(customer_profile(spark, sf_dir), "lapsed", true_values=("1",), false_values=("0",))
    train, test = cp.where(F.col("split") == "train"), cp.where(F.col("split") == "test")
    V.require_aligned_columns(train, test)
    cat, num = V.infer_feature_types(train, code_like=cfg.code_like, redundant=cfg.redundant,
                                     exclude=("row_id", "label", "split"))
    model = X.build_preprocessor(cat, num).fit(train)
    out = model.transform(cp).select("row_id", "split", "label", "features")
    write_table(out, os.path.join(out_dir, "processed"), partition_by=["split"])
    model.write().overwrite().save(os.path.join(out_dir, "preprocessor"))
    names = X.feature_names(out)
    counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    meta = {"n_train": counts.get("train", 0), "n_test": counts.get("test", 0), "n_features": len(names),
            "feature_names": names}
    write_json_record(spark, meta, os.path.join(out_dir, "meta"))
    profile = {
        "label_overview": P.label_overview(train, "label"),
        "missing": P.missing_table(train, cat + num),
        "numeric_summary": P.numeric_summary(train, NUMERIC),
        "category_freq": P.category_freq(train, CATEGORICAL, top_n_col=cfg.high_cardinality, top_n=cfg.top_n),
        "outcome_rate_by_category": P.outcome_rate_by_category(train, CATEGORICAL, "label"),
        "corr_pairs": P.corr_pairs(train, NUMERIC, cfg.corr_threshold),
        "histogram": P.histogram(train, NUMERIC),
        "box_stats": P.box_stats(train, NUMERIC, "label"),
    }
    for name, df in profile.items():
        write_table(df, os.path.join(out_dir, "profile", name))
    return meta


@dataclass(frozen=True)
class SegmentConfig:
    k_values: tuple[int, ...] = tuple(range(2, 11))
    drop_state: bool = False
    drop_area_code: bool = False
    pca_dims: int = 10
    min_samples_grid: tuple[int, ...] = (3, 5, 10)
    eps_quantiles: tuple[float, ...] = (0.90, 0.93, 0.95, 0.97, 0.99, 0.995, 0.999)
    n_init: int = 10
    seed: int = 42


def _filter_names(names: list[str], drop_state: bool, drop_area_code: bool) -> list[str]:
    drop = [p for p, on in (("cat__nation_", drop_state), ("cat__region_code_", drop_area_code)) if on]
    return [n for n in names if not any(n.startswith(p) for p in drop)]


def run_segmentation(spark: SparkSession, sf_dir: str, prepared_dir: str, out_dir: str,
                     cfg: SegmentConfig = SegmentConfig()) -> dict:
    """K sweep -> K-Means labels and tables; PCA -> DBSCAN search -> labels and tables."""
    data = load_processed(spark, os.path.join(prepared_dir, "processed"), "train")
    names = X.feature_names(data)
    keep = _filter_names(names, cfg.drop_state, cfg.drop_area_code)
    data = X.slice_features(data, keep, "features", "x").select("row_id", "label", F.col("x").alias("features"))
    data = data.checkpoint(eager=True)
    raw = customer_profile(spark, sf_dir).where(F.col("split") == "train")
    scores, k, fits = K.kmeans_sweep(data, list(cfg.k_values), n_init=cfg.n_init, seed=cfg.seed)
    k_labels = K.canonical_labels(fits[k], data).checkpoint(eager=True)
    pca10 = R.CentredPCA("features", "pca", min(cfg.pca_dims, len(keep))).fit(data)
    vecs = pca10.transform(data).select(F.col("row_id").alias("id"), vector_to_array("pca").alias("vec"))
    search, eps, ms = K.dbscan_search(vecs, list(cfg.min_samples_grid), list(cfg.eps_quantiles))
    d_labels = K.dbscan(vecs, eps, ms).select(F.col("id").alias("row_id"), "cluster").checkpoint(eager=True)
    quality = K.clustering_quality(vecs, d_labels.withColumnRenamed("row_id", "id")).first()
    tables = {"kmeans/k_sweep": scores, "dbscan/param_search": search}
    for tag, lab in (("kmeans", k_labels), ("dbscan", d_labels)):
        joined = K.attach_labels(raw.drop("split"), lab)
        tables[f"{tag}/labels"] = lab
        tables[f"{tag}/cluster_sizes"] = K.cluster_sizes(lab)
        tables[f"{tag}/outcome_by_cluster"] = K.outcome_by_cluster(joined, "lapsed")
        tables[f"{tag}/profile_numeric"] = K.profile_numeric(joined, NUMERIC)
        tables[f"{tag}/profile_categorical"] = K.profile_categorical(joined, ["mktsegment", "nation"])
    for name, df in tables.items():
        write_table(df, os.path.join(out_dir, name))
    sil_k = [r["silhouette"] for r in scores.where(F.col("k") == float(k)).collect()]
    meta = {"chosen_k": k, "silhouette": sil_k[0] if sil_k else None, "eps": eps, "min_samples": ms,
            "n_clusters": int(quality["n_clusters"]), "noise_ratio": float(quality["noise_ratio"]),
            "dbscan_silhouette": quality["silhouette"], "n_features": len(keep)}
    write_json_record(spark, meta, os.path.join(out_dir, "meta"))
    return meta


@dataclass(frozen=True)
class SupervisedConfig:
    model_set: str = "original"
    n_iter: int = 30
    strong_regularization: bool = False
    threshold_models: tuple[str, ...] = ("logreg",)
    threshold_steps: int = 201
    target_recall: float | None = None
    target_precision: float | None = None
    calibration: str | None = None
    calibration_size: float = 0.2
    seed: int = 42
    spaces: dict = field(default_factory=dict)


def run_supervised(spark: SparkSession, prepared_dir: str, out_dir: str,
                   cfg: SupervisedConfig = SupervisedConfig()) -> DataFrame:
    """Baseline fits, tuned fits (fold search), optional threshold choice on
    out-of-fold scores, metrics table (A25) and report rows."""
    V.require_model_set(cfg.model_set, cfg.strong_regularization)
    data = load_processed(spark, os.path.join(prepared_dir, "processed")).checkpoint(eager=True)
    train = data.where(F.col("split") == "train")
    folds = W.stratified_folds(train, "label", 5, cfg.seed).checkpoint(eager=True)
    scored = []
    for name, spec in C.baseline_models(cfg.seed, cfg.model_set).items():
        s = C.fit_and_score(spec, train, data).join(data.select("row_id", "split", "label"), "row_id")
        scored.append(s.withColumn("model", F.lit(name)).withColumn("variant", F.lit("baseline")))
        if name in cfg.spaces:
            kind = spec["kind"]
            summary, params, best = M.search(folds, kind, cfg.spaces[name], n_iter=cfg.n_iter, seed=cfg.seed,
                                             base=spec.get("params"))
            write_table(summary.join(params, "param_id"), os.path.join(out_dir, f"cv_results_{name}"))
            best.pop("class_weight", None)  # rows are balanced either way
            tuned = {"kind": kind, "params": {**spec.get("params", {}), **best}}
            s = C.fit_and_score(tuned, train, data).join(data.select("row_id", "split", "label"), "row_id")
            s = s.withColumn("model", F.lit(name)).withColumn("variant", F.lit("tuned"))
            scored.append(s)
            if name in cfg.threshold_models:
                oof = M.oof_scores(folds, tuned, calibrate=cfg.calibration, calib_size=cfg.calibration_size,
                                   seed=cfg.seed).join(folds.select("row_id", "label"), "row_id")
                sweep = T.threshold_sweep(oof.withColumn("model", F.lit(name)), ["model"],
                                          steps=cfg.threshold_steps)
                write_table(sweep, os.path.join(out_dir, f"threshold_sweep_{name}"))
                chosen = T.choose_threshold(sweep, ["model"], cfg.target_recall, cfg.target_precision)
                t = float(chosen.first()["threshold"])
                if cfg.calibration:  # the threshold was chosen on calibrated scores, so it is applied to such
                    base = M.calibrated_scores(tuned, train, data, cfg.calibration, cfg.calibration_size, cfg.seed).join(
                        data.select("row_id", "split", "label"), "row_id").withColumn("model", F.lit(name))
                    variant = "calibrated_threshold_tuned"
                else:
                    base, variant = s.drop("pred", "variant"), "threshold_tuned"
                s2 = T.apply_threshold(base, t).withColumn("variant", F.lit(variant))
                scored.append(s2.select(*s.columns))
    allscores = scored[0]
    for s in scored[1:]:
        allscores = allscores.unionByName(s)
    allscores = allscores.checkpoint(eager=True)
    metrics = E.binary_metrics(allscores, ["model", "variant", "split"], "label", "pred", "score")
    metrics = metrics.select("model", "variant", "split", *E.METRICS)
    write_table(metrics, os.path.join(out_dir, "metrics"))
    write_table(E.confusion_matrix(allscores, ["model", "variant", "split"]), os.path.join(out_dir, "confusion"))
    write_json_record(spark, {"config": {k: v for k, v in asdict(cfg).items() if k != "spaces"}},
                      os.path.join(out_dir, "run"))
    return metrics


def load_preprocessor(path: str) -> PipelineModel:
    """A persisted preparation pipeline."""
    return PipelineModel.load(path)
