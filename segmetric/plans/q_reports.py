"""Report tables (S11-S13): tidy (section, item, metric, value) rows assembled
with ``unionByName`` from the checked queries. Rendering text from such a
table is a collect of a few dozen rows."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmetric.operators import cluster as K
from segmetric.operators.reduce import CentredPCA
from segmetric.plans import q_assoc, q_cluster, q_eval, q_models, q_profile
from segmetric.plans.catalog import ORACLES, register
from segmetric.plans.common import round_floats

REPORT_COLS = ["section", "item", "metric", "value"]


def tidy(df: DataFrame, section: str, item, metrics: list[str]) -> DataFrame:
    """Wide rows -> (section, item, metric, value double)."""
    item_col = item if not isinstance(item, str) else F.col(item).cast("string")
    base = df.select(item_col.alias("item"), *[F.col(m).cast("double").alias(m) for m in metrics])
    long = base.unpivot("item", metrics, "metric", "value")
    return long.select(F.lit(section).alias("section"), "item", "metric", "value")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _sql_tidy(name: str, section: str, item_sql: str, metrics: list[str]) -> str:
    parts = [f"SELECT '{section}' AS section, CAST({item_sql} AS VARCHAR) AS item, '{m}' AS metric, "
             f"CAST({m} AS DOUBLE) AS value FROM q_{name}" for m in metrics]
    return " UNION ALL ".join(parts)


def _with_sources(names: list[str]) -> str:
    return ", ".join(f"q_{n} AS ({ORACLES[n].strip()})" for n in names)


# ---------------------------------------------------------------- S11
_EDA_PARTS = [
    ("label_overview", "overview", "'train'", ["n", "positive_rate"]),
    ("missing_table", "missing", '"column"', ["missing", "missing_rate"]),
    ("numeric_summary", "numeric", '"column"', ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]),
    ("corr_pairs", "corr_pair", "col_a || ' vs ' || col_b", ["corr"]),
    ("mutual_info", "mutual_info", "feature", ["mi"]),
]


@register("eda_report", f"""
WITH {_with_sources([p[0] for p in _EDA_PARTS])}
SELECT section, item, metric, round(value, 6) AS value FROM (
{" UNION ALL ".join(_sql_tidy(*p) for p in _EDA_PARTS)})
""")
def q_eda_report(spark, sf_dir):
    frames = [
        tidy(q_profile.q_label_overview(spark, sf_dir), "overview", F.lit("train"), ["n", "positive_rate"]),
        tidy(q_profile.q_missing_table(spark, sf_dir), "missing", "column", ["missing", "missing_rate"]),
        tidy(q_profile.q_numeric_summary(spark, sf_dir), "numeric", "column",
             ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]),
        tidy(q_profile.q_corr_pairs(spark, sf_dir), "corr_pair", F.concat_ws(" vs ", "col_a", "col_b"), ["corr"]),
        tidy(q_assoc.q_mutual_info(spark, sf_dir), "mutual_info", "feature", ["mi"]),
    ]
    return round_floats(union_all(frames))


# ---------------------------------------------------------------- S12 (with T6 and J7)
_SUP_ITEM = "model || '|' || variant || '|' || split"


@register("supervised_report", f"""
WITH {_with_sources(["metrics_table", "f1_gap"])},
best AS (SELECT * FROM q_metrics_table WHERE variant = 'threshold_tuned' AND split = 'test'
         ORDER BY f1 DESC, recall DESC, model LIMIT 1)
SELECT section, item, metric, round(value, 6) AS value FROM (
{_sql_tidy("metrics_table", "metrics", _SUP_ITEM, ["accuracy", "precision", "recall", "f1", "roc_auc"])}
UNION ALL SELECT 'best_model', model, 'f1', f1 FROM best
UNION ALL SELECT 'best_model', model, 'recall', recall FROM best
UNION ALL {_sql_tidy("f1_gap", "f1_gap", "model || '|' || variant", ["f1_gap"])})
""")
def q_supervised_report(spark, sf_dir):
    from segmetric.operators.evaluate import best_model

    m = q_eval.q_metrics_table(spark, sf_dir).cache()
    item = F.concat_ws("|", "model", "variant", "split")
    best = best_model(m, variant="threshold_tuned", split="test")
    frames = [
        tidy(m, "metrics", item, ["accuracy", "precision", "recall", "f1", "roc_auc"]),
        tidy(best, "best_model", "model", ["f1", "recall"]),
        tidy(q_eval.q_f1_gap(spark, sf_dir), "f1_gap", F.concat_ws("|", "model", "variant"), ["f1_gap"]),
    ]
    return round_floats(union_all(frames))


# ---------------------------------------------------------------- S13 (rows-only: both searches are seeded or iterative)
REPORT_PCA_DIMS = 10
REPORT_K_VALUES = list(range(2, 11))
REPORT_MIN_SAMPLES = [3, 5, 10]


def segment_sections(train: DataFrame, k_values: list[int], min_samples: list[int], eps_quantiles: list[float],
                     n_init: int = 10, seed: int = 42, pca_dims: int = REPORT_PCA_DIMS) -> DataFrame:
    """Report of both segmentations of ``train`` (features, label): k chosen by silhouette over ``k_values``,
    eps and min_samples by the density search over the first principal components, and for the rows of either choice
    the outcome rate by cluster (noise is cluster -1) and its range. Where every density candidate is degenerate
    nothing is chosen: its settings are null and no clusters are listed."""
    # rows are numbered, as their ids may come twice
    rows = train.select("label", "features").withColumn("id", F.monotonically_increasing_id()).checkpoint(eager=True)
    scores, k, fits = K.kmeans_sweep(rows, k_values, id_col="id", n_init=n_init, seed=seed)
    chosen_k = scores.where(F.col("k") == float(k))
    k_labels = K.canonical_labels(fits[k], rows, "id")
    size = len(rows.select("features").first()["features"])
    pca = CentredPCA(inputCol="features", outputCol="pca", k=min(pca_dims, size)).fit(rows)
    vecs = pca.transform(rows).select("id", vector_to_array("pca").alias("vec")).checkpoint(eager=True)
    _, eps, ms = K.dbscan_search(vecs, min_samples, eps_quantiles, strict=False)
    chosen_eps = train.sparkSession.createDataFrame([(eps, ms)], "eps double, min_samples int")
    frames = [tidy(chosen_k, "kmeans", F.lit("chosen"), ["k", "silhouette", "inertia"]),
              tidy(chosen_eps, "dbscan", F.lit("chosen"), ["eps", "min_samples"])]
    labelled = {"kmeans": k_labels}
    if eps is not None:
        labelled["dbscan"] = K.dbscan(vecs, eps, ms).checkpoint(eager=True)
        frames.append(tidy(K.clustering_quality(vecs, labelled["dbscan"]), "dbscan", F.lit("quality"),
                           ["n_clusters", "noise_ratio", "silhouette"]))
    for section, labels in labelled.items():
        oc = K.outcome_by_cluster(K.attach_labels(rows.select("id", "label"), labels, "id"), "label").cache()
        rng = oc.agg(F.min("outcome_rate").alias("min_rate"), F.max("outcome_rate").alias("max_rate"))
        frames += [tidy(oc, section, "cluster", ["outcome_rate", "count"]),
                   tidy(rng, section, F.lit("range"), ["min_rate", "max_rate"])]
    return union_all(frames)


@register("segment_report")
def q_segment_report(spark, sf_dir):
    train, _, _ = q_models.split_frames(spark, sf_dir)
    return round_floats(segment_sections(train, REPORT_K_VALUES, REPORT_MIN_SAMPLES, q_cluster.EPS_QUANTILES,
                                         seed=q_models.SEED))
