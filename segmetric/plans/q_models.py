"""Model, tuning, reduction and calibration queries.

Fitted-model queries are rows-only checks (iterative, seeded fits); the CV
summary has an exact oracle because its candidates are deterministic threshold
rules evaluated through the same fold machinery.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from segmetric.operators import classify as C
from segmetric.operators import cluster as K
from segmetric.operators import reduce as R
from segmetric.operators import splits as W
from segmetric.operators import tune as M
from segmetric.operators.boosting import bin_edges, binned, fit_boosted
from segmetric.operators.evaluate import binary_metrics
from segmetric.plans.catalog import register
from segmetric.plans.common import round_floats
from segmetric.plans.q_eval import doc_scores
from segmetric.plans.q_prep import processed
from segmetric.sources.profile import CP_SQL, customer_profile

CV_THRESHOLDS = [0.3, 0.4, 0.5, 0.6, 0.7]
SEED = 42


def split_frames(spark, sf_dir, **kw):
    out, model = processed(spark, sf_dir, **kw)
    out = out.cache()
    return out.where(F.col("split") == "train"), out.where(F.col("split") == "test"), model


def _scores(spark, sf_dir, spec):
    train, test, _ = split_frames(spark, sf_dir)
    return C.fit_and_score(spec, train, test).select("row_id", "score", "pred")


# ---------------------------------------------------------------- C1, C3-C6 (rows-only)
@register("logreg_scores")
def q_logreg_scores(spark, sf_dir):
    return _scores(spark, sf_dir, {"kind": "logreg", "params": {"C": 1.0, "penalty": "l2"}})


@register("rf_scores")
def q_rf_scores(spark, sf_dir):
    return _scores(spark, sf_dir, C.baseline_models(SEED)["rf"])


@register("et_scores")
def q_et_scores(spark, sf_dir):
    return _scores(spark, sf_dir, C.baseline_models(SEED, "alt")["et"])


@register("gbt_scores")
def q_gbt_scores(spark, sf_dir):
    return _scores(spark, sf_dir, C.baseline_models(SEED, "alt")["hgb"])


@register("xgb_scores")
def q_xgb_scores(spark, sf_dir):
    return _scores(spark, sf_dir, C.baseline_models(SEED, "alt")["xgb"])


STUMP_FEATURES = ["n_orders", "returned_lines", "region_code"]
STUMP_RATE = 0.3


def _stump_sql(no: int, before: str) -> str:
    """CTE r<no>: the best cut of the train rows, given margins in CTE ``before`` (row_id, y, m)."""
    return f"""
gh{no} AS (SELECT row_id, y, m, 1 / (1 + exp(-m)) - y AS g, (1 / (1 + exp(-m))) * (1 - 1 / (1 + exp(-m))) AS h FROM {before}),
v{no} AS (SELECT l.slot, l.x, sum(g) AS g, sum(h) AS h FROM gh{no} JOIN l USING (row_id) GROUP BY l.slot, l.x),
w{no} AS (SELECT slot, x, lead(x) OVER (PARTITION BY slot ORDER BY x) AS nx,
                 sum(g) OVER (PARTITION BY slot ORDER BY x) AS gl, sum(h) OVER (PARTITION BY slot ORDER BY x) AS hl,
                 sum(g) OVER (PARTITION BY slot) AS gt, sum(h) OVER (PARTITION BY slot) AS ht FROM v{no}),
r{no} AS (SELECT slot, (x + nx) / 2 AS cut, -{STUMP_RATE} * gl / (hl + 1) AS lv, -{STUMP_RATE} * (gt - gl) / (ht - hl + 1) AS rv
          FROM w{no} WHERE nx IS NOT NULL AND hl >= 1 AND ht - hl >= 1
          ORDER BY gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) DESC, slot, cut LIMIT 1)"""


def _next_margin_sql(no: int) -> str:
    return f"""
m{no + 1} AS (SELECT gh{no}.row_id, y, m + CASE WHEN l.x <= r.cut THEN r.lv ELSE r.rv END AS m
       FROM gh{no} CROSS JOIN r{no} r JOIN l ON l.row_id = gh{no}.row_id AND l.slot = r.slot)"""


_STUMPS_SQL = f"""
WITH {CP_SQL},
t AS (SELECT * FROM cp WHERE split = 'train'),
l AS ({" UNION ALL ".join(f"SELECT row_id, {i} AS slot, CAST(coalesce({c}, 0) AS DOUBLE) AS x FROM t" for i, c in enumerate(STUMP_FEATURES))}),
m1 AS (SELECT row_id, lapsed AS y, ln(avg(lapsed) OVER () / (1 - avg(lapsed) OVER ())) AS m FROM t),
{_stump_sql(1, "m1")},{_next_margin_sql(1)},
{_stump_sql(2, "m2")},
u AS (SELECT 1 AS tree, * FROM r1 UNION ALL SELECT 2 AS tree, * FROM r2)
SELECT tree, ['{"', '".join(STUMP_FEATURES)}'][slot + 1] AS feature, cut, round(lv, 6) AS left_value, round(rv, 6) AS right_value FROM u
"""


@register("boosted_stumps", _STUMPS_SQL)
def q_boosted_stumps(spark, sf_dir):
    """C6 in closed form: two boosted trees of one cut each on three whole-number columns."""
    train = customer_profile(spark, sf_dir).where(F.col("split") == "train")
    rows = train.select(F.xxhash64("row_id").alias("key"), F.col("lapsed").alias("label"), F.lit(0).alias("fold"),
                        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in STUMP_FEATURES]).alias("x"))
    edges = bin_edges(rows, {"x": None})["x"]
    model = C.boosted_model("xgb", "x", max_iter=2, learning_rate=STUMP_RATE, max_depth=1)
    fitted = fit_boosted(rows.withColumn("x", binned("x", edges)), [model])[0]
    out = [(n, STUMP_FEATURES[t["slot"][0]], float(edges[t["slot"][0]][t["bin"][0]]), float(t["value"][1]), float(t["value"][2]))
           for n, t in enumerate(fitted.trees, 1) if len(t) == 3]
    return round_floats(spark.createDataFrame(out, "tree int, feature string, cut double, left_value double, right_value double"))


@register("gbt_sub_scores")
def q_gbt_sub_scores(spark, sf_dir):
    spec = {"kind": "xgb", "params": dict(learning_rate=0.1, max_depth=3, max_iter=100, subsample=0.8,
                                          colsample=0.8, gamma=0.1, seed=SEED)}
    return _scores(spark, sf_dir, spec)


# ---------------------------------------------------------------- K1, K2, X6, K8 (rows-only)
@register("kmeans_fit")
def q_kmeans_fit(spark, sf_dir):
    train, _, _ = split_frames(spark, sf_dir)
    fit = K.fit_kmeans(train, k=4, n_init=10, seed=SEED)
    return K.canonical_labels(fit, train)


@register("kmeans_sweep")
def q_kmeans_sweep(spark, sf_dir):
    train, _, _ = split_frames(spark, sf_dir)
    scores, chosen, _ = K.kmeans_sweep(train, list(range(2, 11)), n_init=10, seed=SEED)
    return scores.withColumn("chosen", F.col("k") == F.lit(float(chosen)))


@register("pca_2d")
def q_pca_2d(spark, sf_dir):
    train, test, _ = split_frames(spark, sf_dir)
    m = R.CentredPCA(inputCol="features", outputCol="pca", k=2).fit(train)
    a = vector_to_array("pca")
    return m.transform(train.unionByName(test)).select("row_id", "split", a[0].alias("pc1"), a[1].alias("pc2"))


@register("pca_scatter")
def q_pca_scatter(spark, sf_dir):
    train, _, _ = split_frames(spark, sf_dir)
    m = R.CentredPCA(inputCol="features", outputCol="pca", k=2).fit(train)
    fit = K.fit_kmeans(train, k=2, n_init=10, seed=SEED)
    lab = K.canonical_labels(fit, train)
    a = vector_to_array("pca")
    return m.transform(train).join(lab, "row_id").select("row_id", a[0].alias("x"), a[1].alias("y"), "cluster")


# ---------------------------------------------------------------- X7
@register("lda_project")
def q_lda_project(spark, sf_dir):
    train, test, _ = split_frames(spark, sf_dir)
    m = R.DiscriminantAxis(inputCol="features", outputCol="lda", labelCol="label").fit(train)
    return m.transform(train.unionByName(test)).select("row_id", "split", vector_to_array("lda")[0].alias("axis"))


@register("partial_lda")
def q_partial_lda(spark, sf_dir):
    """Axis over the num__ block, market-segment indicators passed through."""
    from segmetric.operators.prep import feature_names

    train, test, _ = split_frames(spark, sf_dir)
    names = feature_names(train)
    num = [i for i, n in enumerate(names) if n.startswith("num__")]
    keep = [i for i, n in enumerate(names) if n.startswith("cat__mktsegment_")]
    m = R.DiscriminantAxis(inputCol="features", outputCol="lda", labelCol="label", slots=num,
                           passthrough=keep).fit(train)
    out = m.transform(train.unionByName(test))
    return out.select("row_id", "split", vector_to_array("lda").alias("projected"))


# ---------------------------------------------------------------- W4 + A21 + W3 with an oracle
def threshold_fold_scores(spark, sf_dir):
    """Fold-score table of threshold rules on the length score, stratified 5-fold
    over the training documents: each row meets every fold as train or test."""
    docs = doc_scores(spark, sf_dir).where((F.col("model") == "length") & (F.col("split") == "train"))
    folds = W.stratified_folds(docs.withColumnRenamed("doc_id", "row_id"), "label", 5, SEED, portable=True)
    cand = F.array(*[F.struct(F.lit(i).alias("param_id"), F.lit(t).alias("t")) for i, t in enumerate(CV_THRESHOLDS)])
    ex = folds.select("label", "score", "fold", F.explode(cand).alias("c"))
    ex = ex.select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"))
    ex = ex.select("label", F.col("c.param_id").alias("param_id"), "k",
                   (F.col("score") >= F.col("c.t")).cast("int").alias("pred"),
                   F.when(F.col("fold") == F.col("k"), "test").otherwise("train").alias("part"))
    m = binary_metrics(ex, ["param_id", "k", "part"], "label", "pred", None)
    wide = m.groupBy("param_id", "k").pivot("part", ["train", "test"]).agg(F.first("f1"))
    return wide.select("param_id", F.col("k").alias("fold"), F.col("train").alias("train_f1"),
                       F.col("test").alias("test_f1"), F.lit(0.0).alias("fit_s"), F.lit(0.0).alias("score_s"))


_CV_SQL = f"""
WITH sc AS (SELECT doc_id AS row_id, CAST(quality AS INTEGER) AS label, n_chars / (n_chars + 2000.0) AS score
            FROM labels JOIN documents USING (doc_id) WHERE doc_id % 5 <> 0),
f AS (SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY (row_id * 7919 + 42) % 10007, row_id) - 1) % 5
                     AS INTEGER) AS fold FROM sc),
c AS (SELECT * FROM (VALUES {", ".join(f"({i}, {t})" for i, t in enumerate(CV_THRESHOLDS))}) t(param_id, t)),
ex AS (SELECT param_id, k, label, CASE WHEN score >= t THEN 1 ELSE 0 END AS pr,
              CASE WHEN fold = k THEN 'test' ELSE 'train' END AS part FROM f, c, range(0, 5) r(k)),
cnt AS (SELECT param_id, k, part, count(CASE WHEN label = 1 AND pr = 1 THEN 1 END) AS tp,
               count(CASE WHEN label = 0 AND pr = 1 THEN 1 END) AS fp,
               count(CASE WHEN label = 1 AND pr = 0 THEN 1 END) AS fn FROM ex GROUP BY param_id, k, part),
fs AS (SELECT param_id, k AS fold, part, coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1
       FROM cnt),
s AS (SELECT param_id,
             {", ".join(f"max(CASE WHEN part = 'test' AND fold = {i} THEN f1 END) AS split{i}_test_score" for i in range(5))},
             avg(CASE WHEN part = 'test' THEN f1 END) AS mean_test_score,
             stddev_pop(CASE WHEN part = 'test' THEN f1 END) AS std_test_score,
             avg(CASE WHEN part = 'train' THEN f1 END) AS mean_train_score,
             stddev_pop(CASE WHEN part = 'train' THEN f1 END) AS std_train_score
      FROM fs GROUP BY param_id)
SELECT param_id, {", ".join(f"round(split{i}_test_score, 6) AS split{i}_test_score" for i in range(5))},
       round(mean_test_score, 6) AS mean_test_score, round(std_test_score, 6) AS std_test_score,
       CAST(rank() OVER (ORDER BY mean_test_score DESC) AS INTEGER) AS rank_test_score,
       round(mean_train_score, 6) AS mean_train_score, round(std_train_score, 6) AS std_train_score
FROM s
"""


@register("cv_summary", _CV_SQL)
def q_cv_summary(spark, sf_dir):
    s = M.cv_summary(threshold_fold_scores(spark, sf_dir))
    cols = ["param_id", *[f"split{i}_test_score" for i in range(5)], "mean_test_score", "std_test_score",
            "rank_test_score", "mean_train_score", "std_train_score"]
    return round_floats(s.select(*cols).withColumn("rank_test_score", F.col("rank_test_score").cast("int")))


# ---------------------------------------------------------------- M1-M3, M7 (rows-only)
# fixed values: the search grids that the results must cover
LOGREG_SPACE = {"C": [0.001, 0.005, 0.01, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0],
                "penalty": ["l1", "l2"], "class_weight": [None, "balanced"]}
REDUCED_LOGREG_GRID = {"C": [0.01, 0.1, 1.0, 10.0, 100.0], "penalty": ["l1", "l2"],
                       "class_weight": [None, "balanced"]}


def _fold_frame(spark, sf_dir):
    train, _, _ = split_frames(spark, sf_dir)
    return W.stratified_folds(train, "label", 5, SEED).cache()


@register("random_search")
def q_random_search(spark, sf_dir):
    data = _fold_frame(spark, sf_dir)
    summary, params, _ = M.search(data, "logreg", LOGREG_SPACE, n_iter=30, seed=SEED)
    return summary.join(params, "param_id")


@register("grid_search")
def q_grid_search(spark, sf_dir):
    """The numeric block reduced to its discriminant axis inside every fold, all indicators
    passed through; full grid, row weights only where the candidate asks for them."""
    from segmetric.operators.prep import feature_names

    data = _fold_frame(spark, sf_dir)
    names = feature_names(data)
    num = [i for i, n in enumerate(names) if n.startswith("num__")]
    rest = [i for i, n in enumerate(names) if not n.startswith("num__")]
    summary, params, _ = M.search(data, "logreg", REDUCED_LOGREG_GRID, n_iter=None,
                                  base={"reduce": ("partial_lda", tuple(num), tuple(rest))}, balance_rows=False)
    return summary.join(params, "param_id")


@register("oof_scores")
def q_oof_scores(spark, sf_dir):
    return M.oof_scores(_fold_frame(spark, sf_dir), {"kind": "logreg", "params": {"C": 1.0}})


@register("platt")
def q_platt(spark, sf_dir):
    data = _fold_frame(spark, sf_dir)
    return M.oof_scores(data, {"kind": "logreg", "params": {"C": 1.0}}, calibrate="sigmoid", seed=SEED)


@register("isotonic")
def q_isotonic(spark, sf_dir):
    data = _fold_frame(spark, sf_dir)
    return M.oof_scores(data, {"kind": "logreg", "params": {"C": 1.0}}, calibrate="isotonic", seed=SEED)


# fixed values: the grids over principal components that the results must cover
PCA_COMPONENTS = [("pca", n) for n in (2, 3, 4, 5, 6, 8, 10, 12, 15)]
PCA_BOOSTED = [("pca", n) for n in (5, 10, 15)]
PCA_GRIDS = {
    "logreg": ("logreg", {"reduce": PCA_COMPONENTS, **REDUCED_LOGREG_GRID}),
    "knn": ("knn", {"reduce": PCA_COMPONENTS, "k": [3, 5, 7, 9, 11, 15, 21], "weights": ["uniform", "distance"],
                    "p": [1, 2]}),
    "hgb": ("hgb", {"reduce": PCA_BOOSTED, "max_iter": [100, 200, 300], "learning_rate": [0.05, 0.1, 0.2],
                    "max_depth": [3, 5, None]}),
    "xgb": ("xgb", {"reduce": PCA_BOOSTED, "max_iter": [100, 200], "max_depth": [3, 6], "learning_rate": [0.1, 0.2]}),
}


def _pca_search(spark, sf_dir, name):
    """PCA refitted inside every fold, full grid; row weights only where the candidate asks for them."""
    kind, space = PCA_GRIDS[name]
    base = {"seed": SEED} if kind in ("hgb", "xgb") else None
    summary, params, _ = M.search(_fold_frame(spark, sf_dir), kind, space, n_iter=None, base=base, balance_rows=False)
    return summary.join(params, "param_id")


@register("pca_grid_search")
def q_pca_grid_search(spark, sf_dir):
    return _pca_search(spark, sf_dir, "logreg")


@register("pca_knn_search")
def q_pca_knn_search(spark, sf_dir):
    return _pca_search(spark, sf_dir, "knn")


@register("pca_hgb_search")
def q_pca_hgb_search(spark, sf_dir):
    return _pca_search(spark, sf_dir, "hgb")


@register("pca_xgb_search")
def q_pca_xgb_search(spark, sf_dir):
    return _pca_search(spark, sf_dir, "xgb")
