"""Classifiers.

Forests on tables of bounded size are grown by ``forest``, on larger ones by Spark ML estimators with the
same parameters; logistic and boosted models are fitted by ``logistic`` and ``boosting``; the nearest-neighbour classifier
is built on the exact kNN join. Balanced row weights are used as ``fit_and_score`` states (C9).
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmetric.operators.boosting import LOCAL_BYTES, BoostedModel, bin_edges, binned, fit_boosted, score
from segmetric.operators.distance import knn_join
from segmetric.operators.forest import BINS as FOREST_BINS
from segmetric.operators.forest import Forest, drawn_slots, forest_scores
from segmetric.operators.logistic import LogisticModel, fit_logistic
from segmetric.operators.splits import with_class_weight
from segmetric.sources.tables import spread


# ---------------------------------------------------------------- C2
def knn_scores(train: DataFrame, query: DataFrame, k: int, weights: str = "distance", p: int = 2,
               label: str = "y") -> DataFrame:
    """Positive-class share among the k nearest training rows: (id, score, pred).

    ``distance`` weights are 1/d and exact matches take all the weight; a vote
    tie predicts class 0."""
    nn = knn_join(query.select("id", "vec"), train.select("id", "vec"), k, p=p)
    nn = nn.join(train.select(F.col("id").alias("neighbor_id"), F.col(label).alias("y")), "neighbor_id")
    if weights == "distance":
        has0 = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy("query_id"))
        w = F.when(has0 == 1, (F.col("distance") == 0).cast("double")).otherwise(1.0 / F.col("distance"))
    else:
        w = F.lit(1.0)
    nn = nn.withColumn("w", w)
    agg = nn.groupBy("query_id").agg((F.sum(F.when(F.col("y") == 1, F.col("w")).otherwise(0.0)) / F.sum("w"))
                                     .alias("score"))
    return agg.select(F.col("query_id").alias("id"), "score", (F.col("score") > 0.5).cast("int").alias("pred"))


# ---------------------------------------------------------------- C1, C3-C7
# execution knobs only (no effect on the fitted trees): more nodes per
# aggregation pass, node ids cached between levels, lineage cut periodically
_TREE_SPEED = dict(maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=10)


def _depth(d, default):
    """Depth of a tree: ``default`` for None; Spark's trees end at 30."""
    if d is not None and not 0 <= int(d) <= 30:
        raise ValueError(f"max_depth must lie in 0..30, got {d}")
    return default if d is None else int(d)


def random_forest(n_estimators: int = 400, max_depth=None, min_samples_leaf: int = 1, max_features="sqrt",
                  seed: int = 42, bootstrap: bool = True, no_depth: int = 30):
    """C3 (and C4 with bootstrap=False). ``no_depth`` is the depth that None stands for
    (Spark's limit is 30); unknown settings are refused."""
    fss = {"sqrt": "sqrt", "log2": "log2", None: "all"}.get(max_features, str(max_features))
    return RandomForestClassifier(numTrees=int(n_estimators), maxDepth=_depth(max_depth, no_depth),
                                  minInstancesPerNode=int(min_samples_leaf), featureSubsetStrategy=fss,
                                  bootstrap=bootstrap, seed=seed, featuresCol="features", labelCol="label",
                                  **_TREE_SPEED)


def extra_trees(**kw):
    """C4, re-aimed: no bootstrap, random feature subsets; Spark has no random cut-points."""
    kw["bootstrap"] = False
    return random_forest(**kw)


def boosted_model(kind: str, view: str, *, max_iter: int = 100, learning_rate: float | None = None, max_depth=None,
                  max_leaf_nodes=None, min_samples_leaf=None, min_child_weight=None, l2_regularization=None, subsample=None,
                  colsample=None, gamma=None, seed: int = 42, **more) -> BoostedModel:
    """C5 ``hgb``: leaf-wise, at most 31 leaves of 20 rows, no depth limit and no L2 unless asked.
    C6 ``xgb``: every node down to depth 6, Hessian of 1 a leaf, L2 of 1, least gain ``gamma``,
    columns drawn once a tree. A setting of the other form is refused."""
    own = {"hgb": ("max_leaf_nodes", "min_samples_leaf", "l2_regularization"),
           "xgb": ("l2_regularization", "min_child_weight", "subsample", "colsample", "gamma")}[kind]
    given = {k: v for k, v in dict(max_leaf_nodes=max_leaf_nodes, min_samples_leaf=min_samples_leaf,
                                   min_child_weight=min_child_weight, l2_regularization=l2_regularization,
                                   subsample=subsample, colsample=colsample, gamma=gamma).items() if v is not None}
    if not set(given) <= set(own):
        raise ValueError(f"no settings of {kind}: {sorted(set(given) - set(own))}")
    if kind == "hgb":
        form = dict(rate=learning_rate or 0.1, depth=max_depth, leaves=int(given.get("max_leaf_nodes", 31)),
                    least_rows=int(given.get("min_samples_leaf", 20)), l2=float(given.get("l2_regularization", 0.0)))
    else:
        form = dict(rate=learning_rate or 0.3, depth=6 if max_depth is None else int(max_depth), leaves=None, least_rows=1,
                    least_hessian=float(given.get("min_child_weight", 1.0)), l2=float(given.get("l2_regularization", 1.0)),
                    least_gain=float(given.get("gamma", 0.0)), subsample=float(given.get("subsample", 1.0)),
                    colsample=float(given.get("colsample", 1.0)))
    return BoostedModel(view, rounds=int(max_iter), seed=seed, **form, **more)


def baseline_models(seed: int = 42, model_set: str = "original") -> dict[str, dict]:
    """Unfitted model specs: name -> {'kind', 'params', 'class_weight'}."""
    if model_set == "alt":
        return {
            "hgb": {"kind": "hgb", "params": dict(learning_rate=0.1, max_depth=6, max_iter=300, seed=seed)},
            "et": {"kind": "et", "params": dict(n_estimators=600, seed=seed), "class_weight": "balanced"},
            "rf": {"kind": "rf", "params": dict(n_estimators=400, seed=seed), "class_weight": "balanced"},
            "xgb": {"kind": "xgb", "params": dict(learning_rate=0.3, max_depth=6, max_iter=100, seed=seed)},
        }
    return {
        "logreg": {"kind": "logreg", "params": dict(C=1.0, penalty="l2"), "class_weight": "balanced"},
        "knn": {"kind": "knn", "params": dict(k=15, weights="distance", p=2)},
        "rf": {"kind": "rf", "params": dict(n_estimators=400, seed=seed), "class_weight": "balanced"},
    }


_BUILDERS = {"rf": random_forest, "et": extra_trees}


def positive_score(pred: DataFrame) -> DataFrame:
    """Probability of class 1 from a fitted model's output."""
    return pred.withColumn("score", vector_to_array("probability")[1]).withColumn(
        "pred", F.col("prediction").cast("int"))


def reduction_stage(red: tuple, label: str = "label", out: str = "__z"):
    """Unfitted stage of a reduction, from features to ``out``."""
    from segmetric.operators.reduce import CentredPCA, DiscriminantAxis

    if red[0] == "pca":
        return CentredPCA(inputCol="features", outputCol=out, k=int(red[1]))
    if red[0] == "lda":
        return DiscriminantAxis(inputCol="features", outputCol=out, labelCol=label)
    return DiscriminantAxis(inputCol="features", outputCol=out, labelCol=label, slots=list(red[1]), passthrough=list(red[2]))


def _reduce(spec: dict, train: DataFrame, data: DataFrame, label: str):
    """An optional reduction stage fitted on the training rows only (so it is
    refitted inside every CV fold): ("pca", k), ("lda",) or ("partial_lda", slots, passthrough)."""
    red = spec.get("reduce")
    if not red:
        return train, data
    m = reduction_stage(red, label).fit(train)

    def swap(df):
        return m.transform(df).drop("features").withColumnRenamed("__z", "features")

    return swap(train), swap(data)


def fit_and_score(spec: dict, train: DataFrame, data: DataFrame, label: str = "label", margin: bool = False) -> DataFrame:
    """Fit on ``train`` (weighted when applicable) and score ``data``.

    Inputs carry (row_id, features vector, label); returns (row_id, score, pred).
    Balanced weights are used for class_weight='balanced' and where the spec names
    none; with class_weight=None every row weighs 1.
    ``spec['reduce']`` adds a reduction stage fitted on ``train`` first. With ``margin`` the score of
    a learner that has a decision value (``logreg``, ``hgb``) is that value, its log-odds; others keep
    their probability."""
    train, data = _reduce(spec, train, data, label)
    kind, params = spec["kind"], dict(spec.get("params", {}))
    if kind == "knn":
        tr = train.select(F.col("row_id").alias("id"), vector_to_array("features").alias("vec"),
                          F.col(label).alias("y"))
        q = data.select(F.col("row_id").alias("id"), vector_to_array("features").alias("vec"))
        s = knn_scores(tr, q, params.get("k", 5), params.get("weights", "uniform"), params.get("p", 2))
        return s.withColumnRenamed("id", "row_id")
    train = train.withColumn("label", F.col(label).cast("double"))
    balanced = spec.get("class_weight", "balanced")
    if balanced not in (None, "balanced"):
        raise ValueError(f"unknown class_weight {balanced!r}")
    if kind == "logreg":
        return _fit_logistic(params, bool(balanced), train, data, margin)
    if kind in ("hgb", "xgb"):
        return _fit_boosted(kind, params, bool(balanced), train, data, margin and kind == "hgb")
    local = _fit_local_forest(kind, params, bool(balanced), train, data)
    if local is not None:
        return local
    tw = with_class_weight(train, "label", "weight") if balanced else train.withColumn("weight", F.lit(1.0))
    tw = spread(tw).cache()
    if int(params.get("n_estimators", 400)) > _TREES_PER_JOB:
        return _forest_in_parts(kind, params, tw, data)
    est = _BUILDERS[kind](**params).setWeightCol("weight")
    model = est.fit(tw)
    tw.unpersist()
    out = positive_score(model.transform(data))
    return out.select("row_id", "score", "pred")


def _fit_logistic(params: dict, balanced: bool, train: DataFrame, data: DataFrame, margin: bool = False) -> DataFrame:
    """One model of ``logistic.fit_logistic``, scored as an expression."""
    rows = train.select("label", F.lit(0).alias("fold"), vector_to_array("features").alias("x"))
    rows = spread(rows, rows_per_task=_ROWS_PER_TASK).cache()
    w = fit_logistic(rows, [LogisticModel("x", balanced=balanced, **params)])[0]
    rows.unpersist()
    coefficients = F.array(*[F.lit(float(c)) for c in w[:-1]])
    z = F.aggregate(F.zip_with(vector_to_array("features"), coefficients, lambda a, b: a * b), F.lit(float(w[-1])),
                    lambda a, b: a + b)
    said = F.col("__z") if margin else 1 / (1 + F.exp(-F.col("__z")))
    return data.select("row_id", z.alias("__z")).select("row_id", said.alias("score"), (F.col("__z") > 0).cast("int").alias("pred"))


def _fit_boosted(kind: str, params: dict, balanced: bool, train: DataFrame, data: DataFrame, margin: bool = False) -> DataFrame:
    """One model of ``boosting.fit_boosted``; class 1 where the log-odds are above 0."""
    rows = train.select(F.xxhash64("row_id").alias("key"), "label", F.lit(0).alias("fold"), vector_to_array("features").alias("x"))
    edges = bin_edges(rows, {"x": None})["x"]
    rows = spread(rows.withColumn("x", binned("x", edges)), rows_per_task=_ROWS_PER_TASK).cache()
    fitted = fit_boosted(rows, [boosted_model(kind, "x", balanced=balanced, **params)])[0]
    rows.unpersist()
    out = data.select("row_id", vector_to_array("features").alias("x")).withColumn("x", binned("x", edges))
    return out.select("row_id", score(fitted, margin).alias("score")).withColumn(
        "pred", (F.col("score") > (0.0 if margin else 0.5)).cast("int"))


def _fit_local_forest(kind: str, params: dict, balanced: bool, train: DataFrame, data: DataFrame,
                      local_bytes: int = LOCAL_BYTES) -> DataFrame | None:
    """C3/C4 by ``forest`` where the binned training rows are proven to be at most ``local_bytes``; else None."""
    est = _BUILDERS[kind](**params)  # one reading of the settings for both ways
    rows = train.select(F.xxhash64("row_id").alias("key"), "label", F.lit(0).alias("fold"), vector_to_array("features").alias("x"))
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    head = rows.select(F.size("x").alias("width")).first()
    if head is None or not head["width"] or not set(n) <= {0.0, 1.0} or sum(n.values()) * (head["width"] + 16) > local_bytes:
        return None
    rows = rows.cache()
    edges = bin_edges(rows, {"x": None}, FOREST_BINS)["x"]
    weights = tuple(sum(n.values()) / (len(n) * n[c]) if n.get(c) else 0.0 for c in (0.0, 1.0)) if balanced else (1.0, 1.0)
    model = Forest(est.getNumTrees(), est.getMaxDepth(), est.getMinInstancesPerNode(),
                   drawn_slots(params.get("max_features", "sqrt"), head["width"]), est.getBootstrap(), weights, int(est.getSeed()))
    asked = data.select("row_id", vector_to_array("features").alias("x")).withColumn("x", binned("x", edges))
    out = forest_scores(rows.withColumn("x", binned("x", edges)), sum(n.values()), asked, model)
    rows.unpersist()
    return out.withColumn("pred", (F.col("score") > 0.5).cast("int"))


_TREES_PER_JOB = 100
_ROWS_PER_TASK = 5000


def _forest_in_parts(kind: str, params: dict, tw: DataFrame, data: DataFrame) -> DataFrame:
    """A forest is an average of trees: fit it as several smaller forests
    (distinct seeds) in concurrent jobs and average their class-1
    probabilities weighted by tree count; class 1 wins only on a strict majority."""
    from concurrent.futures import ThreadPoolExecutor

    n = int(params.get("n_estimators", 400))
    parts = -(-n // _TREES_PER_JOB)
    sizes = [n // parts + (1 if i < n % parts else 0) for i in range(parts)]
    seed = int(params.get("seed", 42))
    tw = tw.cache()

    def fit(i):
        p = dict(params, n_estimators=sizes[i], seed=seed + 7919 * i)
        return _BUILDERS[kind](**p).setWeightCol("weight").fit(tw)

    with ThreadPoolExecutor(max_workers=parts) as pool:
        models = list(pool.map(fit, range(parts)))
    tw.unpersist()
    out = data
    for i, m in enumerate(models):
        m = m.copy().setProbabilityCol(f"__p{i}").setRawPredictionCol(f"__r{i}").setPredictionCol(f"__y{i}")
        out = m.transform(out).withColumn(f"__p{i}", vector_to_array(f"__p{i}")[1]).drop(f"__r{i}", f"__y{i}")
    score = sum((F.col(f"__p{i}") * (sizes[i] / n) for i in range(parts)), F.lit(0.0))
    return out.select("row_id", score.alias("score")).withColumn("pred", (F.col("score") > 0.5).cast("int"))
