"""Feature-preparation queries: fitted statistics, encoded matrix, folds, weights."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from segmetric.operators import prep as X
from segmetric.operators import splits as W
from segmetric.plans.catalog import register
from segmetric.plans.common import round_floats
from segmetric.sources.profile import CATEGORICAL, CP_SQL, NUMERIC, customer_profile

# net_price is near-linear in gross_price: skipped by default as a redundant column
REDUNDANT = ("net_price",)
PREP_CAT = list(CATEGORICAL)
PREP_NUM = [c for c in NUMERIC if c not in REDUNDANT]
# the high-cardinality category and the integer-code category (P2 flags)
STATE_PREFIX = "cat__nation_"
AREA_PREFIX = "cat__region_code_"


def fitted_preprocessor(spark, sf_dir, drop_prefixes=(), drop_names=()):
    cp = customer_profile(spark, sf_dir).cache()
    train = cp.where(F.col("split") == "train")
    model = X.build_preprocessor(PREP_CAT, PREP_NUM, drop_prefixes=drop_prefixes,
                                 drop_names=drop_names).fit(train)
    return cp, model


def processed(spark, sf_dir, drop_prefixes=(), drop_names=()):
    """Train and test rows through the train-fitted pipeline: row_id, split, label, features."""
    cp, model = fitted_preprocessor(spark, sf_dir, drop_prefixes, drop_names)
    out = model.transform(cp).select("row_id", "split", F.col("lapsed").alias("label"), "features")
    return out, model


# ------------------------------------------------------------------ SQL pieces
def _mode_sql(c: str) -> str:
    return (f"(SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS fill FROM cp WHERE split = 'train' "
            f"AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)")


def _imputed_sql() -> str:
    """imp: every CP row with train-fitted mode/median fills; st: train mean/std_pop per numeric."""
    modes = ", ".join(
        f"m_{c} AS (SELECT {c} AS v FROM cp WHERE split = 'train' AND {c} IS NOT NULL "
        f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" for c in PREP_CAT)
    meds = ", ".join(f"quantile_cont({c}, 0.5) AS med_{c}" for c in PREP_NUM)
    cols = ", ".join([f"coalesce({c}, (SELECT v FROM m_{c})) AS {c}" for c in PREP_CAT]
                     + [f"coalesce(CAST({c} AS DOUBLE), (SELECT med_{c} FROM med)) AS {c}" for c in PREP_NUM])
    stats = ", ".join(f"avg({c}) AS mean_{c}, CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0 "
                      f"ELSE stddev_pop({c}) END AS std_{c}" for c in PREP_NUM)
    return f"""{modes},
med AS (SELECT {meds} FROM cp WHERE split = 'train'),
imp AS (SELECT row_id, split, lapsed, {cols} FROM cp),
st AS (SELECT {stats} FROM imp WHERE split = 'train')"""


def _vocab_sql(drop_prefixes=()) -> str:
    """names: idx, name, col, sval for the categorical block then the numeric block."""
    cat = " UNION ALL ".join(
        f"SELECT DISTINCT {i} AS blk, '{c}' AS col, CAST({c} AS VARCHAR) AS sval, "
        f"{'CAST(' + c + ' AS DOUBLE)' if c == 'region_code' else 'NULL::DOUBLE'} AS nkey "
        f"FROM imp WHERE split = 'train' AND {c} IS NOT NULL" for i, c in enumerate(PREP_CAT))
    num = " UNION ALL ".join(
        f"SELECT {100 + i} AS blk, '{c}' AS col, NULL AS sval, NULL::DOUBLE AS nkey" for i, c in enumerate(PREP_NUM))
    keep = " AND ".join([f"NOT starts_with(name, '{p}')" for p in drop_prefixes]) or "TRUE"
    return f"""v0 AS ({cat} UNION ALL {num}),
v1 AS (SELECT *, CASE WHEN blk < 100 THEN 'cat__' || col || '_' || sval ELSE 'num__' || col END AS name FROM v0),
names AS (SELECT CAST(row_number() OVER (ORDER BY blk, nkey, sval) - 1 AS INTEGER) AS idx, name, col, sval
          FROM v1 WHERE {keep})"""


def _entries_sql() -> str:
    """ent: row_id, split, name, value of the non-zero matrix entries."""
    cat = " UNION ALL ".join(
        f"SELECT row_id, split, 'cat__{c}_' || CAST({c} AS VARCHAR) AS name, 1.0 AS value FROM imp" for c in PREP_CAT)
    num = " UNION ALL ".join(
        f"SELECT row_id, split, 'num__{c}' AS name, ({c} - mean_{c}) / std_{c} AS value FROM imp, st"
        for c in PREP_NUM)
    return f"ent AS ({cat} UNION ALL {num})"


# ------------------------------------------------------------------ X1
@register("impute_mode", f"""
WITH {CP_SQL}
{" UNION ALL ".join(_mode_sql(c) for c in PREP_CAT)}
""")
def q_impute_mode(spark, sf_dir):
    train = customer_profile(spark, sf_dir).where(F.col("split") == "train")
    m = X.ModeImputer(inputCols=PREP_CAT).fit(train)
    fills = m.getOrDefault(m.fills)
    return spark.createDataFrame(list(zip(PREP_CAT, fills)), "column string, fill string")


# ------------------------------------------------------------------ X2
@register("impute_median", f"""
WITH {CP_SQL}
{" UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(quantile_cont({c}, 0.5), 6) AS fill FROM cp WHERE split = 'train'"
                    for c in PREP_NUM)}
""")
def q_impute_median(spark, sf_dir):
    train = customer_profile(spark, sf_dir).where(F.col("split") == "train")
    m = X.MedianImputer(inputCols=PREP_NUM).fit(train)
    return round_floats(spark.createDataFrame(
        [(c, float(v)) for c, v in zip(PREP_NUM, m.getOrDefault(m.fills))], "column string, fill double"))


# ------------------------------------------------------------------ X4
@register("standardize", f"""
WITH {CP_SQL}, {_imputed_sql()}
{" UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(mean_{c}, 6) AS mean, round(std_{c}, 6) AS std FROM st"
                    for c in PREP_NUM)}
""")
def q_standardize(spark, sf_dir):
    _, model = fitted_preprocessor(spark, sf_dir)
    sc = model.stages[3]
    rows = list(zip(sc.getInputCols(), sc.getOrDefault(sc.means), sc.getOrDefault(sc.stds)))
    return round_floats(spark.createDataFrame(rows, "column string, mean double, std double"))


# ------------------------------------------------------------------ S9
@register("feature_names", f"""
WITH {CP_SQL}, {_imputed_sql()}, {_vocab_sql()}
SELECT idx, name FROM names
""")
def q_feature_names(spark, sf_dir):
    out, _ = processed(spark, sf_dir)
    return X.feature_names_frame(out)


# ------------------------------------------------------------------ P2
@register("feature_filter", f"""
WITH {CP_SQL}, {_imputed_sql()}, {_vocab_sql((STATE_PREFIX, AREA_PREFIX))}
SELECT idx, name FROM names
""")
def q_feature_filter(spark, sf_dir):
    out, _ = processed(spark, sf_dir, drop_prefixes=(STATE_PREFIX, AREA_PREFIX), drop_names=("num__net_price",))
    return X.feature_names_frame(out)


# ------------------------------------------------------------------ X3
@register("one_hot", f"""
WITH {CP_SQL}, {_imputed_sql()}, {_vocab_sql()}, {_entries_sql()}
SELECT ent.row_id, ent.split, ent.name FROM ent JOIN names ON ent.name = names.name
WHERE starts_with(ent.name, 'cat__')
""")
def q_one_hot(spark, sf_dir):
    cp = customer_profile(spark, sf_dir)
    train = cp.where(F.col("split") == "train")
    model = X.Pipeline(stages=[X.ModeImputer(inputCols=PREP_CAT), X.CategoryEncoder(inputCols=PREP_CAT)]).fit(train)
    enc = model.stages[-1]
    names = enc.output_names()
    wide = model.transform(cp)
    long = wide.select("row_id", "split", F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").alias("v")) for n in names])).alias("e"))
    return long.where(F.col("e.v") == 1.0).select("row_id", "split", F.col("e.name").alias("name"))


# ------------------------------------------------------------------ X5
@register("preprocess", f"""
WITH {CP_SQL}, {_imputed_sql()}, {_vocab_sql()}, {_entries_sql()}
SELECT ent.row_id, ent.split, names.idx, round(ent.value, 6) AS value
FROM ent JOIN names ON ent.name = names.name WHERE ent.value <> 0
""")
def q_preprocess(spark, sf_dir):
    out, _ = processed(spark, sf_dir)
    ent = out.select("row_id", "split", F.posexplode(vector_to_array("features")).alias("idx", "value"))
    return round_floats(ent.where(F.col("value") != 0).select("row_id", "split", F.col("idx").cast("int"), "value"))


# ------------------------------------------------------------------ W4 / W5 / A23
@register("stratified_folds", f"""
WITH {CP_SQL}
SELECT row_id, lapsed AS label,
       CAST((row_number() OVER (PARTITION BY lapsed ORDER BY (row_id * 7919 + 42) % 10007, row_id) - 1) % 5
            AS INTEGER) AS fold
FROM cp WHERE split = 'train'
""")
def q_stratified_folds(spark, sf_dir):
    train = customer_profile(spark, sf_dir).where(F.col("split") == "train")
    df = train.select("row_id", F.col("lapsed").alias("label"))
    return W.stratified_folds(df, "label", k=5, seed=42, portable=True).select("row_id", "label", "fold")


@register("stratified_split", f"""
WITH {CP_SQL}, r AS (
  SELECT row_id, lapsed AS label,
         row_number() OVER (PARTITION BY lapsed ORDER BY (row_id * 7919 + 42) % 10007, row_id) - 1 AS rk,
         count(*) OVER (PARTITION BY lapsed) AS n
  FROM cp WHERE split = 'train')
SELECT row_id, label, CASE WHEN rk < round(n * 0.2) THEN 'holdout' ELSE 'fit' END AS part FROM r
""")
def q_stratified_split(spark, sf_dir):
    train = customer_profile(spark, sf_dir).where(F.col("split") == "train")
    df = train.select("row_id", F.col("lapsed").alias("label"))
    return W.stratified_split(df, "label", 0.2, seed=42, portable=True).select("row_id", "label", "part")


@register("class_weights", f"""
WITH {CP_SQL}, c AS (SELECT lapsed AS label, count(*) AS n_c FROM cp WHERE split = 'train' GROUP BY lapsed)
SELECT label, CAST(n_c AS BIGINT) AS n_c, round((SELECT sum(n_c) FROM c) / ((SELECT count(*) FROM c) * n_c), 6) AS weight
FROM c
""")
def q_class_weights(spark, sf_dir):
    train = customer_profile(spark, sf_dir).where(F.col("split") == "train")
    return round_floats(W.class_weights(train.withColumnRenamed("lapsed", "label"), "label"))


# ------------------------------------------------------------------ U1
@register("train_test_union", f"""
WITH {CP_SQL}
SELECT row_id, split, lapsed AS label FROM cp WHERE split = 'train'
UNION ALL SELECT row_id, split, lapsed FROM cp WHERE split = 'test'
""")
def q_train_test_union(spark, sf_dir):
    """The train and test rows of the prepared matrix, each with its split flag."""
    out, _ = processed(spark, sf_dir)
    tagged = [out.where(F.col("split") == s).select("row_id", F.lit(s).alias("split"), "label")
              for s in ("train", "test")]
    return tagged[0].unionByName(tagged[1])


# ------------------------------------------------------------------ P13
@register("feature_partition", f"""
WITH {CP_SQL}, {_imputed_sql()}, {_vocab_sql()}
SELECT CASE WHEN starts_with(name, 'num__') THEN 'projected' ELSE 'passthrough' END AS block, idx, name,
       CAST(count(*) OVER (PARTITION BY starts_with(name, 'num__')) AS BIGINT) AS block_size
FROM names WHERE starts_with(name, 'num__') OR starts_with(name, 'cat__mktsegment_')
""")
def q_feature_partition(spark, sf_dir):
    """Ordered split of the prepared columns into the block projected on the
    discriminant axis (num__*) and the indicator block passed through."""
    out, _ = processed(spark, sf_dir)
    names = X.feature_names(out)
    rows = [("projected" if n.startswith("num__") else "passthrough", i, n) for i, n in enumerate(names)
            if n.startswith("num__") or n.startswith("cat__mktsegment_")]
    sizes = {b: sum(1 for r in rows if r[0] == b) for b in ("projected", "passthrough")}
    return spark.createDataFrame([(b, i, n, sizes[b]) for b, i, n in rows],
                                 "block string, idx int, name string, block_size long")


# ------------------------------------------------------------------ A22
@register("prep_meta", f"""
WITH {CP_SQL}, {_imputed_sql()}, {_vocab_sql()}
SELECT CAST((SELECT count(*) FROM cp WHERE split = 'train') AS BIGINT) AS n_train,
       CAST((SELECT count(*) FROM cp WHERE split = 'test') AS BIGINT) AS n_test,
       CAST((SELECT count(*) FROM names) AS BIGINT) AS n_features
""")
def q_prep_meta(spark, sf_dir):
    """Row counts per split and the number of prepared features (one row)."""
    out, _ = processed(spark, sf_dir)
    n_features = len(X.feature_names(out))
    return out.agg(F.count(F.when(F.col("split") == "train", 1)).alias("n_train"),
                   F.count(F.when(F.col("split") == "test", 1)).alias("n_test")).select(
        "n_train", "n_test", F.lit(n_features).cast("long").alias("n_features"))
