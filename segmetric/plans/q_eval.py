"""Evaluation queries on score/label pairs from ``labels`` joined to ``documents``.

Two deterministic scorers of document length stand in for fitted models, so
every metric, sweep and choice has an exact SQL oracle. The documents scan
reads only (doc_id, n_chars); the text column is pruned away.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from segmetric.operators import evaluate as E
from segmetric.operators import threshold as T
from segmetric.operators.isotonic import isotonic_pools
from segmetric.plans.catalog import register
from segmetric.plans.common import round_floats
from segmetric.sources.tables import read_table

STEPS = 201
TARGET_RECALL = 0.5


def doc_scores(spark, sf_dir):
    """model, doc_id, split, label, score."""
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "n_chars"])
    j = lab.join(docs, "doc_id")
    s = F.col("n_chars") / (F.col("n_chars") + 2000.0)
    b = 2000.0 / (F.col("n_chars") + 2000.0)
    return j.select(
        "doc_id", F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train").alias("split"),
        F.col("quality").cast("int").alias("label"),
        F.explode(F.array(F.struct(F.lit("length").alias("model"), s.alias("score")),
                          F.struct(F.lit("brevity").alias("model"), b.alias("score")))).alias("m"),
    ).select("m.model", "doc_id", "split", "label", "m.score")


SCORES_SQL = """
sc AS (SELECT m.model, doc_id, CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
              CAST(quality AS INTEGER) AS label,
              CASE WHEN m.model = 'length' THEN n_chars / (n_chars + 2000.0) ELSE 2000.0 / (n_chars + 2000.0) END
              AS score
       FROM labels JOIN documents USING (doc_id), (VALUES ('length'), ('brevity')) m(model))"""

COUNTS_SQL = """
cnt AS (SELECT model, split, count(CASE WHEN label = 0 AND pr = 0 THEN 1 END) AS tn,
               count(CASE WHEN label = 0 AND pr = 1 THEN 1 END) AS fp,
               count(CASE WHEN label = 1 AND pr = 0 THEN 1 END) AS fn,
               count(CASE WHEN label = 1 AND pr = 1 THEN 1 END) AS tp
        FROM pred GROUP BY model, split),
met AS (SELECT model, split,
               coalesce((tp + tn) / nullif(CAST(tp + tn + fp + fn AS DOUBLE), 0), 0.0) AS accuracy,
               coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
               coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall,
               coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1
        FROM cnt),
d AS (SELECT model, split, score, count(CASE WHEN label = 1 THEN 1 END) AS pos,
             count(CASE WHEN label = 0 THEN 1 END) AS neg FROM sc GROUP BY model, split, score),
r AS (SELECT *, sum(neg) OVER (PARTITION BY model, split ORDER BY score
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum FROM d),
auc AS (SELECT model, split, sum(pos * (neg_cum - neg) + 0.5 * pos * neg) / nullif(sum(pos) * sum(neg), 0)
               AS roc_auc FROM r GROUP BY model, split)"""

SWEEP_SQL = f"""
gi AS (SELECT model, label, CASE WHEN score < 0 THEN -1 WHEN score >= 1 THEN {STEPS - 1}
              WHEN score >= (floor(score * {STEPS - 1}.0) + 1) / {STEPS - 1}.0 THEN floor(score * {STEPS - 1}.0) + 1
              WHEN score < floor(score * {STEPS - 1}.0) / {STEPS - 1}.0 THEN floor(score * {STEPS - 1}.0) - 1
              ELSE floor(score * {STEPS - 1}.0) END AS i
       FROM sc WHERE split = 'train'),
gc AS (SELECT model, CAST(i AS BIGINT) AS i, count(CASE WHEN label = 1 THEN 1 END) AS pos,
              count(CASE WHEN label = 0 THEN 1 END) AS neg FROM gi GROUP BY model, i),
tot AS (SELECT model, sum(pos) AS P FROM gc GROUP BY model),
grid AS (SELECT model, P, i FROM tot, range(0, {STEPS}) t(i)),
g AS (SELECT grid.model, grid.i, P, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg
      FROM grid LEFT JOIN gc ON grid.model = gc.model AND grid.i = gc.i),
cum AS (SELECT model, i, P,
               sum(pos) OVER (PARTITION BY model ORDER BY i DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(neg) OVER (PARTITION BY model ORDER BY i DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
        FROM g),
sweep AS (SELECT model, i / {STEPS - 1}.0 AS threshold,
                 coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
                 coalesce(tp / nullif(CAST(P AS DOUBLE), 0), 0.0) AS recall,
                 coalesce(2 * tp / nullif(CAST(tp + fp + P AS DOUBLE), 0), 0.0) AS f1 FROM cum)"""


def _choose_sql(target_recall) -> str:
    ok = f"CASE WHEN recall >= {target_recall} THEN 1 ELSE 0 END" if target_recall is not None else "1"
    return f"""chosen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY {ok} DESC, f1 DESC,
                                 threshold) AS rn FROM sweep) WHERE rn = 1)"""


def _baseline(spark, sf_dir):
    return T.apply_threshold(doc_scores(spark, sf_dir), 0.5)


# ------------------------------------------------------------------ A12
@register("confusion_matrix", f"""
WITH {SCORES_SQL},
pred AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pr FROM sc), {COUNTS_SQL}
SELECT model, split, t AS true, p AS pred,
       CAST(CASE WHEN t = 0 AND p = 0 THEN tn WHEN t = 0 THEN fp WHEN p = 0 THEN fn ELSE tp END AS BIGINT) AS count
FROM cnt, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) c(t, p)
""")
def q_confusion_matrix(spark, sf_dir):
    return E.confusion_matrix(_baseline(spark, sf_dir), ["model", "split"])


# ------------------------------------------------------------------ A13
@register("binary_metrics", f"""
WITH {SCORES_SQL},
pred AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pr FROM sc), {COUNTS_SQL}
SELECT met.model, met.split, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1, round(roc_auc, 6) AS roc_auc
FROM met JOIN auc ON met.model = auc.model AND met.split = auc.split
""")
def q_binary_metrics(spark, sf_dir):
    m = E.binary_metrics(_baseline(spark, sf_dir), ["model", "split"])
    return round_floats(m.select("model", "split", "accuracy", "precision", "recall", "f1", "roc_auc"))


# ------------------------------------------------------------------ A14
@register("roc_auc", f"""
WITH {SCORES_SQL},
pred AS (SELECT *, 0 AS pr FROM sc), {COUNTS_SQL}
SELECT model, split, round(roc_auc, 6) AS roc_auc FROM auc
""")
def q_roc_auc(spark, sf_dir):
    return round_floats(E.roc_auc(doc_scores(spark, sf_dir), ["model", "split"]))


# ------------------------------------------------------------------ M7
@register("isotonic_pools", f"""
WITH {SCORES_SQL},
g AS (SELECT model, score, count(*) AS n, sum(label) AS y FROM sc WHERE split = 'train' GROUP BY model, score),
c AS (SELECT *, sum(n) OVER w AS cn, sum(y) OVER w AS cy FROM g WINDOW w AS (PARTITION BY model ORDER BY score)),
m AS (SELECT a.model, b.score, min((b.cy - a.cy + a.y) / CAST(b.cn - a.cn + a.n AS DOUBLE))
             OVER (PARTITION BY a.model, a.score ORDER BY b.score DESC) AS least
      FROM c a JOIN c b ON a.model = b.model AND a.score <= b.score),
f AS (SELECT model, score, max(least) AS value FROM m GROUP BY model, score)
SELECT model, round(min(score), 6) AS lo, round(max(score), 6) AS hi, CAST(sum(n) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS y,
       round(value, 6) AS value
FROM f JOIN g USING (model, score) GROUP BY model, value
""")
def q_isotonic_pools(spark, sf_dir):
    train = doc_scores(spark, sf_dir).where(F.col("split") == "train")
    pools = [isotonic_pools(train.where(F.col("model") == m)).select(F.lit(m).alias("model"), "*") for m in ("length", "brevity")]
    return round_floats(pools[0].unionByName(pools[1]))


# ------------------------------------------------------------------ M4
@register("threshold_sweep", f"""
WITH {SCORES_SQL}, {SWEEP_SQL}
SELECT model, round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM sweep
""")
def q_threshold_sweep(spark, sf_dir):
    train = doc_scores(spark, sf_dir).where(F.col("split") == "train")
    return round_floats(T.threshold_sweep(train, ["model"], steps=STEPS))


# ------------------------------------------------------------------ M5
@register("choose_threshold", f"""
WITH {SCORES_SQL}, {SWEEP_SQL}, {_choose_sql(TARGET_RECALL)}
SELECT model, round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM chosen
""")
def q_choose_threshold(spark, sf_dir):
    train = doc_scores(spark, sf_dir).where(F.col("split") == "train")
    sweep = T.threshold_sweep(train, ["model"], steps=STEPS)
    return round_floats(T.choose_threshold(sweep, ["model"], target_recall=TARGET_RECALL))


def _tuned_metrics(spark, sf_dir):
    scores = doc_scores(spark, sf_dir)
    sweep = T.threshold_sweep(scores.where(F.col("split") == "train"), ["model"], steps=STEPS)
    chosen = T.choose_threshold(sweep, ["model"])
    return T.evaluate_at_threshold(scores, chosen, ["model"])


# ------------------------------------------------------------------ M6
@register("threshold_eval", f"""
WITH {SCORES_SQL}, {SWEEP_SQL}, {_choose_sql(None)},
pred AS (SELECT sc.*, CASE WHEN score >= chosen.threshold THEN 1 ELSE 0 END AS pr
         FROM sc JOIN chosen ON sc.model = chosen.model), {COUNTS_SQL}
SELECT met.model, met.split, round(chosen.threshold, 6) AS threshold, round(accuracy, 6) AS accuracy,
       round(met.precision, 6) AS precision, round(met.recall, 6) AS recall, round(met.f1, 6) AS f1,
       round(roc_auc, 6) AS roc_auc
FROM met JOIN auc ON met.model = auc.model AND met.split = auc.split JOIN chosen ON met.model = chosen.model
""")
def q_threshold_eval(spark, sf_dir):
    m = _tuned_metrics(spark, sf_dir)
    return round_floats(m.select("model", "split", "threshold", "accuracy", "precision", "recall", "f1", "roc_auc"))


def metrics_table(spark, sf_dir):
    """One row per (model, variant, split)."""
    base = E.binary_metrics(_baseline(spark, sf_dir), ["model", "split"]).withColumn("variant", F.lit("baseline"))
    tuned = _tuned_metrics(spark, sf_dir).withColumn("variant", F.lit("threshold_tuned"))
    cols = ["model", "variant", "split", "accuracy", "precision", "recall", "f1", "roc_auc"]
    return base.select(*cols).unionByName(tuned.select(*cols))


_METRICS_TABLE_SQL = f"""
WITH {SCORES_SQL}, {SWEEP_SQL}, {_choose_sql(None)},
pred AS (SELECT sc.model, sc.doc_id, 'baseline' AS variant, sc.split, label, score,
                CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pr FROM sc
         UNION ALL
         SELECT sc.model, sc.doc_id, 'threshold_tuned', sc.split, label, score,
                CASE WHEN score >= chosen.threshold THEN 1 ELSE 0 END FROM sc JOIN chosen ON sc.model = chosen.model),
cnt AS (SELECT model, variant, split, count(CASE WHEN label = 0 AND pr = 0 THEN 1 END) AS tn,
               count(CASE WHEN label = 0 AND pr = 1 THEN 1 END) AS fp,
               count(CASE WHEN label = 1 AND pr = 0 THEN 1 END) AS fn,
               count(CASE WHEN label = 1 AND pr = 1 THEN 1 END) AS tp
        FROM pred GROUP BY model, variant, split),
d AS (SELECT model, split, score, count(CASE WHEN label = 1 THEN 1 END) AS pos,
             count(CASE WHEN label = 0 THEN 1 END) AS neg FROM sc GROUP BY model, split, score),
r AS (SELECT *, sum(neg) OVER (PARTITION BY model, split ORDER BY score
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum FROM d),
auc AS (SELECT model, split, sum(pos * (neg_cum - neg) + 0.5 * pos * neg) / nullif(sum(pos) * sum(neg), 0)
               AS roc_auc FROM r GROUP BY model, split),
mt AS (SELECT cnt.model, variant, cnt.split,
              coalesce((tp + tn) / nullif(CAST(tp + tn + fp + fn AS DOUBLE), 0), 0.0) AS accuracy,
              coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
              coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall,
              coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1, roc_auc
       FROM cnt JOIN auc ON cnt.model = auc.model AND cnt.split = auc.split)"""


# ------------------------------------------------------------------ A25
@register("metrics_table", f"""{_METRICS_TABLE_SQL}
SELECT model, variant, split, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1, round(roc_auc, 6) AS roc_auc FROM mt
""")
def q_metrics_table(spark, sf_dir):
    return round_floats(metrics_table(spark, sf_dir))


# ------------------------------------------------------------------ P7
@register("metrics_long", f"""{_METRICS_TABLE_SQL}
SELECT model, variant, split, metric, round(value, 6) AS value FROM mt
UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1))
""")
def q_metrics_long(spark, sf_dir):
    return round_floats(E.metrics_long(metrics_table(spark, sf_dir), ["model", "variant", "split"]))


# ------------------------------------------------------------------ J7
@register("f1_gap", f"""{_METRICS_TABLE_SQL}
SELECT a.model, a.variant, round(a.f1 - b.f1, 6) AS f1_gap
FROM mt a JOIN mt b ON a.model = b.model AND a.variant = b.variant AND a.split = 'train' AND b.split = 'test'
""")
def q_f1_gap(spark, sf_dir):
    return round_floats(E.f1_gap(metrics_table(spark, sf_dir)))
