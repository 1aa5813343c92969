"""Distance and clustering queries.

Vector operators run on ``embeddings`` (64-d unit vectors, 10 labels).
Customer segmentation runs on the standardised numeric block of the customer
profile (train split) with deterministic Lloyd K-Means, so cluster tables have
exact oracles; the seeded Spark ML K-Means runs are rows-only checks.
"""

from __future__ import annotations


from pyspark.sql import functions as F

from segmetric.operators import cluster as K
from segmetric.operators import distance as D
from segmetric.operators import prep as X
from segmetric.operators.classify import knn_scores
from segmetric.operators.metric_index import pivot_index
from segmetric.operators.quantiles import quantiles_long
from segmetric.operators.splits import shuffle_key
from segmetric.plans.catalog import register
from segmetric.plans.common import round_floats
from segmetric.plans.q_prep import PREP_NUM, _imputed_sql
from segmetric.sources.profile import CP_SQL, NUMERIC, customer_profile
from segmetric.sources.tables import read_table

# fixed parameters of the checked runs
KNN_K = 5
INDEX_BLOCK = 256
EPS = 1.14
MIN_SAMPLES = 3
EPS_QUANTILES = [0.90, 0.93, 0.95, 0.97, 0.99, 0.995, 0.999]
KNN_CLASSIFY_K = 15
SEG_K = 4
PROFILE_CATEGORICAL = ["mktsegment", "nation"]


def embeddings(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return D.as_vectors(e, "vec_id", "embedding", ["label"])


EMB_SQL = "e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"


def _pairs_sql(eps: float) -> str:
    return (f"pr AS (SELECT a.id AS i, b.id AS j, list_distance(a.v, b.v) AS distance FROM e a, e b "
            f"WHERE list_distance(a.v, b.v) <= {eps})")


def _silhouette_sql(lab: str) -> str:
    """ss: per-row silhouette of rows in ``lab`` (id, cluster) using e.v."""
    return f"""
sd AS (SELECT a.id, la.cluster AS c, lb.cluster AS o, list_distance(a.v, b.v) AS dist
       FROM e a JOIN {lab} la ON a.id = la.id, e b JOIN {lab} lb ON b.id = lb.id),
sper AS (SELECT id, c, o, sum(dist) AS s, count(*) AS n FROM sd GROUP BY id, c, o),
sab AS (SELECT id, c, max(CASE WHEN o = c AND n > 1 THEN s / (n - 1) END) AS a,
               min(CASE WHEN o <> c THEN s / n END) AS b, max(CASE WHEN o = c THEN n END) AS nn
        FROM sper GROUP BY id, c),
ss AS (SELECT id, c, CASE WHEN nn <= 1 OR b IS NULL THEN 0.0
                          ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0.0) END AS s FROM sab)"""


_DBSCAN_SQL = f"""
cores AS (SELECT i AS id FROM pr GROUP BY i HAVING count(*) >= {MIN_SAMPLES}),
ce AS (SELECT i, j FROM pr WHERE i IN (SELECT id FROM cores) AND j IN (SELECT id FROM cores)),
reach(src, dst) AS (SELECT id, id FROM cores UNION SELECT reach.src, ce.j FROM reach JOIN ce ON reach.dst = ce.i),
croot AS (SELECT src AS id, min(dst) AS root FROM reach GROUP BY src),
num AS (SELECT root, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster
        FROM (SELECT DISTINCT root FROM croot)),
corelab AS (SELECT croot.id, num.cluster FROM croot JOIN num ON croot.root = num.root),
border AS (SELECT pr.i AS id, min(corelab.cluster) AS cluster FROM pr JOIN corelab ON pr.j = corelab.id
           GROUP BY pr.i),
dlab AS (SELECT e.id, CAST(coalesce(corelab.cluster, border.cluster, -1) AS INTEGER) AS cluster
         FROM e LEFT JOIN corelab ON e.id = corelab.id LEFT JOIN border ON e.id = border.id)"""


# ---------------------------------------------------------------- J4
@register("knn_join", f"""
WITH {EMB_SQL},
d AS (SELECT a.id AS query_id, b.id AS neighbor_id, list_distance(a.v, b.v) AS distance FROM e a, e b),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM d)
SELECT query_id, neighbor_id, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM r WHERE rank <= {KNN_K}
""")
def q_knn_join(spark, sf_dir):
    v = embeddings(spark, sf_dir)
    nn = D.knn_join(v, v, KNN_K)
    return round_floats(nn.select("query_id", "neighbor_id", F.col("rank").cast("int"), "distance"))


@register("knn_join_indexed", f"""
WITH {EMB_SQL},
d AS (SELECT a.id AS query_id, b.id AS neighbor_id, list_distance(a.v, b.v) AS distance FROM e a, e b WHERE a.id <> b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM d)
SELECT query_id, neighbor_id, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM r WHERE rank <= {KNN_K}
""")
def q_knn_join_indexed(spark, sf_dir):
    """Nearest other rows over the pivot index, at every size of the table."""
    v = embeddings(spark, sf_dir)
    nn = pivot_index(v, block_rows=INDEX_BLOCK).knn(v, KNN_K, exclude_self=True)
    return round_floats(nn.select("query_id", "neighbor_id", F.col("rank").cast("int"), "distance"))


# ---------------------------------------------------------------- J5
@register("eps_pairs", f"""
WITH {EMB_SQL}, {_pairs_sql(EPS)}
SELECT i, j, round(distance, 6) AS distance FROM pr
""")
def q_eps_pairs(spark, sf_dir):
    return round_floats(D.radius_join(embeddings(spark, sf_dir), EPS))


# ---------------------------------------------------------------- A15
_KDIST_SQL = f"""
kd AS (SELECT query_id AS id, distance AS kdist FROM (
         SELECT a.id AS query_id, list_distance(a.v, b.v) AS distance,
                row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS rank
         FROM e a, e b) WHERE rank = {MIN_SAMPLES}),
q AS (SELECT unnest([{", ".join(str(p) for p in EPS_QUANTILES)}]) AS prob,
             unnest(quantile_cont(kdist, [{", ".join(str(p) for p in EPS_QUANTILES)}])) AS value FROM kd)"""


@register("knn_dist_quantiles", f"""
WITH {EMB_SQL}, {_KDIST_SQL}
SELECT prob, round(value, 6) AS value FROM q
""")
def q_knn_dist_quantiles(spark, sf_dir):
    kd = K.kth_neighbour_distance(embeddings(spark, sf_dir), MIN_SAMPLES)
    q = quantiles_long(kd.select(F.lit("kdist").alias("column"), F.col("kdist").alias("x")), ["column"],
                       EPS_QUANTILES)
    return round_floats(q.select("prob", "value"))


# ---------------------------------------------------------------- K4
@register("eps_candidates", f"""
WITH {EMB_SQL}, {_KDIST_SQL},
c AS (SELECT DISTINCT value * m AS eps FROM q, (VALUES {", ".join(f"({m})" for m in K.EPS_MULTIPLIERS)}) t(m)
      WHERE value * m > 0)
SELECT round(eps, 6) AS eps FROM c
""")
def q_eps_candidates(spark, sf_dir):
    return round_floats(K.eps_candidates(embeddings(spark, sf_dir), MIN_SAMPLES, EPS_QUANTILES))


# ---------------------------------------------------------------- K3
@register("silhouette", f"""
WITH {EMB_SQL}, lab AS (SELECT id, label AS cluster FROM e), {_silhouette_sql("lab")}
SELECT round(avg(s), 6) AS silhouette FROM ss
""")
def q_silhouette(spark, sf_dir):
    v = embeddings(spark, sf_dir).withColumnRenamed("label", "cluster")
    return round_floats(D.silhouette(v))


# ---------------------------------------------------------------- K5
@register("dbscan", f"""
WITH RECURSIVE {EMB_SQL}, {_pairs_sql(EPS)}, {_DBSCAN_SQL}
SELECT id AS vec_id, cluster FROM dlab
""")
def q_dbscan(spark, sf_dir):
    v = embeddings(spark, sf_dir)
    return K.dbscan(v, EPS, MIN_SAMPLES).select(F.col("id").alias("vec_id"), "cluster")


# ---------------------------------------------------------------- A20
@register("clustering_quality", f"""
WITH RECURSIVE {EMB_SQL}, {_pairs_sql(EPS)}, {_DBSCAN_SQL},
nz AS (SELECT id, cluster FROM dlab WHERE cluster <> -1), {_silhouette_sql("nz")},
st AS (SELECT CAST(count(DISTINCT CASE WHEN cluster <> -1 THEN cluster END) AS BIGINT) AS n_clusters,
              avg(CASE WHEN cluster = -1 THEN 1.0 ELSE 0.0 END) AS noise_ratio,
              count(CASE WHEN cluster <> -1 THEN 1 END) AS n_core FROM dlab)
SELECT n_clusters, round(noise_ratio, 6) AS noise_ratio,
       CASE WHEN n_clusters >= 2 AND n_core >= 10 THEN round((SELECT avg(s) FROM ss), 6) END AS silhouette
FROM st
""")
def q_clustering_quality(spark, sf_dir):
    v = embeddings(spark, sf_dir)
    lab = K.dbscan(v, EPS, MIN_SAMPLES)
    return round_floats(K.clustering_quality(v, lab))


# ---------------------------------------------------------------- C2
@register("knn_classify", f"""
WITH {EMB_SQL},
tr AS (SELECT id, v, label % 2 AS y FROM e WHERE id % 5 <> 0),
te AS (SELECT id, v FROM e WHERE id % 5 = 0),
d AS (SELECT te.id AS q, tr.id AS r, tr.y, list_distance(te.v, tr.v) AS dist FROM te, tr),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY dist, r) AS rk FROM d)
       WHERE rk <= {KNN_CLASSIFY_K}),
w AS (SELECT q, y, dist, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY q) AS has0 FROM nn),
ww AS (SELECT q, y, CASE WHEN has0 = 1 THEN (CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END) ELSE 1.0 / dist END AS wt
       FROM w),
sc AS (SELECT q AS vec_id, sum(CASE WHEN y = 1 THEN wt ELSE 0 END) / sum(wt) AS score FROM ww GROUP BY q)
SELECT vec_id, round(score, 6) AS score, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred FROM sc
""")
def q_knn_classify(spark, sf_dir):
    v = embeddings(spark, sf_dir).withColumn("y", (F.col("label") % 2).cast("int"))
    train = v.where(F.col("id") % 5 != 0)
    test = v.where(F.col("id") % 5 == 0)
    s = knn_scores(train, test, KNN_CLASSIFY_K, weights="distance")
    return round_floats(s.select(F.col("id").alias("vec_id"), "score", "pred"))


# ---------------------------------------------------------------- customer segments (deterministic K-Means)
def standardized_train(spark, sf_dir):
    """Train rows with median-imputed, population-standardised numeric block (num__*)."""
    train = customer_profile(spark, sf_dir).where(F.col("split") == "train").cache()
    med = X.MedianImputer(inputCols=PREP_NUM).fit(train)
    imp = med.transform(train)
    sc = X.PopulationScaler(inputCols=PREP_NUM).fit(imp)
    # raw columns stay as in the profile (with their missing values) for the cluster tables
    z = sc.transform(imp).select("row_id", *[f"num__{c}" for c in PREP_NUM])
    return train.join(z, "row_id"), [f"num__{c}" for c in PREP_NUM]


def segment_labels(spark, sf_dir):
    df, cols = standardized_train(spark, sf_dir)
    df = df.checkpoint(eager=True)
    key = shuffle_key("row_id", 42, portable=True)
    init = [[r[c] for c in cols] for r in df.orderBy(key, "row_id").limit(SEG_K).collect()]
    lab, _ = K.lloyd_kmeans(df, cols, init)
    return lab


def _kmeans_sql() -> str:
    zcols = ", ".join(f"({c} - mean_{c}) / std_{c} AS z_{c}" for c in PREP_NUM)
    parts = [f"""z AS (SELECT row_id, {zcols} FROM imp, st WHERE split = 'train'),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY (row_id * 7919 + 42) % 10007, row_id) - 1 AS INTEGER) AS cid,
              {", ".join(f"z_{c}" for c in PREP_NUM)}
       FROM z ORDER BY (row_id * 7919 + 42) % 10007, row_id LIMIT {SEG_K})"""]

    n = len(PREP_NUM)
    dist = " + ".join(f"(v[{j}] - c[{j}]) * (v[{j}] - c[{j}])" for j in range(1, n + 1))
    nearest = f"list_transform(centres, lambda c: {dist})"
    mean = ", ".join(f"coalesce(avg(v[{j}]) FILTER (NOT kept), any_value(v[{j}]) FILTER (kept))" for j in range(1, n + 1))
    # rounds until no row changes its cluster; a cluster without rows keeps its centre
    parts.append(f"""zv AS (SELECT row_id, [{", ".join(f"z_{c}" for c in PREP_NUM)}] AS v FROM z),
km(t, centres, labels, before) AS (
  SELECT 0, (SELECT list([{", ".join(f"z_{c}" for c in PREP_NUM)}] ORDER BY cid) FROM c0), []::BIGINT[], NULL::BIGINT[]
  UNION ALL
  SELECT any_value(t) + 1, list(m ORDER BY cid) FILTER (m IS NOT NULL), flatten(list(coalesce(ids, []) ORDER BY cid)), any_value(labels)
  FROM (
    SELECT t, labels, cid, [{mean}] AS m, list(cid * 10000000000 + row_id ORDER BY row_id) FILTER (NOT kept) AS ids
    FROM (
      SELECT t, labels, v, list_position({nearest}, list_min({nearest})) - 1 AS cid, row_id, FALSE AS kept FROM km, zv
      UNION ALL
      SELECT t, labels, centres[i + 1], i, NULL, TRUE FROM km, range({SEG_K}) r(i))
    GROUP BY t, labels, cid)
  HAVING flatten(list(coalesce(ids, []) ORDER BY cid)) <> any_value(labels)),
ke AS (SELECT centres FROM km ORDER BY t DESC LIMIT 1),
seg AS (SELECT row_id, CAST(list_position({nearest}, list_min({nearest})) - 1 AS INTEGER) AS cluster FROM zv, ke)""")
    return ",\n".join(parts)


_SEG_SQL = f"{CP_SQL}, {_imputed_sql()},\n{_kmeans_sql()}"


@register("kmeans_assign", f"""
WITH RECURSIVE {_SEG_SQL}
SELECT row_id, cluster FROM seg
""")
def q_kmeans_assign(spark, sf_dir):
    return segment_labels(spark, sf_dir).select("row_id", F.col("cluster").cast("int"))


@register("segment_join", f"""
WITH RECURSIVE {_SEG_SQL}
SELECT seg.row_id, seg.cluster, cp.lapsed FROM seg JOIN cp ON seg.row_id = cp.row_id
""")
def q_segment_join(spark, sf_dir):
    return segment_labels(spark, sf_dir).select("row_id", F.col("cluster").cast("int"), "lapsed")


@register("cluster_sizes", f"""
WITH RECURSIVE {_SEG_SQL}
SELECT cluster, CAST(count(*) AS BIGINT) AS count FROM seg GROUP BY cluster
""")
def q_cluster_sizes(spark, sf_dir):
    lab = segment_labels(spark, sf_dir).select("row_id", F.col("cluster").cast("int"))
    return K.cluster_sizes(lab)


@register("outcome_by_cluster", f"""
WITH RECURSIVE {_SEG_SQL}
SELECT cluster, round(avg(lapsed), 6) AS outcome_rate, CAST(count(*) AS BIGINT) AS count
FROM seg JOIN cp ON seg.row_id = cp.row_id GROUP BY cluster
""")
def q_outcome_by_cluster(spark, sf_dir):
    lab = segment_labels(spark, sf_dir).select(F.col("cluster").cast("int"), "lapsed")
    return round_floats(K.outcome_by_cluster(lab, "lapsed"))


@register("cluster_profile_numeric", f"""
WITH RECURSIVE {_SEG_SQL}, j AS (SELECT seg.cluster, cp.* EXCLUDE (row_id) FROM seg JOIN cp ON seg.row_id = cp.row_id)
SELECT cluster, {", ".join(f"round(avg({c}), 6) AS {c}__mean, round(quantile_cont({c}, 0.5), 6) AS {c}__median"
                            for c in NUMERIC)}
FROM j GROUP BY cluster
""")
def q_cluster_profile_numeric(spark, sf_dir):
    lab = segment_labels(spark, sf_dir).withColumn("cluster", F.col("cluster").cast("int"))
    return round_floats(K.profile_numeric(lab, NUMERIC))


@register("cluster_profile_categorical", f"""
WITH RECURSIVE {_SEG_SQL}, j AS (SELECT seg.cluster, cp.mktsegment, cp.nation FROM seg JOIN cp ON seg.row_id = cp.row_id),
long AS (SELECT cluster, 'mktsegment' AS feature, mktsegment AS category FROM j
         UNION ALL SELECT cluster, 'nation', nation FROM j),
c AS (SELECT cluster, feature, category, count(*) AS cnt FROM long WHERE category IS NOT NULL
      GROUP BY cluster, feature, category),
s0 AS (SELECT *, cnt / sum(cnt) OVER (PARTITION BY cluster, feature) AS pct FROM c),
s AS (SELECT *, row_number() OVER (PARTITION BY cluster, feature ORDER BY pct DESC, category) AS rk FROM s0)
SELECT cluster, feature, category, round(pct, 6) AS pct_in_cluster, CAST(cnt AS BIGINT) AS count FROM s WHERE rk <= 5
""")
def q_cluster_profile_categorical(spark, sf_dir):
    lab = segment_labels(spark, sf_dir).withColumn("cluster", F.col("cluster").cast("int"))
    return round_floats(K.profile_categorical(lab, PROFILE_CATEGORICAL))


# ---------------------------------------------------------------- K6 (rows-only: a search table)
@register("dbscan_search")
def q_dbscan_search(spark, sf_dir):
    scores, eps, ms = K.dbscan_search(embeddings(spark, sf_dir), [3, 5, 10], EPS_QUANTILES, strict=False)
    if eps is None:  # every candidate degenerate: the table is reported, nothing is chosen
        return scores.withColumn("chosen", F.lit(False))
    return scores.withColumn("chosen", (F.col("eps") == F.lit(eps)) & (F.col("min_samples") == F.lit(float(ms))))
