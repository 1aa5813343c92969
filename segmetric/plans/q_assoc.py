"""Mutual-information queries on the processed customer features (train split)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from segmetric.operators import association as A
from segmetric.operators.prep import feature_names
from segmetric.plans.catalog import register
from segmetric.plans.common import round_floats
from segmetric.plans.q_prep import _entries_sql, _imputed_sql, _vocab_sql, processed
from segmetric.sources.profile import CP_SQL

TOP_K = 20
MI_NEIGHBOURS = 3


def feature_long(spark, sf_dir):
    """(row_id, feature, x, label) for every slot of the train matrix, zeros included."""
    out, _ = processed(spark, sf_dir)
    train = out.where(F.col("split") == "train")
    names = F.array(*[F.lit(n) for n in feature_names(train)])
    ex = train.select("row_id", "label", F.posexplode(vector_to_array("features")).alias("idx", "x"))
    return ex.select("row_id", F.element_at(names, F.col("idx") + 1).alias("feature"), "x", "label")


_MATRIX_SQL = f"""{CP_SQL}, {_imputed_sql()}, {_vocab_sql()}, {_entries_sql()},
rows_ AS (SELECT row_id, lapsed AS label FROM cp WHERE split = 'train'),
mat AS (SELECT r.row_id, n.name AS feature, coalesce(ent.value, 0.0) AS x, r.label
        FROM rows_ r CROSS JOIN names n LEFT JOIN ent ON ent.row_id = r.row_id AND ent.name = n.name)"""


def _digamma_sql(n: str) -> str:
    x = f"(CAST({n} AS DOUBLE) + 6.0)"
    shift = " + ".join(f"1.0 / (CAST({n} AS DOUBLE) + {j})" for j in range(6))
    return (f"(ln({x}) - 1 / (2 * {x}) - 1 / (12 * {x} * {x}) + 1 / (120 * pow({x}, 4)) - 1 / (252 * pow({x}, 6))"
            f" - ({shift}))")


def _top_sql(mi_cte: str) -> str:
    return f"""top AS (SELECT feature, mi, row_number() OVER (ORDER BY round(mi, 9) DESC, feature) AS rank FROM {mi_cte})
SELECT feature, round(mi, 6) AS mi, CAST(rank AS INTEGER) AS rank FROM top WHERE rank <= {TOP_K}"""


@register("mutual_info", f"""
WITH {_MATRIX_SQL},
edges AS (SELECT feature, quantile_cont(x, [{", ".join(str(q) for q in A.DECILES)}]) AS e FROM mat GROUP BY feature),
binned AS (SELECT mat.feature, len(list_filter(e, lambda q: mat.x > q)) AS bin, label
           FROM mat JOIN edges ON mat.feature = edges.feature),
c AS (SELECT feature, bin, label, CAST(count(*) AS DOUBLE) AS n_bl FROM binned GROUP BY feature, bin, label),
t AS (SELECT *, sum(n_bl) OVER (PARTITION BY feature) AS n, sum(n_bl) OVER (PARTITION BY feature, bin) AS n_b,
             sum(n_bl) OVER (PARTITION BY feature, label) AS n_l FROM c),
mi AS (SELECT feature, greatest(sum((n_bl / n) * ln(n_bl * n / (n_b * n_l))), 0.0) AS mi FROM t GROUP BY feature),
{_top_sql("mi")}
""")
def q_mutual_info(spark, sf_dir):
    mi = A.mutual_info_discrete(feature_long(spark, sf_dir))
    top = A.top_features(mi, TOP_K)
    return round_floats(top.select("feature", "mi", F.col("rank").cast("int")))


#: Values are put on a grid of 2^-20 (of a standard deviation, for scaled columns): x +- r is then
#: exact, so the interval test equals |x_j - x_i| < r for fractional columns too.
KNN_MI_GRID = 2 ** 20


@register("mutual_info_knn", f"""
WITH {_MATRIX_SQL},
b0 AS (SELECT row_id, feature, floor(x * {KNN_MI_GRID} + 0.5) / {KNN_MI_GRID} AS x, label FROM mat),
sz AS (SELECT feature, label, count(*) AS n_c FROM b0 GROUP BY feature, label),
b AS (SELECT b0.*, sz.n_c FROM b0 JOIN sz ON b0.feature = sz.feature AND b0.label = sz.label WHERE n_c > 1),
rk AS (SELECT *, row_number() OVER (PARTITION BY feature, label ORDER BY x, row_id) - 1 AS r FROM b),
cand AS (SELECT a.row_id, a.feature, a.x, a.n_c, abs(o.x - a.x) AS d FROM rk a JOIN rk o
         ON a.feature = o.feature AND a.label = o.label AND o.r BETWEEN a.r - {MI_NEIGHBOURS} AND a.r + {MI_NEIGHBOURS}
         AND o.r <> a.r),
rad AS (SELECT row_id, feature, x, n_c, least({MI_NEIGHBOURS}, n_c - 1) AS k_i,
               list_sort(list(d))[least({MI_NEIGHBOURS}, n_c - 1)] AS rad
        FROM cand GROUP BY row_id, feature, x, n_c),
mc AS (SELECT rad.row_id, rad.feature, rad.k_i, rad.n_c,
             (SELECT count(*) FROM b WHERE b.feature = rad.feature AND
                ((rad.rad > 0 AND abs(b.x - rad.x) < rad.rad) OR (rad.rad = 0 AND b.x = rad.x))) AS m
      FROM rad),
agg AS (SELECT feature, count(*) AS N, avg({_digamma_sql("k_i")}) AS pk, avg({_digamma_sql("n_c")}) AS pn,
               avg({_digamma_sql("mc.m")}) AS pm FROM mc GROUP BY feature),
mi AS (SELECT feature, greatest({_digamma_sql("N")} + pk - pn - pm, 0.0) AS mi FROM agg),
{_top_sql("mi")}
""")
def q_mutual_info_knn(spark, sf_dir):
    long = feature_long(spark, sf_dir).withColumn("x", F.floor(F.col("x") * KNN_MI_GRID + 0.5) / KNN_MI_GRID)
    top = A.top_features(A.mutual_info_knn(long, MI_NEIGHBOURS), TOP_K)
    return round_floats(top.select("feature", "mi", F.col("rank").cast("int")))
