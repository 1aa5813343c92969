"""Profiling queries on the customer-profile table (train split, as the EDA step)."""

from __future__ import annotations

from pyspark.sql import functions as F

from segmetric.functions.scalar import safe_name
from segmetric.operators import profiling as P
from segmetric.operators.validate import load_labelled
from segmetric.plans.catalog import register
from segmetric.plans.common import round_floats
from segmetric.sources.profile import CATEGORICAL, CP_SQL, NUMERIC, customer_profile
from segmetric.sources.tables import read_table


def train_profile(spark, sf_dir):
    return customer_profile(spark, sf_dir).where(F.col("split") == "train")


def _cat_long_sql(where: str = "split = 'train'") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'NA') AS category, lapsed AS y "
        f"FROM cp WHERE {where}" for c in CATEGORICAL)


def _num_long_sql(cols=NUMERIC, extra: str = "", where: str = "split = 'train'") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS x{extra} FROM cp WHERE {where} AND {c} IS NOT NULL"
        for c in cols)


# ---------------------------------------------------------------- A5 (entry)
@register("outcome_rate_by_category", f"""
WITH {CP_SQL}, long AS ({_cat_long_sql()}),
agg AS (SELECT feature, category, avg(y) AS outcome_rate, count(*) AS n FROM long
        GROUP BY feature, category HAVING count(*) >= 20),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY outcome_rate DESC, n DESC, category) AS rank
      FROM agg)
SELECT feature, category, round(outcome_rate, 6) AS outcome_rate, CAST(n AS BIGINT) AS n,
       CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 30
""")
def q_outcome_rate_by_category(spark, sf_dir):
    df = P.outcome_rate_by_category(train_profile(spark, sf_dir), CATEGORICAL, label="lapsed")
    return round_floats(df.select("feature", "category", "outcome_rate", F.col("n").cast("long"),
                                  F.col("rank").cast("int")))


# ---------------------------------------------------------------- S1 / V1 / V2
@register("scan_labelled", f"""
WITH {CP_SQL}
SELECT row_id, mktsegment, nation, region_code, round(acctbal, 6) AS acctbal, tenure_days, recency_days,
       n_orders, round(total_qty, 6) AS total_qty, round(gross_price, 6) AS gross_price,
       round(net_price, 6) AS net_price, round(avg_discount, 6) AS avg_discount, returned_lines,
       lapsed AS label, split
FROM cp
""")
def q_scan_labelled(spark, sf_dir):
    cp = customer_profile(spark, sf_dir)
    return round_floats(load_labelled(cp, "lapsed", true_values=("1", "TRUE"), false_values=("0", "FALSE")))


# ---------------------------------------------------------------- A1
@register("label_overview", f"""
WITH {CP_SQL}
SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(CASE WHEN lapsed = 1 THEN 1 END) AS BIGINT) AS n_positive,
       CAST(count(CASE WHEN lapsed = 0 THEN 1 END) AS BIGINT) AS n_negative,
       round(coalesce(count(CASE WHEN lapsed = 1 THEN 1 END) / nullif(count(*), 0), 0.0), 6) AS positive_rate
FROM cp WHERE split = 'train'
""")
def q_label_overview(spark, sf_dir):
    return round_floats(P.label_overview(train_profile(spark, sf_dir), "lapsed"))


# ---------------------------------------------------------------- A2
_ALL_FEATURES = CATEGORICAL + NUMERIC


@register("missing_table", f"""
WITH {CP_SQL}, long AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, count(*) AS n FROM cp WHERE split = 'train'"
    for c in _ALL_FEATURES)})
SELECT "column", CAST(missing AS BIGINT) AS missing, round(missing / n, 6) AS missing_rate
FROM long WHERE missing > 0
""")
def q_missing_table(spark, sf_dir):
    return round_floats(P.missing_table(train_profile(spark, sf_dir), _ALL_FEATURES))


# ---------------------------------------------------------------- A3
@register("numeric_summary", f"""
WITH {CP_SQL}, long AS ({_num_long_sql()})
SELECT "column", CAST(count(*) AS BIGINT) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
       round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.5), 6) AS p50,
       round(quantile_cont(x, 0.75), 6) AS p75, round(max(x), 6) AS max
FROM long GROUP BY "column"
""")
def q_numeric_summary(spark, sf_dir):
    return round_floats(P.numeric_summary(train_profile(spark, sf_dir), NUMERIC))


# ---------------------------------------------------------------- A4
@register("category_freq", f"""
WITH {CP_SQL}, long AS ({_cat_long_sql()}),
c AS (SELECT feature, category, count(*) AS cnt FROM long GROUP BY feature, category),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY cnt DESC, category) AS rank FROM c),
b AS (SELECT feature, CASE WHEN feature = 'nation' AND rank > 15 THEN 'Other' ELSE category END AS category,
             cnt, rank FROM r WHERE feature = 'nation' OR rank <= 30)
SELECT feature, category, CAST(sum(cnt) AS BIGINT) AS count, CAST(min(rank) AS INTEGER) AS rank
FROM b GROUP BY feature, category
""")
def q_category_freq(spark, sf_dir):
    return P.category_freq(train_profile(spark, sf_dir), CATEGORICAL, top_n_col="nation", top_n=15, head=30)


# ---------------------------------------------------------------- A10 / A11
def _corr_sql(a: str, b: str) -> str:
    xa = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
    xb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    return f"coalesce(covar_samp({xa}, {xb}) / nullif(stddev_samp({xa}) * stddev_samp({xb}), 0), 0.0)"


def _corr_matrix_sql() -> str:
    parts = []
    for i, a in enumerate(NUMERIC):
        for b in NUMERIC[i:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_corr_sql(a, b)} AS corr FROM cp "
                         f"WHERE split = 'train'")
            if a != b:
                parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {_corr_sql(a, b)} AS corr FROM cp "
                             f"WHERE split = 'train'")
    return " UNION ALL ".join(parts)


@register("corr_matrix", f"""
WITH {CP_SQL}, m AS ({_corr_matrix_sql()})
SELECT col_a, col_b, round(corr, 6) AS corr FROM m
""")
def q_corr_matrix(spark, sf_dir):
    return round_floats(P.corr_matrix(train_profile(spark, sf_dir), NUMERIC))


def _corr_pairs_sql() -> str:
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_corr_sql(a, b)} AS corr FROM cp WHERE split = 'train'"
             for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]]
    return " UNION ALL ".join(parts)


@register("corr_pairs", f"""
WITH {CP_SQL}, m AS ({_corr_pairs_sql()})
SELECT col_a, col_b, round(corr, 6) AS corr FROM m WHERE abs(corr) >= 0.95
""")
def q_corr_pairs(spark, sf_dir):
    return round_floats(P.corr_pairs(train_profile(spark, sf_dir), NUMERIC, threshold=0.95))


# ---------------------------------------------------------------- A16
@register("histogram", f"""
WITH {CP_SQL}, long AS ({_num_long_sql()}),
s AS (SELECT "column", count(*) AS n, min(x) AS vmin, max(x) AS vmax,
             quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM long GROUP BY "column"),
w AS (SELECT *, (vmax - vmin) / (log2(n) + 1.0) AS sturges, 2.0 * iqr * pow(CAST(n AS DOUBLE), -1.0 / 3.0) AS fd
      FROM s),
nb AS (SELECT "column", vmin, vmax,
              CAST(CASE WHEN vmax > vmin THEN ceil((vmax - vmin) /
                   (CASE WHEN fd > 0 THEN least(sturges, fd) ELSE sturges END)) ELSE 1 END AS INTEGER) AS nbins
       FROM w),
bins AS (SELECT "column", CAST(b AS INTEGER) AS bin, vmin + (vmax - vmin) * b / nbins AS lo,
                vmin + (vmax - vmin) * (b + 1) / nbins AS hi
         FROM nb, range(0, nbins) t(b)),
c AS (SELECT l."column", CAST(CASE WHEN vmax > vmin THEN least(nbins - 1, floor((x - vmin) / (vmax - vmin) * nbins))
                               END AS INTEGER) AS bin, count(*) AS cnt
      FROM long l JOIN nb ON l."column" = nb."column" GROUP BY 1, 2)
SELECT bins."column", bins.bin, round(lo, 6) AS lo, round(hi, 6) AS hi, CAST(coalesce(cnt, 0) AS BIGINT) AS count
FROM bins LEFT JOIN c ON bins."column" = c."column" AND bins.bin = c.bin
""")
def q_histogram(spark, sf_dir):
    return round_floats(P.histogram(train_profile(spark, sf_dir), NUMERIC))


# ---------------------------------------------------------------- A17
@register("kde", f"""
WITH {CP_SQL}, long AS ({_num_long_sql()}),
s AS (SELECT "column", count(*) AS n, stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h,
             min(x) AS vmin, max(x) AS vmax FROM long GROUP BY "column"),
g AS (SELECT "column", n, h, vmin - 3.0 * h AS g0, (vmax - vmin + 2 * 3.0 * h) / 199 AS gstep FROM s WHERE h > 0),
pts AS (SELECT "column", n, h, CAST(i AS INTEGER) AS point, g0 + i * gstep AS grid FROM g, range(0, 200) t(i))
SELECT pts."column", point, round(grid, 6) AS grid,
       round(sum(exp(-0.5 * ((grid - x) / h) * ((grid - x) / h)) / (n * h * sqrt(2 * pi()))), 6) AS density
FROM pts JOIN long ON pts."column" = long."column"
GROUP BY pts."column", point, grid
""")
def q_kde(spark, sf_dir):
    return round_floats(P.kde(train_profile(spark, sf_dir), NUMERIC))


# ---------------------------------------------------------------- A18
@register("box_stats", f"""
WITH {CP_SQL}, long AS ({_num_long_sql(extra=', lapsed AS label')}),
q AS (SELECT label, "column", count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM long GROUP BY label, "column"),
j AS (SELECT q.*, q3 - q1 AS iqr, x FROM q JOIN long l ON q.label = l.label AND q."column" = l."column")
SELECT label, "column", CAST(n AS BIGINT) AS n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr,
       round(min(CASE WHEN x >= q1 - 1.5 * iqr AND x <= q3 + 1.5 * iqr THEN x END), 6) AS whisker_lo,
       round(max(CASE WHEN x >= q1 - 1.5 * iqr AND x <= q3 + 1.5 * iqr THEN x END), 6) AS whisker_hi,
       CAST(count(CASE WHEN NOT (x >= q1 - 1.5 * iqr AND x <= q3 + 1.5 * iqr) THEN 1 END) AS BIGINT) AS n_outliers
FROM j GROUP BY label, "column", n, q1, median, q3, iqr
""")
def q_box_stats(spark, sf_dir):
    return round_floats(P.box_stats(train_profile(spark, sf_dir).withColumnRenamed("lapsed", "label"),
                                    NUMERIC, by="label"))


# ---------------------------------------------------------------- F3
@register("safe_name", """
SELECT p_partkey, lower(trim(regexp_replace(p_name, '[^\\p{L}\\p{N}]', '_', 'g'), '_')) AS safe_name FROM part
""")
def q_safe_name(spark, sf_dir):
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    return part.select("p_partkey", safe_name("p_name").alias("safe_name"))
