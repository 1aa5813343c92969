"""Customer-profile feature table (CP) built from the order tables.

One row per customer with at least one order before the cutoff. The label
``lapsed`` is 1 when the customer places no order on or after the cutoff.

Plan shape: lineitem is pre-aggregated per order (map-side partial
aggregation, one shuffle on l_orderkey), joined to orders on the unique
o_orderkey, then aggregated per customer with conditional sums, so every
order and line is read once and no key is duplicated by a join. The nation
dimension is broadcast behind a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmetric.sources.tables import broadcast_if_bounded, read_table

# Fixed values of the profile definition.
CUTOFF = "2000-05-01"
TEST_MODULUS = 5          # c_custkey % 5 = 0 -> test split
NULL_SEGMENT_MODULUS = 17  # c_custkey % 17 = 0 -> missing market segment

CATEGORICAL = ["mktsegment", "nation", "region_code"]
NUMERIC = [
    "acctbal", "tenure_days", "recency_days", "n_orders", "total_qty",
    "gross_price", "net_price", "avg_discount", "returned_lines",
]
LABEL = "lapsed"


def customer_profile(spark: SparkSession, sf_dir: str, cutoff: str = CUTOFF) -> DataFrame:
    cut = F.lit(cutoff).cast("timestamp_ntz")  # same type as the order dates: no session time zone involved
    cut_date = F.lit(cutoff).cast("date")
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    lines = read_table(spark, sf_dir, "lineitem",
                       ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"])
    # money is summed exactly as integers (cents; 1e-4 units for the discounted
    # price): the result does not depend on summation order, engine or layout
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    disc_pct = F.round(F.col("l_discount") * 100).cast("long")
    per_order = lines.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.sum(cents).alias("gross"),
        F.sum(cents * (100 - disc_pct)).alias("net"),
        F.sum(disc_pct).alias("disc"),
        F.count(F.lit(1)).alias("n_lines"),
        F.sum((F.col("l_returnflag") == "R").cast("long")).alias("returned"),
    )
    before = F.col("o_orderdate") < cut
    ol = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")

    def when_before(c):
        return F.when(before, c)

    per_cust = ol.groupBy(F.col("o_custkey").alias("row_id")).agg(
        F.count(when_before(F.lit(1))).alias("n_orders"),
        F.min(when_before(F.col("o_orderdate"))).alias("first_order"),
        F.max(when_before(F.col("o_orderdate"))).alias("last_order"),
        F.max((~before).cast("int")).alias("active_after"),
        F.sum(when_before(F.coalesce("qty", F.lit(0.0)))).alias("total_qty"),
        F.sum(when_before(F.coalesce("gross", F.lit(0)))).alias("gross_cents"),
        F.sum(when_before(F.coalesce("net", F.lit(0)))).alias("net_units"),
        F.sum(when_before(F.col("disc"))).alias("disc_sum"),
        F.sum(when_before(F.col("n_lines"))).alias("line_count"),
        F.sum(when_before(F.coalesce("returned", F.lit(0)))).alias("returned_lines"),
    ).where(F.col("n_orders") > 0)

    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = broadcast_if_bounded(read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"]))
    base = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
    cp = per_cust.join(base, per_cust.row_id == base.c_custkey, "inner")
    return cp.select(
        F.col("row_id").cast("long"),
        F.when(F.col("c_custkey") % NULL_SEGMENT_MODULUS == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")).alias("mktsegment"),
        F.col("n_name").alias("nation"),
        F.col("n_regionkey").cast("int").alias("region_code"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("double"))
        .otherwise(F.col("c_acctbal")).alias("acctbal"),
        F.datediff(cut_date, F.to_date("first_order")).cast("int").alias("tenure_days"),
        F.datediff(cut_date, F.to_date("last_order")).cast("int").alias("recency_days"),
        F.col("n_orders").cast("long"),
        F.col("total_qty").cast("double"),
        (F.col("gross_cents").cast("double") / 100.0).alias("gross_price"),
        (F.col("net_units").cast("double") / 10000.0).alias("net_price"),
        F.try_divide(F.col("disc_sum").cast("double"), F.col("line_count") * 100.0).alias("avg_discount"),
        F.col("returned_lines").cast("long"),
        (1 - F.coalesce(F.col("active_after"), F.lit(0))).cast("int").alias(LABEL),
        F.when(F.col("row_id") % TEST_MODULUS == 0, "test").otherwise("train").alias("split"),
    )


# DuckDB form of the same table, shared by the oracle SQL of every CP query.
CP_SQL = f"""
cp AS (
  WITH per_order AS (
    SELECT l_orderkey, sum(l_quantity) AS qty, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS gross,
           sum(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS net,
           sum(CAST(round(l_discount * 100) AS BIGINT)) AS disc,
           count(*) AS n_lines, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned
    FROM lineitem GROUP BY l_orderkey),
  per_cust AS (
    SELECT o_custkey AS row_id,
      count(CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN 1 END) AS n_orders,
      min(CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN o_orderdate END) AS first_order,
      max(CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN o_orderdate END) AS last_order,
      max(CASE WHEN o_orderdate >= TIMESTAMP '{CUTOFF}' THEN 1 ELSE 0 END) AS active_after,
      sum(CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN coalesce(qty, 0) END) AS total_qty,
      sum(CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN coalesce(gross, 0) END) AS gross_price,
      sum(CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN coalesce(net, 0) END) AS net_price,
      sum(CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN disc END) AS disc_sum,
      sum(CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN n_lines END) AS line_count,
      sum(CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN coalesce(returned, 0) END) AS returned_lines
    FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey
    GROUP BY o_custkey)
  SELECT CAST(p.row_id AS BIGINT) AS row_id,
    CASE WHEN c_custkey % {NULL_SEGMENT_MODULUS} = 0 THEN NULL ELSE c_mktsegment END AS mktsegment,
    n_name AS nation, CAST(n_regionkey AS INTEGER) AS region_code,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS acctbal,
    CAST(date_diff('day', CAST(first_order AS DATE), DATE '{CUTOFF}') AS INTEGER) AS tenure_days,
    CAST(date_diff('day', CAST(last_order AS DATE), DATE '{CUTOFF}') AS INTEGER) AS recency_days,
    CAST(n_orders AS BIGINT) AS n_orders,
    CAST(total_qty AS DOUBLE) AS total_qty, CAST(gross_price AS DOUBLE) / 100.0 AS gross_price,
    CAST(net_price AS DOUBLE) / 10000.0 AS net_price,
    CAST(disc_sum AS DOUBLE) / (line_count * 100.0) AS avg_discount,
    CAST(returned_lines AS BIGINT) AS returned_lines,
    CAST(1 - coalesce(active_after, 0) AS INTEGER) AS lapsed,
    CASE WHEN p.row_id % {TEST_MODULUS} = 0 THEN 'test' ELSE 'train' END AS split
  FROM per_cust p JOIN customer ON p.row_id = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  WHERE n_orders > 0)
"""
