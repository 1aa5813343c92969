"""URL rules: host-suffix and path-prefix expressions, short hash prefixes, full digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmetric.llm.common import local_table, small_side

#: Hex digits of the SHA-256 digest that the equi-join compares.
SHORT = 8


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty
    for null or where there is no ``://``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), upper, upper.lower())


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty as for ``url_host``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, host, path, verdict) of rules such as ``("block", "net/")``: the host ends at
    the first ``/``, the path starts there."""
    rows = [(r, r.partition("/")[0].lower(), "/" + r.partition("/")[2] if "/" in r else "", v) for v, r in rules]
    return local_table(spark, rows, "rule string, host string, path string, verdict string")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url",
               broadcast_rows: int = 100_000) -> DataFrame:
    """``pages`` with the columns host, path, rule, verdict.

    Every distinct (host, path) is expanded into expressions: each suffix of the host that
    starts at a label, with each prefix of the path that is as long as some rule's path.
    Expressions and rules meet on the first digits of their SHA-256 digest; equal full
    digests and equal texts confirm them. The longest rule wins (characters of host and
    path); of equally long ones ``block`` wins, then the first by text. Without a rule the
    verdict is ``default`` and rule is null.

    Null, empty and malformed URLs have empty host and path and meet no rule. Every row of
    ``pages`` comes back once, repeated rows too. A rule with null host or path is ignored;
    columns of ``pages`` named as the new ones are replaced.
    """
    new = ["host", "path", "rule", "verdict"]
    kept = [c for c in pages.columns if c.lower() not in new]
    parsed = pages.select(*[F.col(f"`{c}`") for c in kept], url_host(F.col(f"`{url_col}`")).alias("__host"),
                          url_path(F.col(f"`{url_col}`")).alias("__path"))
    known = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        "rule", "host", "path", "verdict", F.sha2(F.concat_ws("", "host", "path"), 256).alias("digest")).distinct()
    lengths = sorted(r[0] for r in known.select(F.length("path")).distinct().collect())  # below the longest rule
    places = parsed.where(F.col("__host") != "").select("__host", "__path").distinct()
    labels = F.split("__host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("__path"))
    expressions = (places.select("*", F.explode(hosts).alias("h")).select("*", F.explode(cuts).alias("n"))
                   .select("__host", "__path", F.concat("h", F.substring(F.col("__path"), F.lit(1), F.col("n"))).alias("x"),
                           F.length("h").alias("hl"))
                   .withColumn("x_digest", F.sha2("x", 256)))
    short = known.withColumn("short", F.substring("digest", 1, SHORT))
    found = (expressions.withColumn("short", F.substring("x_digest", 1, SHORT))
             .join(small_side(short, broadcast_rows), "short")
             .where((F.col("x_digest") == F.col("digest")) & (F.col("hl") == F.length("host"))
                    & (F.col("x") == F.concat("host", "path"))))
    best = found.groupBy(F.col("__host").alias("__h"), F.col("__path").alias("__p")).agg(F.min(F.struct(
        (-F.length("x")).alias("longest"), (F.col("verdict") != "block").alias("mild"), "rule", "verdict")).alias("__b"))
    judged = parsed.join(best, (F.col("__host") == F.col("__h")) & (F.col("__path") == F.col("__p")), "left")
    return judged.select(*[F.col(f"`{c}`") for c in kept], F.col("__host").alias("host"), F.col("__path").alias("path"),
                         F.col("__b.rule").alias("rule"), F.coalesce("__b.verdict", F.lit(default)).alias("verdict"))
