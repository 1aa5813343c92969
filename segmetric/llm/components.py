"""Connected components of a link table by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmetric.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b); label is the smallest node of its
    component. Null ends and self links are ignored.

    Each round hooks a node's parent onto the smallest grandparent among its neighbours
    and halves all paths, so the rounds grow with the logarithm of the component's size.
    Only minima are aggregated (with map-side combine), so a hub is never gathered.
    Runs until a round changes nothing.
    """
    e = links.where(F.col("a") != F.col("b")).select("a", "b")
    e = written(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    f = written(e.groupBy("a").agg(F.min("b").alias("m"))
                .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        up = f.alias("x").join(f.alias("y"), F.col("x.label") == F.col("y.node")).select(
            F.col("x.node").alias("node"), F.col("x.label").alias("label"), F.col("y.label").alias("gp"))
        up = written(up, "grand")
        near = (e.join(up.select(F.col("node").alias("b"), "gp"), "b").groupBy("a").agg(F.min("gp").alias("m"))
                .withColumnRenamed("a", "node"))
        both = up.join(near, "node")
        offers = both.select(F.explode(F.array(
            F.struct(F.col("node"), F.least("gp", "m").alias("to")),
            F.struct(F.col("label").alias("node"), F.least("gp", "m").alias("to")))).alias("o")).select("o.*")
        new = offers.groupBy("node").agg(F.min("to").alias("to"))
        f2 = written(f.join(new, "node").select("node", F.least("label", "to").alias("label"),
                                                (F.col("to") < F.col("label")).alias("moved")), "labels")
        moved = not f2.where("moved").isEmpty()
        f = f2.select("node", "label")
        if not moved:
            return f
