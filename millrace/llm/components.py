"""Connected components of a link table, by rounds of star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import written


def _stars(links: DataFrame, small: bool) -> DataFrame:
    """Every node's larger (or, in a small star, smaller) neighbours linked to its smallest one."""
    if small:
        around = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        around = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    if small:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): the smallest node reachable.

    Large and small stars take turns until nothing changes; the number of rounds
    grows with the logarithm of the longest path. Each round is a written table.
    Nodes are joined on their own keys, so a hub is a skewed join, which Spark
    splits, never a collected list. No links: no rows.
    """
    now = written(links.select("a", "b").where("a <> b").distinct(), "links")
    sign = None
    while True:
        now = written(_stars(_stars(now, False), True), "links")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == sign:
            break
        sign = new
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
