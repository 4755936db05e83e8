"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epipanel.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, root (its component's smallest node) for every node of ``edges`` (columns a and b, longs).

    Each round hangs every node's larger neighbours on its smallest one, then its smaller ones; both are
    one aggregate and one join, and all that is known after a round is again an edge table. The driver
    sees two numbers a round. Loops and repeated edges are allowed.
    """
    now = stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if not state["n"] or (state["n"], state["s"]) == before:
            break
        before = (state["n"], state["s"])
        # a node's larger neighbours go to its smallest one; written first, so that a node with very many
        # of them meets a plain table and Spark can split the join
        least = stored(now.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")))
        large = now.join(least, F.col("b") == F.col("u"), "left").select("a", F.coalesce("m", "b").alias("b")).distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(small_least, F.col("a") == F.col("u"))
        now = stored(
            small.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a <> b")
            .unionByName(small_least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        )
    found = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
