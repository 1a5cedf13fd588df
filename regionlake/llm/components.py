"""Connected components of an edge table by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from regionlake.llm.base import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge; the component is its smallest node.

    Each round hangs the larger neighbours of a node, then the node itself, on the smallest
    neighbour, until every edge points at its component's smallest node. Rounds grow with the logarithm
    of the longest chain. Minima are pre-aggregated before each shuffle and the join back to
    the edges can split a hot node. Null ends and loops are left out; an empty table gives an empty one.
    """
    pairs = stored(
        edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges"
    )
    if pairs.isEmpty():
        return pairs.select(F.col("v").alias("node"), F.col("u").alias("component"))
    while True:
        both = pairs.union(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("low")).withColumn("low", F.least("v", "low"))
        large = both.join(least, "v").where(F.col("u") > F.col("v")).select(F.col("u").alias("v"), F.col("low").alias("u"))
        large = stored(large.distinct(), "large-star")
        least = large.groupBy("v").agg(F.min("u").alias("low"))
        small = large.join(least, "v")
        small = small.select("v", "low").union(small.select(F.col("u").alias("v"), "low")).where(F.col("v") != F.col("low"))
        pairs = stored(small.distinct().withColumnRenamed("low", "u"), "small-star")
        if _settled(pairs):
            return pairs.select(F.col("v").alias("node"), F.col("u").alias("component"))


def _settled(pairs: DataFrame) -> bool:
    """Every node has one parent, and no parent has one."""
    if not pairs.groupBy("v").count().where("count > 1").isEmpty():
        return False
    return pairs.join(pairs.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()
