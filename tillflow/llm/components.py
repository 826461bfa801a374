"""Connected components of a graph given as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored


def _settled(edges: DataFrame) -> bool:
    """Is every larger node tied to one smaller node only, which itself is tied to none?"""
    several = edges.groupBy("u").count().where("count > 1")
    chained = edges.join(edges.select(F.col("v").alias("end")), F.col("u") == F.col("end"), "left_semi")
    return several.isEmpty() and chained.isEmpty()


def labelled(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, label`` of every node in ``links`` (columns ``a, b``): its component's least node.

    Alternates two steps on directed links from larger to smaller nodes: each node's larger
    neighbours are tied to its least neighbour, then its smaller ones. A component ends as a star
    around its least node. The least neighbour comes from a partial aggregation, so a node with
    very many links is no single task's work, and the joins meet stored tables, whose frequent
    keys Spark splits.
    """
    directed = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(directed.distinct(), "links")
    for _ in range(most_rounds):
        if _settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "least")
        least = least.withColumn("m", F.least("m", "w"))
        # Larger neighbours of each node go to the node's least neighbour.
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        large = stored(large.where("u <> v").distinct(), "large-star")
        least = stored(large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "least")
        joined = large.join(least, F.col("u") == F.col("w"))
        tied = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select(F.col("w").alias("u"), F.col("m").alias("v"))
        edges = stored(tied.unionByName(own).where("u <> v").distinct(), "small-star")
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
