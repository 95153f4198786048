"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b: bigint, not null);
    the component is its smallest node. Nodes without links don't appear.

    Each step joins edges with one minimum per node, so a hub is a skewed
    join, which the optimizer splits, and never one task's group. Steps end
    when the edges no longer change; their number is logarithmic."""
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if tuple(state) == before or not state.n:
            break
        before = tuple(state)
        # Large star: neighbours above a node are linked to the least of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(large.distinct(), "large-star")
        # Small star: a node and its neighbours below are linked to the least of them.
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        below = edges.join(least, "u")
        small = below.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        edges = written(small.distinct(), "small-star")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component")))
