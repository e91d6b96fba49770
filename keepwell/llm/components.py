"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.staging import inner_tables, stage


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of the links; root is the smallest node of its component.

    Each round replaces edges by edges to smaller neighbours, first towards larger nodes, then
    towards smaller ones, and stages the result; minima are combined before they are shuffled,
    so a node with very many neighbours costs one row per task. Ends when all edges point at roots. The
    result is staged; the edges of the rounds are deleted.
    """
    spark = links.sparkSession
    with inner_tables(spark):
        edges = stage(
            links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges"
        )
        seen = None
        while True:
            with inner_tables(spark):
                edges = stage(_contracted(edges), "edges", kept=True)
            # a digest of the edges: equal in two rounds when nothing changes any more
            now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
            if now == seen:
                break
            seen = now
        roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        own = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
        return stage(roots.unionByName(own), "roots", kept=True)


def _contracted(edges: DataFrame) -> DataFrame:
    """The edges after a step towards larger nodes and one towards smaller ones."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter("u <> v").distinct()
    )
    large = stage(large, "edges")
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    pairs = F.array(
        F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v"))
    )
    return large.join(low, "u").select(F.explode(pairs).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
