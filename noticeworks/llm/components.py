"""Connected components by alternating large and small stars, with the edges written to the shared folder each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.mixing import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b): root is the smallest node that it reaches, itself included.

    A node with very many edges is pre-aggregated for its minimum and split by adaptive execution in the joins. Edges of
    a node to itself are ignored. No edges give no rows.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before, links = None, written(links, "edges")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
