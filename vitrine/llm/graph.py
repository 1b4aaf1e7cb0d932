"""Connected components of a distributed edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import written


def _state(edges: DataFrame):
    return edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a, b), b the smaller -> (node, root): every node of an edge but the roots, with its component's smallest node.

    Each round joins the edges with one minimum per node, so a hub is a skewed
    key of a join (which Spark can split), never a group in one task.  Rounds
    grow with the logarithm of the longest chain; each is written to the shared
    folder, and the driver sees only a count and a checksum.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(edges)
    while before.n:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        # each larger neighbour of a node is tied to the smallest of its neighbourhood
        large = edges.join(least, edges["b"] == least["u"]).select("a", F.col("m").alias("b")).distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        # each smaller neighbour of a node, and the node itself, too
        small = (large.join(low, large["a"] == low["u"])
                 .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.*").where("a <> b").distinct())
        edges = written(small, "edges")
        after = _state(edges)
        if (after.n, after.h) == (before.n, before.h):
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
