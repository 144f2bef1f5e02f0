"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrella.session import materialize, materialize_counted


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge list (a, b); a component is named by its smallest node.

    Each step links nodes to the smallest node in their neighbourhood: the large star moves larger
    neighbours of a node to the smallest neighbour, the small star does it for smaller ones. Stars
    stay, longer paths shrink to about half, so a few steps suffice. Minima are pre-aggregated, no
    neighbourhood is gathered, and each step's edges are written once, so lost executors cost one
    step. NULL ends and loops are ignored; no edges give no rows.
    """
    pairs = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    current, rows = materialize_counted(
        pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    signature = None
    while rows:
        # large star: every larger neighbour of a node is linked to the node's smallest neighbour
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that the join below starts from plain shuffles and a hub can be split
        lowest = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = (
            current.select(F.col("b").alias("a"), F.col("a").alias("b"))  # b is the larger end
            .join(lowest, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        large = materialize(large)
        # small star: a node's smaller neighbours and the node itself are linked to the smallest of them
        smallest = materialize(large.groupBy("a").agg(F.min("b").alias("m")))
        small = (
            large.join(smallest, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), "m"), F.struct("a", "m"))).alias("e"))
            .select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        current, rows = materialize_counted(small)
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == signature:
            break
        signature = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).distinct()
