"""Connected components of a graph given by its edges, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import settled


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for each node of the edges ``a, b``; a component is named by its smallest node.

    Alternates two steps until nothing changes. First, each node sends its larger
    neighbours to the smallest node it knows; then its smaller ones. Both keep the
    components and turn each into a star around its smallest node, in a number of rounds
    that grows with the logarithm of the nodes. Each round is written to the checkpoint
    folder; nothing but a row count and a sum comes to the driver.
    """
    current = settled(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    )
    before = _state(current)
    while True:
        current = settled(_small_star(_large_star(current)))
        after = _state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    # Two 64-bit checksums of the set of edges beside its size.
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("a", "b")).alias("x"),
        F.bit_xor(F.xxhash64("b", "a", F.lit(1))).alias("y"),
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours, linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, linked to the smallest of them; ``a > b`` holds on both sides."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return others.unionByName(own).distinct()
