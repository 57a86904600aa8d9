"""Connected components of an edge table, by stars that grow and shrink in turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import shared_dir


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Tie the neighbours of every node to the smallest of them."""
    pairs = edges.select("u", "v")
    if both_ways:
        pairs = pairs.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select(F.col("u").alias("at"), F.least("u", "least").alias("least"))
    met = pairs.join(least, pairs["u"] == least["at"])
    if both_ways:
        return met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
    others = met.where(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = least.where(F.col("at") != F.col("least")).select(F.col("at").alias("u"), F.col("least").alias("v"))
    return others.unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (u, v), roots included; the root is the smallest node.

    A node with very many neighbours costs no single task: the smallest neighbour is an aggregate, and
    the join back can be split. Every round is checkpointed; rounds end when the edges stay the same.
    """
    shared_dir(edges.sparkSession)
    now = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if seen == state:
            break
        state = seen
        if not seen["n"]:
            break
        now = _star(_star(now, True), False).checkpoint()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
