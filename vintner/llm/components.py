"""Connected components of a graph of 64-bit nodes, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintner.llm.shared import stored

MAX_ROUNDS = 100


def _star(edges: DataFrame) -> DataFrame:
    """Hang the neighbours in ``v`` of every ``u`` on the smallest node among them and ``u``."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    # Two stored sides: a node with very many neighbours is a skewed partition that can be split.
    return edges.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that is not the smallest of its component; ``edges`` has longs a and b.

    Large stars (neighbours above a node move to its smallest one) and small stars (neighbours below
    it do) alternate until nothing changes: O(log n) rounds in practice. Every round is a table in
    the shared folder. No edges give no rows; loops and repeated edges change nothing.
    """
    present = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = None
    for _ in range(MAX_ROUNDS):
        new = present.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if new == state or not new["n"]:
            return present.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new
        both = present.unionByName(present.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = stored(large.distinct(), "large-star")
        small = _star(large)
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        present = stored(moved.filter("u <> v").distinct(), "small-star")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
