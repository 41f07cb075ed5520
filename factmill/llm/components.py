"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factmill.llm.common import materialize


def _toward_minimum(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Each neighbour v of u is linked to the least node of u's neighbourhood (u included)."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    moved = pairs.join(least, "u")
    if larger_only:
        return moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(own)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges``: (a, b) of any orderable type, undirected. Returns (node, component) of nodes with an edge to another.

    ``component`` is the least node that can be reached. Nulls, self-links and repeated links are ignored; without
    links the result is empty. Every round is written to the shared folder, so lineage stays short. The rounds join on
    nodes; a node with very many links is split by adaptive execution, and minima are combined before the shuffle.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialize(links, "links")
    state = None
    for _ in range(max_rounds):
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _toward_minimum(both, larger_only=True).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        links = materialize(_toward_minimum(down, larger_only=False).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
