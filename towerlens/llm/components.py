"""Connected components of a link table, by alternating star contractions (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from towerlens.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = links.union(links.select("b", "a"))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to its smallest neighbour."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(low, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b; a != b): the root is the smallest node reachable.

    Each round is written to the shared folder, so lineage stays short; the
    number of rounds grows with the logarithm of the largest component.
    """
    now = written(links.select("a", "b").distinct(), f"{name}-links")
    state = _state(now)
    while True:
        now = written(_small_star(_large_star(now)), f"{name}-stars")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
