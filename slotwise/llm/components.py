"""Connected components by alternating stars, as joins and grouped minima.

Edges always point from a larger id to a smaller one.  A large-star step hooks every larger
neighbour of a node to the node's smallest neighbour; a small-star step hooks the smaller
neighbours (and the node) to the smallest one.  Stars grow until the edges no longer change, which
takes a number of rounds logarithmic in the longest path.  A hub with a third of all edges is only
ever a key of a partial aggregation or of a join against a stored table, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stored


def _directed(edges: DataFrame) -> DataFrame:
    return (edges.where("src <> dst")
            .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())


def _hook(pairs: DataFrame, larger_only: bool, name: str) -> DataFrame:
    """pairs (u, v): neighbours of u; returns the edges that one star step makes."""
    least = stored(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-least")
    kept = pairs.where("v > u") if larger_only else pairs
    edges = kept.join(least, "u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
    if not larger_only:
        edges = edges.unionByName(least.select(F.col("u").alias("src"), F.col("m").alias("dst")))
    return edges


def components(edges: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """(id, component) for every id of ``edges`` (src, dst; longs): component is its smallest id."""
    now = stored(_directed(edges), f"{name}-edges")
    mark = None
    for _ in range(most_rounds):
        both = now.select(F.col("src").alias("u"), F.col("dst").alias("v")).unionByName(
            now.select(F.col("dst").alias("u"), F.col("src").alias("v")))
        large = stored(_directed(_hook(both, True, name)), f"{name}-large")
        now = stored(_directed(_hook(large.select(F.col("src").alias("u"), F.col("dst").alias("v")), False, name)),
                     f"{name}-small")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    roots = now.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct()
    return now.select(F.col("src").alias("id"), F.col("dst").alias("component")).unionByName(roots)
