"""Connected components by distributed union-find over narrow links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.session import cut_lineage


def _to_least(links: DataFrame) -> DataFrame:
    """``a, least``: the least node among a node and its neighbours.

    Written, so that both sides of the join that follows come straight from an exchange and
    adaptive execution can split a node with very many links.
    """
    return cut_lineage(links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root``: the least node that each linked node reaches.

    Links are undirected pairs of numbers; nulls and loops are ignored, repeats do no harm. Nodes
    without a link to another are not listed; no links give no rows. Each round first points every
    larger neighbour to the least node around, then every node's smaller neighbours and itself; the
    trees flatten in a logarithmic number of rounds. What a round leaves is written, so a lost
    executor costs one round.
    """
    edges = links.select(F.greatest(a, b).cast("bigint").alias("a"), F.least(a, b).cast("bigint").alias("b"))
    edges = cut_lineage(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") > F.col("b"))).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.where("b > a").join(_to_least(both), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = cut_lineage(large.distinct())
        least = _to_least(edges)
        small = edges.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = cut_lineage(small.union(least.select("a", F.col("least").alias("b"))).where("a != b").distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
