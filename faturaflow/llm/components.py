"""Connected components by contraction, on Spark joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faturaflow.llm.common import checkpointed
from faturaflow.operators.joins import lookup_join


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a long, b long); root is some node of its component.

    In each round every node moves to the smallest of itself and its neighbours, in an
    order drawn anew from a hash, and links between moved nodes remain. A constant share of
    the nodes goes in each round, so rounds grow with the logarithm of the longest chain.
    Aggregates reduce a hub to a row per task, and joins have their own exchanges on
    both sides, where adaptive execution splits a hub. Nothing but counts reaches the driver.
    """
    edges = checkpointed(links.filter("a <> b").distinct())
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        salt = F.lit(len(moves))
        both = edges.union(edges.select("b", "a"))
        order = F.struct(F.xxhash64(salt, "b"), F.col("b"))
        own = F.struct(F.xxhash64(salt, "a"), F.col("a").alias("b"))
        nearest = F.least(F.min(order), F.first(own))
        move = checkpointed(both.groupBy("a").agg(nearest["b"].alias("to")))
        moves.append(move)
        one = lookup_join(edges, move, ["a"], "inner").select("b", F.col("to").alias("c"))
        two = lookup_join(one, move.select(F.col("a").alias("b"), "to"), ["b"], "inner")
        edges = checkpointed(
            two.filter("c <> to")
            .select(F.least("c", "to").alias("a"), F.greatest("c", "to").alias("b"))
            .distinct()
        )
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    # A node that has no link left after a round is a root; later rounds move earlier roots.
    found = moves[-1].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for move in reversed(moves[:-1]):
        step = move.select(F.col("a").alias("first"), F.col("to").alias("node"))
        step = lookup_join(step, found, ["node"], "left")
        found = step.select(
            F.col("first").alias("node"), F.coalesce("root", "node").alias("root")
        )
    return found
