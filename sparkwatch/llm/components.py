"""Connected components of an edge table by contraction in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a and b, one type); nodes of one component share their root.

    In each round every node moves to the neighbour (itself included) that comes first in an order hashed anew, and edges
    are rewritten to the nodes moved to. In a fresh random order a constant share of the nodes goes per round, whatever the
    shape, and what remains of a hub is one row per neighbour, summed up before the shuffle. Null ends are ignored.
    """
    edges = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = edges.union(edges.select(F.col("b"), F.col("a"))).distinct()
    live = checkpointed(both)
    moves: list[DataFrame] = []
    turn = 0
    while not live.isEmpty():
        ranked = F.struct(F.xxhash64(F.col("b"), F.lit(turn)).alias("h"), F.col("b").alias("n"))
        own = F.struct(F.xxhash64(F.col("a"), F.lit(turn)).alias("h"), F.col("a").alias("n"))
        step = checkpointed(live.groupBy("a").agg(F.least(F.min(ranked), F.first(own)).getField("n").alias("to")))
        moves.append(step)
        left = live.join(step, "a").select(F.col("to").alias("a"), "b")
        right = left.join(step.select(F.col("a").alias("b"), F.col("to").alias("to_b")), "b")
        live = checkpointed(right.filter("a <> to_b").select("a", F.col("to_b").alias("b")).distinct())
        turn += 1
    if not moves:
        return both.select(F.col("a").alias("node"), F.col("a").alias("root"))
    # a node may stand still for rounds; the last table in which its present name appears decides
    roots = moves[-1].select(F.col("a").alias("at"), F.col("to").alias("root"))
    for step in reversed(moves[:-1]):
        named = step.join(roots, step["to"] == roots["at"], "left")
        roots = checkpointed(named.select(F.col("a").alias("at"), F.coalesce("root", "to").alias("root")))
    return roots.select(F.col("at").alias("node"), "root")
