"""Connected components of an edge table, by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicewatch.llm.shared import materialise


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """``node``, ``label`` for every node of ``edges`` (long columns ``a`` and ``b``).

    Nodes share a label exactly when a path joins them. Each round every node moves to the
    node of its closed neighbourhood with the least hash of that round, and the edges are
    rewritten to where their ends went. A round leaves an expected constant fraction of the
    nodes, whatever the shape of the graph, so chains and stars both end after about log(n)
    rounds. Neighbours meet in a minimum only, which is reduced before its shuffle.
    """
    edges = materialise(_simple(edges.select("a", "b")), purpose)
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        rank = lambda c, n=len(moves): F.struct(
            F.xxhash64(F.lit(n), F.col(c)), F.col(c).alias("node"))
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min(rank("b")).alias("least"))
        move = least.select(
            F.col("a").alias("node"), F.least("least", rank("a"))["node"].alias("label"))
        move = materialise(move, purpose)
        moves.append(move)
        at_a = move.select(F.col("node").alias("a"), F.col("label").alias("to_a"))
        at_b = move.select(F.col("node").alias("b"), F.col("label").alias("to_b"))
        moved = edges.join(at_a, "a").join(at_b, "b")
        edges = materialise(
            _simple(moved.select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))), purpose)
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    found = moves[0]
    for move in moves[1:]:
        further = move.select(F.col("node").alias("label"), F.col("label").alias("next"))
        found = found.join(further, "label", "left").select(
            "node", F.coalesce("next", "label").alias("label"))
    return found


def _simple(edges: DataFrame) -> DataFrame:
    """Each edge once, smaller end first, without loops."""
    return (edges.where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
