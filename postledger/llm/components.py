"""Connected components of a graph given as edges between numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postledger.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """The component of every node that has an edge: (node, root), for edges (a, b).

    Each round every node moves to that neighbour, or itself, which comes first in an order
    drawn anew for the round; edges follow, and those that end in one node go. A fixed share
    of the nodes goes each round, whatever the shape of the graph. Rounds are written to the
    shared folder. Nodes that very many edges share are met by partial aggregates and by joins
    that can be split.
    """
    edges = written(edges.filter("a <> b").select("a", "b"), "edges")
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        order = F.xxhash64("to", F.lit(len(moves)))
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("to")).union(edges.select("b", "a"))
        with_self = both.union(both.select("node", F.col("node").alias("to")).distinct())
        first = with_self.groupBy("node").agg(F.min(F.struct(order.alias("order"), "to")).alias("first"))
        move = written(first.select("node", F.col("first.to").alias("to")), "moves")
        moves.append(move)
        at_a = move.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        at_b = move.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        ends = edges.join(at_a, "a").join(at_b, "b").filter("to_a <> to_b")
        edges = written(ends.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))

    def follow(known: DataFrame, move: DataFrame) -> DataFrame:
        onward = move.select(F.col("node").alias("root"), F.col("to").alias("next"))
        return known.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))

    return reduce(follow, moves[1:], moves[0].select("node", F.col("to").alias("root")))
