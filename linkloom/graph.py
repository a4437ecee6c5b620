"""Connected components by contraction, as joins and sums over tables that the driver never sees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.storage import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of the edges (a, b) reaches.

    Each round gives all nodes an order of its own, by a hash, and moves every node to the first of those at most two edges
    away; edges move along with their ends. So a star goes in one round, and as the order is another one each time, a good
    part of the nodes goes in each round whatever the graph's form (long sorted chains too): rounds grow with the logarithm
    of their number. Moves are put together once, from the last round, which has the fewest nodes, to the first.

    Nulls and loops are ignored, repeated edges count once, no edges give no rows.
    """
    pair = F.array_sort(F.array("a", "b"))
    tidy = lambda e: e.where("a <> b").select(pair[0].alias("a"), pair[1].alias("b")).distinct()
    left = materialize(tidy(edges.select("a", "b")), "edges")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        place = lambda c: F.struct(F.xxhash64(F.lit(len(rounds) + 1), c).alias("at"), F.col(c).alias("node"))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min(place("b")).alias("m")).select("node", F.least(place("node"), "m").alias("first")), "near")
        # a node is among those near its neighbours, and so are these themselves
        moves = materialize(both.join(near, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("first")["node"].alias("root")), "moves")
        to = lambda side: moves.select(F.col("node").alias(side), F.col("root").alias(f"to_{side}"))  # noqa: E731, B023
        moved = left.join(to("a"), "a").join(to("b"), "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        before, left = left, materialize(tidy(moved), "edges")
        discard(before, near)
        rounds.append(moves)
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = rounds[-1]
    for moves in reversed(rounds[:-1]):
        further = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        labels = moves.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    if len(rounds) > 1:
        labels = materialize(labels, "labels")
        discard(*rounds)
    least = materialize(labels.groupBy("root").agg(F.min("node").alias("least")), "least")  # written, so that a join with a large component can be split
    return labels.join(least, "root").select("node", F.col("least").alias("root"))
