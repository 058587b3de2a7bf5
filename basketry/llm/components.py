"""Connected components by contraction, on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import discard, stored


def components(edges: DataFrame, left: str = "u", right: str = "v") -> DataFrame:
    """node, component (its smallest node) for every node of the undirected ``edges`` of longs; null ends are dropped.

    Every round each node moves to the neighbour (or itself) that comes first by a hash of node and round, and edges
    follow; a round leaves a fixed share of the nodes at most, whatever the shape. Only the count of edges reaches
    the driver. Minima are combined in each task first, and the tables that joins meet are stored, so Spark splits the
    rows of a node with very many neighbours.
    """
    ends = edges.select(F.col(left).cast("long").alias("u"), F.col(right).cast("long").alias("v")).dropna()
    current = stored(ends.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    nodes = ends.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    moves, turn = [], 0
    while not current.isEmpty():
        both = current.union(current.select("v", "u"))
        order = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("to"))  # noqa: E731, B023
        move = stored(
            both.groupBy("u").agg(F.min(order("v")).alias("best")).select(
                F.col("u").alias("at"), F.least("best", order("u"))["to"].alias("to")), "moves")
        moves.append(move)
        first = move.select(F.col("at").alias("u"), F.col("to").alias("a"))
        second = move.select(F.col("at").alias("v"), F.col("to").alias("b"))
        before, current = current, stored(
            current.join(first, "u").join(second, "v").where("a <> b")
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
        discard(before)
        turn += 1
    labels = nodes.select("node", F.col("node").alias("label"))
    for move in moves:
        labels = labels.join(move, F.col("label") == F.col("at"), "left").select(
            "node", F.coalesce("to", "label").alias("label"))
    labels = stored(labels, "labels")
    discard(current, *moves)
    smallest = stored(labels.groupBy("label").agg(F.min("node").alias("component")), "smallest")
    return labels.join(smallest, "label").select("node", "component")
