"""Connected components of an undirected graph by repeated contraction; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.store import kept


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); the component is its smallest node.

    Each round every node moves to the neighbour (or itself) that ranks first in a random order of the round, and edges
    are redrawn between where their ends have moved. Expected rounds are logarithmic in the nodes, on chains too. The
    table of a round is written to the shared folder, so lost executors cost a round at most. No edges, no rows.
    """
    edges = kept(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = kept(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    turn = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("rank"), F.col(c).alias("node"))
        best = both.groupBy("a").agg(F.min(order("b")).alias("best"))
        moves = best.select("a", F.least(F.col("best"), order("a"))["node"].alias("to"))
        moves = kept(moves.filter("a <> to"), "moves")
        first = moves.select("a", F.col("to").alias("new_a"))
        second = moves.select(F.col("a").alias("b"), F.col("to").alias("new_b"))
        redrawn = edges.join(first, "a", "left").join(second, "b", "left")
        redrawn = redrawn.select(F.coalesce("new_a", "a").alias("a"), F.coalesce("new_b", "b").alias("b")).filter("a <> b")
        redrawn = redrawn.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = kept(redrawn, "edges")
        labels = labels.join(moves.select(F.col("a").alias("label"), "to"), "label", "left")
        labels = labels.select("node", F.coalesce("to", "label").alias("label"))
        turn += 1
    smallest = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(smallest, "label").select("node", "component")
