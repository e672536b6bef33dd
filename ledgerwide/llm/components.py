"""Connected components of an edge table, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwide.llm.tables import discard, stored


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node reachable.

    Each turn hooks every node to its smallest smaller neighbour, which makes a forest, and
    halves the forest's paths until each node points to its root. Edges are then moved to
    the roots, and those inside one tree go. Turns and halvings both take about log n steps.
    Nulls in ``edges`` and self loops count for nothing. Hooking is an aggregate with map-side
    combine, so a node with very many neighbours is no load on one task.
    """
    edges = stored(
        spark,
        edges.where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    roots = stored(spark, nodes.select("node", F.col("node").alias("root")), "roots")
    while not edges.isEmpty():
        earlier = [edges, roots]
        hooks = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        forest = stored(spark, hooks, "forest")
        while True:
            above = forest.select(F.col("node").alias("up"), F.col("up").alias("next"))
            raised = stored(
                spark,
                forest.join(above, "up", "left").select(
                    "node", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")
                ),
                "forest",
            )
            earlier += [forest] if hasattr(forest, "scratch") else []
            forest = raised.select("node", "up")
            earlier.append(raised)
            if raised.where("moved").isEmpty():
                break
        roots = stored(spark, moved(roots, "root", forest), "roots")
        edges = moved(moved(edges, "a", forest), "b", forest).where("a <> b")
        edges = stored(spark, edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        discard(spark, *earlier)
    discard(spark, edges)
    return roots


def moved(frame: DataFrame, column: str, forest: DataFrame) -> DataFrame:
    """``frame`` with the nodes in ``column`` replaced by what they hang from, if anything."""
    to = forest.select(F.col("node").alias(column), F.col("up").alias("_up"))
    rest = [c for c in frame.columns if c != column]
    return frame.join(to, column, "left").select(*rest, F.coalesce("_up", column).alias(column))
