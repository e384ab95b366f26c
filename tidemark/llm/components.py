"""Connected components of an edge table, by hooking to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import written


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; a component is its smallest node.

    Each round hooks every node to its smallest neighbour, follows two hooks, and keeps only
    the edges between different ends, so the number of rounds is logarithmic in practice.
    Loops and repeated edges change nothing; null ends are left out; no edges, no rows.
    """
    edges = written(
        edges.select("a", "b").where("a is not null and b is not null").distinct(), "edges"
    )
    labels = edges.selectExpr("a as node").union(edges.selectExpr("b as node")).distinct()
    labels = labels.select("node", F.col("node").alias("component"))
    edges = edges.where("a != b")
    while not edges.isEmpty():
        ends = edges.union(edges.selectExpr("b as a", "a as b"))
        hook = ends.groupBy("a").agg(F.least("a", F.min("b")).alias("up"))
        for _ in range(2):
            above = hook.select(F.col("a").alias("up"), F.col("up").alias("top"))
            hook = hook.join(above, "up", "left").select(
                "a", F.coalesce("top", "up").alias("up")
            )
        hook = written(hook, "hooks")
        labels = written(
            labels.join(hook.withColumnRenamed("a", "component"), "component", "left").select(
                "node", F.coalesce("up", "component").alias("component")
            ),
            "labels",
        )
        left = hook.select("a", F.col("up").alias("x"))
        right = hook.select(F.col("a").alias("b"), F.col("up").alias("y"))
        edges = written(
            edges.join(left, "a")
            .join(right, "b")
            .where("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "edges",
        )
    return labels
