"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup
from tidemark.session import cut_lineage

#: Edges that a task looks at together.
CHUNK_EDGES = 200_000


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges to the smallest node of each component within a chunk, in place of its edges."""

    def stars(edges: list[tuple[int, int]]) -> pa.RecordBatch:
        up: dict[int, int] = {}

        def root(node: int) -> int:
            while (above := up.setdefault(node, node)) != node:
                up[node] = node = up[above]
            return node

        for a, b in edges:
            x, y = root(a), root(b)
            if x != y:
                up[max(x, y)] = min(x, y)
        found = [(node, top) for node in list(up) if (top := root(node)) != node]
        columns = zip(*found, strict=True) if found else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    held: list[tuple[int, int]] = []
    for batch in batches:
        held += zip(*(column.to_pylist() for column in batch.columns), strict=True)
        if len(held) >= CHUNK_EDGES:
            yield stars(held)
            held = []
    yield stars(held)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes of ``edges (a, b)``, long, that have a neighbour.

    The component is its smallest node. Each round first turns what lies in one chunk, of edges
    that are near by number, into stars; then every node moves to its smallest neighbour's
    smallest neighbour, and the edges between different places stay. A chain along the numbers
    shrinks to its chunks in one round, and any other to a quarter. A node of very many neighbours
    is reduced before each shuffle, and split in the joins.
    """
    edges = edges.select("a", "b").where("a <> b")
    rounds = []
    while True:
        edges = cut_lineage(
            edges.repartitionByRange("a").sortWithinPartitions("a", "b").mapInArrow(_stars, "a long, b long")
        )
        if edges.isEmpty():
            break
        ends = edges.toDF("node", "other").union(edges.select("b", "a"))
        near = cut_lineage(ends.groupBy("node").agg(F.least("node", F.min("other")).alias("up")))
        hook = lookup(near, near.toDF("__of", "__top"), "up", "__of").select(
            "node", F.col("__top").alias("up")
        )
        rounds.append(hook)
        moved = lookup(edges, hook.toDF("__x", "x"), "a", "__x", "inner")
        moved = lookup(moved, hook.toDF("__y", "y"), "b", "__y", "inner")
        edges = moved.where("x <> y").selectExpr("greatest(x, y) AS a", "least(x, y) AS b")
    if not rounds:
        return edges.toDF("node", "component")
    found = rounds[0].toDF("node", "component")
    for hook in rounds[1:]:
        later = hook.toDF("__node", "__up")
        found = lookup(found, later, "component", "__node").select(
            "node", F.coalesce("__up", "component").alias("component")
        )
    return found
