"""Approximate nearest neighbours by cosine: a vantage-point tree for each shard of vectors.

Unit vectors are as near by angle as by distance, so the triangle inequality holds. A tree's
node parts its vectors by their distance from a vantage point; a query passes over a side
if ``factor * (its distance from the border)`` exceeds the distance of its worst neighbour so
far. Factor one skips only what cannot be nearer; a larger one skips more and may miss some.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import map_arrow, written

#: Pruning factor of the registered query.
FACTOR = 1.5
LEAF = 128
#: Vectors of a shard, and queries that search it in one task, on average.
SHARD = 20_000
QUERY_BLOCK = 4_000


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, float64 rows) of the vectors that are finite and not zero, by length."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    for width in np.unique(sizes[sizes > 0]).tolist():
        keep = np.flatnonzero(sizes == width)
        flat = column.take(pa.array(keep)).flatten().cast(pa.float64())
        rows = flat.to_numpy(zero_copy_only=False).reshape(-1, width)
        good = np.isfinite(rows).all(axis=1) & (rows != 0).any(axis=1)
        yield keep[good], rows[good]


def unit(rows: np.ndarray) -> np.ndarray:
    top = np.abs(rows).max(axis=1, keepdims=True, initial=1e-300)
    rows = rows / top
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def distinct(k: int):
    """Of equal vectors in a task, the ``k`` rows of the smallest ids: no more can be found."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, list[int]] = {}
        for batch in batches:
            for at, rows in matrices(batch[1]):
                ids = batch[0].to_numpy()[at]
                for own, row in zip(ids.tolist(), rows, strict=True):
                    held = kept.setdefault((row + 0.0).tobytes(), [])
                    held.append(own)
                    if len(held) > k:
                        held.remove(max(held))
        names = ["ids", "data"]
        step = 5000
        items = list(kept.items())
        for start in range(0, len(items), step):
            part = items[start : start + step]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for _, i in part], pa.list_(pa.int64())),
                    pa.array([d for d, _ in part], pa.binary()),
                ],
                names=names,
            )

    return work


class Tree:
    """Vantage-point tree over the rows of a unit matrix."""

    def __init__(self, rows: np.ndarray, leaf: int = LEAF):
        self.rows, self.leaf = rows, leaf
        self.root = self.build(np.arange(len(rows)), 0)

    def build(self, own: np.ndarray, depth: int):
        if len(own) <= self.leaf:
            return own
        first = self.rows[own[(depth * 7919) % len(own)]]
        # The farthest from a row lies at the rim, where borders cut through fewest others.
        point = own[int(np.argmin(self.rows[own] @ first))]
        far = apart(self.rows[own] @ self.rows[point])
        border = float(np.median(far))
        inner = far <= border
        if inner.all():
            inner = far < border
            if not inner.any():
                return own
        return point, border, self.build(own[inner], depth + 1), self.build(own[~inner], depth + 1)

    def search(self, queries: np.ndarray, k: int, factor: float):
        """(distances, rows) of ``k`` found neighbours of each query, nearest first."""
        best = np.full((len(queries), k), np.inf)
        found = np.full((len(queries), k), -1, np.int64)
        # First to the leaf each query lies in, for a near bound; then through the tree.
        for descend in (True, False):
            pending = [(self.root, np.arange(len(queries)))]
            while pending:
                node, who = pending.pop()
                if not len(who):
                    continue
                if not isinstance(node, tuple):
                    if len(node):
                        self.leaf_search(queries, node, who, best, found)
                    continue
                point, border, inner, outer = node
                gap = apart(queries[who] @ self.rows[point]) - border
                if descend:
                    pending += [(inner, who[gap <= 0]), (outer, who[gap > 0])]
                else:
                    worst = best[who, -1] + 1e-9
                    pending += [(inner, who[factor * gap <= worst]), (outer, who[-factor * gap <= worst])]
        return best, found

    def leaf_search(self, queries, node, who, best, found) -> None:
        far = apart(queries[who] @ self.rows[node].T)
        k = best.shape[1]
        # A leaf met twice brings its rows again: they are left out by number.
        again = (node[None, :, None] == found[who][:, None, :]).any(axis=2)
        far[again] = np.inf
        far = np.concatenate([best[who], far], axis=1)
        rows = np.concatenate([found[who], np.broadcast_to(node, (len(who), len(node)))], axis=1)
        order = np.argpartition(far, k - 1, axis=1)[:, :k]
        far, rows = np.take_along_axis(far, order, 1), np.take_along_axis(rows, order, 1)
        order = np.argsort(far, axis=1, kind="stable")
        best[who], found[who] = np.take_along_axis(far, order, 1), np.take_along_axis(rows, order, 1)


def apart(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * cosine))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row with each row, the same for equal rows wherever they stand."""
    return np.einsum("ij,ij->i", a, b, optimize=False) / (
        np.sqrt(np.einsum("ij,ij->i", a, a, optimize=False))
        * np.sqrt(np.einsum("ij,ij->i", b, b, optimize=False))
    )


FOUND = "query_id long, vec_id long, score double"


def searcher(k: int, factor: float):
    def work(key: tuple, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )
        out = []
        width = own["data"].map(len)
        asked_width = asked["data"].map(len)
        for size in width.unique():
            held = own[width == size].groupby("data")["ids"].agg(lambda x: sorted(np.concatenate(list(x)))[: k + 1])
            queries = asked[asked_width == size]
            if queries.empty:
                continue
            rows = np.frombuffer(b"".join(held.index), np.float64).reshape(len(held), -1)
            points = np.frombuffer(b"".join(queries["data"]), np.float64).reshape(len(queries), -1)
            _, found = Tree(unit(rows)).search(unit(points), min(k + 1, len(held)), factor)
            ask, near = np.nonzero(found >= 0)
            near = found[ask, near]
            score = cosines(points[ask], rows[near])
            ids = held.to_numpy()[near]
            part = pd.DataFrame({"query_id": queries["query_id"].to_numpy()[ask], "vec_id": ids, "score": score})
            part = part.explode("vec_id").astype({"vec_id": "int64"})
            part = part[part["query_id"] != part["vec_id"]]
            part = part.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
            out.append(part.groupby("query_id").head(k))
        return pd.concat(out) if out else empty

    return work


def nearest(
    vectors: DataFrame,
    k: int = 5,
    factor: float = FACTOR,
    every: int = 50,
    shard: int = SHARD,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: ``k`` found neighbours by cosine of each query.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates all other rows.
    Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor
    do null ids. Ties go to the smaller id. Vectors of different lengths are never compared.
    Equal vectors are one point of a tree with its ``k + 1`` smallest ids, which is exact.
    Queries search each shard in blocks. Other columns are ignored. No rows in, none out.
    """
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    source = source.where("vec_id is not null and size(v) > 0 and not exists(v, x -> x is null)")
    source = source.withColumn("v", F.col("v").cast("array<double>"))
    held = written(map_arrow(source.select("vec_id", "v"), distinct(k + 1), "ids array<long>, data binary"), "vectors")
    asked = source.where(F.col("vec_id") % every == 0)
    asked = written(map_arrow(asked.select("vec_id", "v"), whole, "query_id long, data binary"), "queries")
    shards = max(1, held.count() // shard)
    blocks = max(1, asked.count() // query_block)
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    own = held.select(
        F.pmod(F.xxhash64("data"), F.lit(shards)).cast("int").alias("shard"),
        every_block.alias("block"), "ids", "data",
    )
    queries = asked.select(
        every_shard.alias("shard"),
        F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), "query_id", "data",
    )
    found = own.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block"))
    found = found.applyInPandas(searcher(k, factor), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The usable vectors of a task as bytes."""
    for batch in batches:
        for at, rows in matrices(batch[1]):
            data = [(x + 0.0).tobytes() for x in rows]
            ids = pa.array(batch[0].to_numpy()[at])
            yield pa.RecordBatch.from_arrays([ids, pa.array(data, pa.binary())], names=["query_id", "data"])
