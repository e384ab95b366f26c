"""Best-fit packing of token pieces into sequences: greedy filling, then one-for-two exchange.

A bin is filled with the largest piece that fits, again and again. If a gap is left, the
bin's smallest piece is taken out, and the two unpacked pieces that fill the larger gap most
tightly take its place, if that leaves less room. Only lengths matter, so a shard of pieces
is packed from its histogram of lengths. Shards are dealt by a hash of the piece, and each
wastes at most about one sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import map_arrow, slices
from tidemark.llm.tokens import encoder_in, shared_encoder

SEQUENCE = 4096
END_ID = 1
#: Documents whose pieces make a shard, on average.
SHARD_DOCS = 20_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def pieces_of(shared: Broadcast, end_id: int, size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder_in(shared), np.array([end_id], "<u4").tobytes()
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for part in slices(batches):
            rows = []
            for doc, text in zip(part[0].to_pylist(), part[1].to_pylist(), strict=True):
                ids = encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    piece = ids[at : at + 4 * size]
                    rows.append((doc, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
            )

    return work


def fill(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of lengths: each holds at most ``size``, and every length given is in one bin."""
    left = np.bincount(lengths, minlength=size + 1)
    total, bins = int(left.sum()), []
    below = np.maximum.accumulate(np.where(left > 0, np.arange(size + 1), 0))
    values = np.arange(size + 1)

    def take(length: int) -> None:
        nonlocal below
        left[length] -= 1
        if not left[length]:
            below = np.maximum.accumulate(np.where(left > 0, values, 0))

    while total:
        room, own = size, []
        while room and (length := int(below[room])):
            take(length)
            own.append(length)
            room -= length
        if room and own and (pair := better_two(left, below, own[-1] + room, own[-1])):
            smallest = own.pop()
            left[smallest] += 1
            for length in pair:
                left[length] -= 1
            below = np.maximum.accumulate(np.where(left > 0, values, 0))
            own += pair
        total -= len(own)
        bins.append(own)
    return bins


def better_two(left: np.ndarray, below: np.ndarray, gap: int, least: int) -> list[int] | None:
    """The two unpacked lengths that fill ``gap`` best, if together they exceed ``least``."""
    first = np.flatnonzero(left[: gap // 2 + 1])
    if not len(first):
        return None
    second = below[gap - first]
    twice = (second == first) & (left[first] < 2)
    total = np.where((second == 0) | twice, 0, first + second)
    k = int(np.argmax(total))
    return [int(second[k]), int(first[k])] if total[k] > least else None


def pack_shard(size: int):
    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "no_id", "doc_id", "piece", "ids_crc32"], ignore_index=True)
        lengths = rows["length"].to_numpy()
        at = np.searchsorted(lengths, np.arange(size + 2))
        turn, sequence, offset = at.copy(), np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        for number, own in enumerate(fill(lengths, size)):
            place = 0
            for length in own:
                row = turn[length]
                turn[length] += 1
                sequence[row], offset[row] = number, place
                place += length
        rows["sequence_id"] = (int(key[0]) << 40) + sequence
        rows["offset"] = offset
        return rows[[field.split()[0] for field in PACKED.split(", ")] + ["no_id"]]

    return work


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """One row per piece: its document, place in the document, and place in a sequence.

    Every document has its end id, so a null or empty text is a piece of length one. Rows with
    a null id are packed like others, and rows of a repeated id one by one. Documents longer
    than ``size`` are cut; others stay whole. No rows in, none out.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shards = max(1, source.count() // shard_docs)
    shared = shared_encoder(docs.sparkSession.sparkContext, tokenizer)
    pieces = map_arrow(source, pieces_of(shared, end_id, size), PIECES)
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    # Pandas has no missing integers: a missing id travels as a mark.
    dealt = dealt.withColumns({"no_id": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0))})
    packed = dealt.groupBy("shard").applyInPandas(pack_shard(size), f"{PACKED}, no_id boolean")
    own = F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id")
    return packed.select(own, *packed.columns[1:-1])
