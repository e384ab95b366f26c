"""Token-id files: frequency ranks in byte-aligned codes, control bytes apart from data bytes.

An id is written as its rank by frequency, in one to four bytes; two bits of a control byte
give the length, so the frequent ids take one byte and decoding is table lookup. A file is
the documents of a range of ids in ascending order, in blocks of some documents; each block
holds its control bytes and its data bytes in columns of their own. The table of ranks lies
beside the files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import map_arrow, slices, written
from tidemark.llm.tokens import encoder_in, shared_encoder
from tidemark.session import work_dir

END_ID = 2
#: Ids of a block, but for its last document.
BLOCK = 400_000

#: Lengths of the four values that a control byte describes.
LENGTHS = (1 + ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3)).astype(np.uint8)

IDS = "doc_id long, n long, ids binary, id int, times long"
BLOCKS = (
    "first long, part long, part_start long, n long, "
    "docs array<long>, sizes array<long>, control binary, data binary"
)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) bytes of unsigned 32-bit values."""
    wide = values.astype("<u4")
    size = 1 + (wide > 0xFF) + (wide > 0xFFFF) + (wide > 0xFFFFFF)
    code = np.zeros(-(-len(wide) // 4) * 4, np.uint8)
    code[: len(wide)] = size - 1
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    keep = np.arange(4) < size[:, None]
    return control.tobytes(), wide.view(np.uint8).reshape(-1, 4)[keep].tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of :func:`encode`, by lookup of the control bytes' lengths."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4) < size[:, None]] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")


def tokenised(shared: Broadcast, end_id: int):
    """A row of ids for each document, and at the end a row for each id with its count."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_in(shared), np.array([end_id], "<u4").tobytes()
        pack = zstandard.ZstdCompressor(level=1).compress
        times = np.zeros(1 << 16, np.int64)
        names = ["doc_id", "n", "ids", "id", "times"]
        for part in slices(batches):
            sizes, rows = [], []
            held = [encoder(text) + end for text in part[1].to_pylist()]
            ids = np.frombuffer(b"".join(held), "<u4")
            # One count for the slice: it is as wide as the vocabulary.
            found = np.bincount(ids)
            if len(found) > len(times):
                times = np.r_[times, np.zeros(2 * len(found), np.int64)]
            times[: len(found)] += found
            narrow = ids.astype("<u2") if len(found) <= 1 << 16 else ids
            at = 0
            for data in held:
                size = len(data) // 4
                rows.append(pack(narrow[at : at + size].tobytes()))
                sizes.append(size)
                at += size
            none = pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part[0], pa.array(sizes, pa.int64()), pa.array(rows, pa.binary()), *none],
                names=names,
            )
        used = np.flatnonzero(times)
        blank = [pa.nulls(len(used), t) for t in (pa.int64(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [*blank, pa.array(used.astype(np.int32)), pa.array(times[used])], names=names
        )

    return work


def blocks(ranks: Broadcast):
    """Blocks of a task's documents, which come in ascending order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, rank = zstandard.ZstdDecompressor().decompress, ranks.value
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.binary()] * 2
        names = ["first", "part", "part_start", "n", "docs", "sizes", "control", "data"]
        # Tasks are numbered in the order of their ranges.
        number, start, docs, held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def block():
            values = np.concatenate(held)
            row = docs[0], number, start, len(values), docs, [len(x) for x in held]
            row += encode(values)
            return pa.RecordBatch.from_arrays(
                [pa.array([c], k) for c, k in zip(row, kinds, strict=True)], names=names
            )

        for part in slices(batches):
            for doc, n, data in zip(*(c.to_pylist() for c in part.columns), strict=True):
                raw = unpack(data)
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")
                docs.append(doc)
                held.append(rank[ids])
                size += n
                if size >= BLOCK:
                    yield block()
                    start, docs, held, size = start + size, [], [], 0
        if docs:
            yield block()

    return work


def write_ids(
    docs: DataFrame, path: str, end_id: int = END_ID, tokenizer: str | None = None
) -> None:
    """Writes the id files of ``docs (doc_id, text)`` and their rank table below ``path``.

    A null text is empty and has the end id only. Rows with a null id come behind all others;
    rows of a repeated id are written one after another, the shorter first. No rows give
    empty files. Other columns are ignored.
    """
    context = docs.sparkSession.sparkContext
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = shared_encoder(context, tokenizer)
    found = written(map_arrow(source, tokenised(shared, end_id), IDS), "ids")
    # One row for each entry of the vocabulary: bounded.
    times = found.where("id is not null").groupBy("id").agg(F.sum("times").alias("times"))
    order = times.orderBy(F.desc("times"), "id").select("id").toPandas()["id"].to_numpy(np.int64)
    rank = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
    rank[order] = np.arange(len(order))
    spark = docs.sparkSession
    table = spark.createDataFrame([(order.astype("<u4").tobytes(),)], "ids binary")
    table.write.parquet(f"{path}/ranks")
    ranks = context.broadcast(rank)
    rows = found.where("id is null").select("doc_id", "n", "ids")
    # A frequent or missing id lies in as many ranges as its rows fill.
    order = [F.asc_nulls_last("doc_id"), F.asc("n"), F.xxhash64("ids"), F.asc("ids")]
    rows = rows.repartitionByRange(*order[:3]).sortWithinPartitions(*order)
    map_arrow(rows, blocks(ranks), BLOCKS).write.parquet(f"{path}/blocks")


def decoded(ids_by_rank: Broadcast):
    """Per document of a block: id, start in the part, number and checksum of its ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ids_by_rank.value
        for part in slices(batches, 1):
            (number,), (start,), (n,), (docs,), (sizes,), (control,), (data,) = (
                c.to_pylist() for c in part.columns
            )
            ids = table[decode(control, data, n)].astype("<u4")
            ends = np.cumsum(sizes)
            begins = ends - sizes
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * len(docs), pa.int64()),
                    pa.array(docs, pa.int64()),
                    pa.array(begins + start, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["part", "doc_id", "at", "n_tokens", "ids_crc32"],
            )

    return work


def read_ids(spark, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of the documents in id files."""
    data = spark.read.parquet(f"{path}/ranks").head()["ids"]
    table = spark.sparkContext.broadcast(np.frombuffer(bytes(data), "<u4"))
    files = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # A row for each file, however many documents there are.
    parts = files.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    rows = files.select("part", "part_start", "n", "docs", "sizes", "control", "data")
    schema = "part long, doc_id long, at long, n_tokens long, ids_crc32 long"
    return (
        map_arrow(rows, decoded(table), schema)
        .join(F.broadcast(parts), "part")
        .selectExpr("doc_id", "before + at as start", "n_tokens", "ids_crc32")
    )


def round_trip(docs: DataFrame) -> DataFrame:
    path = work_dir(docs.sparkSession, "id_files")
    write_ids(docs, path)
    return read_ids(docs.sparkSession, path)
