"""Words, hashes and Arrow batches shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import work_dir

#: Rows that a task holds as Python objects at a time.
SLICE_ROWS = 500
#: Words a task remembers before it forgets them all.
WORDS_KEPT = 300_000

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: computed once, and no lineage before it."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, list]:
    """``docs`` with those of its columns renamed, and the columns that bring it back."""
    own = {c: f"__own_{c}" for c in names if c in docs.columns}
    return docs.withColumnsRenamed(own), [F.col(own.get(c, c)).alias(c) for c in docs.columns]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_arrow(df: DataFrame, work: Callable, schema: T.StructType | str) -> DataFrame:
    return df.mapInArrow(work, schema)


class WordHashes(dict):
    """64-bit hash of a word as bytes; forgets all words when it has too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def words(text: str | None) -> list[bytes]:
    """Words of the ASCII-lowered text, parted by the six ASCII white-space characters."""
    return text.encode().lower().split() if text else []


def word_hashes(text: str | None, known: WordHashes) -> np.ndarray:
    own = words(text)
    return np.fromiter(map(known.__getitem__, own), np.uint64, len(own))


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * GOLDEN
    h = h ^ (h >> np.uint64(29))
    h = h * STEP
    return h ^ (h >> np.uint64(32))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in text order."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n].copy()
    for k in range(1, size):
        total = total * STEP + hashes[k : k + n]
    return mix(total + np.uint64(size))


def shingles(hashes: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct shingles; a shorter text is one shingle, an empty one none."""
    if not len(hashes):
        return hashes
    return np.unique(windows(hashes, min(size, len(hashes))))


def array_adder(keys: int):
    """Sums of the zstd-packed int64 arrays (last column) of a task, by the columns before it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, schema = {}, None
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            schema = batch.schema
            for *key, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(unpack(data), np.int64)
                key = tuple(key)
                totals[key] = totals[key] + part if key in totals else part
        if totals:
            columns = [*zip(*totals, strict=True), map(packed, totals.values())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    return work


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype(np.int64).tobytes())


def summed_arrays(parts: DataFrame, *keys: str) -> dict[tuple, np.ndarray]:
    """The sums of packed arrays by key; for a number of keys and a size that are bounded."""
    rows = map_arrow(parts.repartition(*keys), array_adder(len(keys)), parts.schema)
    out: dict[tuple, np.ndarray] = {}
    unpack = zstandard.ZstdDecompressor().decompress
    for *key, data in rows.collect():
        part = np.frombuffer(unpack(bytes(data)), np.int64)
        out[tuple(key)] = out.get(tuple(key), 0) + part
    return out


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


#: Bits of a filter of ids, whatever their number.
FILTER_BITS = 1 << 24


def packed_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each batch of rows (word, its 32 bits): both packed, eight bytes a word at most."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        data = np.stack([c.to_numpy(zero_copy_only=False).astype(np.uint32) for c in batch.columns])
        yield pa.RecordBatch.from_arrays([pa.array([pack(data.tobytes())], pa.binary())], names=["data"])


def bit_filter(rows: DataFrame, bit: str, bits: int) -> np.ndarray:
    """Bit array with the bits set that column ``bit`` names: ``bits / 8`` bytes at any size.

    A filter only spares work: what passes it is joined exactly later. Its words reach the driver
    packed, some thousand in a row, not as a row each.
    """
    found = (
        rows.select(F.col(bit).cast("long").alias("b"))
        .groupBy(F.shiftright("b", 5).alias("w"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(b & 31 as int)))").alias("m"))
    )
    out = np.zeros(bits // 32, np.uint32)
    unpack = zstandard.ZstdDecompressor().decompress
    for row in map_arrow(found, packed_words, "data binary").collect():
        w, m = np.frombuffer(unpack(bytes(row.data)), np.uint32).reshape(2, -1)
        out[w] = m
    return out


def passes(marks: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((marks[at >> 5] >> (at & 31).astype(np.uint32)) & 1).astype(bool)


def id_bit(column: str, bits: int = FILTER_BITS):
    return F.pmod(F.xxhash64(column), F.lit(bits)).cast("int")


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    return bit_filter(ids.select(id_bit(column).alias("bit")), "bit", FILTER_BITS)
