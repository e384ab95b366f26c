"""Removal of long repeated byte strings with a sparse suffix array over the corpus.

A window of ``length`` bytes is repeated if the same bytes start anywhere else. Every window
has an anchor, the position of the least hash of sixteen bytes in its first part: equal
windows have their anchors at the same place. So only suffixes that start at anchors are
sorted, and of these only those whose first bytes, ``length - REACH + 1`` of them and part of
each of their windows, are met twice.

Sampled splitters deal the suffixes by their leading bytes into buckets. A bucket sorts its
suffixes by multikey quicksort, eight bytes a key, and splits them into groups of equal first
bytes. Within a group, the windows of all suffixes are compared. Groups that
begin like a bucket's first or last suffix may go on in other buckets: their windows are
compared across the boundaries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import bit_filter, map_arrow, mix, passes, slices, written

LENGTH = 400
GRAM = 16
#: Starts among which a window's anchor is chosen.
REACH = 257
#: Suffixes of a bucket, on average, if there are more than the session's shuffle partitions hold.
BUCKET = 20_000
KEY_BITS = 1 << 26
#: Suffixes of an open group whose windows are compared in one step.
OPEN = 1000
#: Bytes of contexts whose windows are compared in one step.
STEP = 1 << 20

SUFFIXES = "w0 long, w1 long, doc long, anchor int, low int, high int, context binary"

_random = np.random.default_rng(400)
BYTE_VALUES = _random.integers(1, 1 << 63, 256, np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
UNDO = np.uint64(pow(int(BASE), -1, 1 << 64))


def anchors(data: np.ndarray, length: int, reach: int) -> tuple[np.ndarray, ...]:
    """(anchor, first window, last window) for each anchor of the text's windows."""
    n = len(data) - length + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3
    m = n + reach - 1
    eight = np.lib.stride_tricks.as_strided(data, (m + 8, 8), (1, 1)).copy().view(np.uint64).ravel()
    value = (eight[:m] * BASE) ^ (eight[8 : m + 8] * np.uint64(0xD6E8FEB86659FD93))
    value = (value ^ (value >> np.uint64(29))) * BASE
    # The hash above, the position below: the least value is the leftmost of the least hashes.
    value = (value & ~np.uint64(0xFFFFFFFF)) | np.arange(m, dtype=np.uint64)
    rows = -(-m // reach)
    block = np.full(rows * reach, np.iinfo(np.uint64).max, np.uint64)
    block[:m] = value
    block = block.reshape(rows, reach)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    at = (np.minimum(behind[:n], ahead[reach - 1 : n + reach - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[first], first, np.r_[first[1:], n] - 1


def key_of(data: bytes, at: int, size: int) -> int:
    return xxhash.xxh64_intdigest(data[at : at + size])


def keys(length: int, reach: int):
    """Rows (key, n): how often a task's anchors are followed by the same bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = []
            for text in part[1].to_pylist():
                data = text.encode()
                at, _, _ = anchors(np.frombuffer(data, np.uint8), length, reach)
                found += [key_of(data, a, length - reach + 1) for a in at.tolist()]
            key, n = np.unique(np.array(found, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["key", "n"])

    return work


def suffixes(length: int, reach: int, marks):
    """The suffixes whose key may be repeated, each with the bytes of all windows of its anchor."""
    low_bits = np.uint64(KEY_BITS - 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, size = marks.value, length - reach + 1
        for part in slices(batches):
            rows = []
            for doc, text in zip(part[0].to_pylist(), part[1].to_pylist(), strict=True):
                data = text.encode()
                at, low, high = anchors(np.frombuffer(data, np.uint8), length, reach)
                key = np.array([key_of(data, a, size) for a in at.tolist()], np.uint64)
                keep = passes(bits, (key & low_bits).astype(np.int64))
                keep &= passes(bits, ((key >> np.uint64(32)) & low_bits).astype(np.int64))
                for a, x, y in zip(at[keep].tolist(), low[keep].tolist(), high[keep].tolist(), strict=True):
                    w0, w1 = np.frombuffer(data[a : a + 16], ">i8").tolist()
                    rows.append((w0, w1, doc, a, x, y, data[x : y + length]))
            kinds = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.binary()]
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            names = ["w0", "w1", "doc", "anchor", "low", "high", "context"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    return work


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of the rows of (n, k) keys: by the first key, and equal ones by the next."""
    order = np.argsort(words[:, 0], kind="stable")
    group = np.zeros(len(words), np.int64)
    open_ = np.arange(len(words))
    for k in range(words.shape[1]):
        if k:
            own = order[open_]
            order[open_] = own[np.lexsort((words[own, k], group[open_]))]
        own = order[open_]
        value, old = words[own, k], group[open_]
        new = np.r_[True, (value[1:] != value[:-1]) | (old[1:] != old[:-1])]
        group[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        same = ~new
        open_ = open_[same | np.r_[same[1:], False]]
        if not len(open_):
            break
    return order


def window_hashes(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, context number) of every window of the contexts."""
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(x) for x in contexts])
    power = np.cumprod(np.full(len(data), BASE, np.uint64))
    total = np.r_[np.uint64(0), np.cumsum(BYTE_VALUES[data] * power)]
    own = np.repeat(np.arange(len(contexts)), sizes)
    ends = np.cumsum(sizes)
    at = np.flatnonzero(np.arange(len(data)) + length <= ends[own])
    back = np.cumprod(np.full(len(data), UNDO, np.uint64))
    return mix((total[at + length] - total[at]) * back[at]), own[at]


def runs_of(rows: list[tuple], repeated: np.ndarray, own: np.ndarray) -> list[tuple]:
    """(doc, start, end) of the bytes under consecutive repeated windows of a context."""
    out = []
    first = np.searchsorted(own, np.arange(len(rows)))
    hit = np.flatnonzero(repeated)
    if not len(hit):
        return out
    cut = np.flatnonzero(np.r_[True, (hit[1:] != hit[:-1] + 1) | (own[hit[1:]] != own[hit[:-1]])])
    for a, b in zip(hit[cut].tolist(), hit[np.r_[cut[1:], len(hit)] - 1].tolist(), strict=True):
        doc, _, low, _, _ = rows[own[a]]
        begin = low - int(first[own[a]])
        out.append((doc, begin + a, begin + b))
    return out


def buckets(length: int, reach: int):
    """Repeated windows of whole groups; the windows of groups at a bucket's ends by hash.

    Output (hash, doc, low, high): a run of repeated windows without a hash, or one window, of
    which the document is left out if it is known to be repeated.
    """
    size = length - reach + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, heads = [], []
        for batch in batches:
            heads += zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True)
            rows += zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)
        if not rows:
            return
        # The splitters know the first sixteen bytes: what has them at an end may be cut.
        cut_at = np.array([min(heads), max(heads)], np.int64).astype(np.uint64)
        keys = [r[4][r[1] - r[2] : r[1] - r[2] + size] for r in rows]
        wide = -(-size // 8) * 8
        words = np.frombuffer(b"".join(k.ljust(wide, b"\0") for k in keys), ">u8").astype(np.uint64)
        words = words.reshape(len(rows), -1)
        order = multikey_order(words)
        rows, words = [rows[k] for k in order], words[order]
        starts = np.flatnonzero(np.r_[True, (words[1:] != words[:-1]).any(axis=1)]).tolist()
        groups = list(zip(starts, [*starts[1:], len(rows)], strict=True))

        def out(found: list[tuple]):
            columns = zip(*found, strict=True) if found else [[]] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["hash", "doc", "low", "high"]
            )

        held, number, bytes_held = [], [], 0
        for k, (a, b) in enumerate(groups):
            if (words[a, :2] == cut_at).all(axis=1).any():
                salt = np.uint64(xxhash.xxh64_intdigest(words[a].tobytes()))
                for at in range(a, b, OPEN):
                    part = rows[at : min(b, at + OPEN)]
                    value, own = window_hashes([r[4] for r in part], length)
                    value = mix(value ^ salt)
                    _, one, back, times = np.unique(
                        value, return_index=True, return_inverse=True, return_counts=True
                    )
                    twice = times[back] > 1
                    yield out([(None, *x) for x in runs_of(part, twice, own)])
                    # Windows met here once await one elsewhere; of the others one row tells.
                    first = np.searchsorted(own, np.arange(len(part)))
                    low = np.array([r[2] for r in part])
                    place = (np.arange(len(own)) - first[own] + low[own])[one]
                    docs = np.array([r[0] for r in part])[own[one]]
                    hashes = pa.array(value[one].view(np.int64))
                    docs = pa.array(docs, pa.int64(), mask=twice[one])
                    columns = [hashes, docs, pa.array(place), pa.array(place)]
                    yield pa.RecordBatch.from_arrays(columns, names=["hash", "doc", "low", "high"])
            elif b - a > 1:
                held += rows[a:b]
                number += [k] * (b - a)
                bytes_held += sum(len(r[4]) for r in rows[a:b])
                if bytes_held >= STEP:
                    yield out(within(held, number, length))
                    held, number, bytes_held = [], [], 0
        yield out(within(held, number, length))

    return work


def within(rows: list[tuple], number: list[int], length: int) -> list[tuple]:
    """Runs of windows that are repeated within their groups."""
    if not rows:
        return []
    value, own = window_hashes([r[4] for r in rows], length)
    group = np.array(number, np.uint64)[own]
    _, at, times = np.unique(mix(value ^ mix(group)), return_inverse=True, return_counts=True)
    return [(None, *x) for x in runs_of(rows, times[at] > 1, own)]


def cut(length: int):
    """Per document: sizes, spans and the digest of what remains."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64()] * 4 + [pa.string(), span]
        for part in slices(batches):
            rows = []
            for doc, text, found in zip(*(c.to_pylist() for c in part.columns), strict=True):
                data, spans = text.encode(), []
                for x in sorted((r["low"], r["high"] + length) for r in found or []):
                    if spans and x[0] <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(spans[-1][1], x[1]))
                    else:
                        spans.append(x)
                kept, at = hashlib.sha256(), 0
                for start, end in spans:
                    kept.update(data[at:start])
                    at = end
                kept.update(data[at:])
                own = [{"start": a, "end": b} for a, b in spans]
                removed = sum(b - a for a, b in spans)
                rows.append((doc, len(data), removed, len(spans), kept.hexdigest(), own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )

    return work


CUT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "spans array<struct<start: long, end: long>>"
)


def repeated_spans(docs: DataFrame, length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """Per row of ``docs``: what is removed as repeated strings of ``length`` bytes.

    Columns: doc_id, n_bytes, n_removed, n_spans (maximal removed runs of bytes), kept_sha256
    and spans (their places). Strings are judged on the input, matches stay within a row, and
    a string that overlaps itself counts. Null texts are empty. Rows with null or repeated ids
    are rows of their own. Other columns are ignored. No rows in, none out.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("doc", F.xxhash64("doc_id", "text"))
    long_ = source.where(F.octet_length("text") >= length).select("doc", "text")
    twice = map_arrow(long_, keys(length, reach), "key long, n long").groupBy("key")
    twice = twice.agg(F.sum("n").alias("n")).where("n > 1")
    low = KEY_BITS - 1
    bits = twice.selectExpr(f"explode(array(key & {low}, shiftright(key, 32) & {low})) as bit")
    marks = spark.sparkContext.broadcast(bit_filter(bits, "bit", KEY_BITS))
    found = written(map_arrow(long_, suffixes(length, reach, marks), SUFFIXES), "suffixes")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), found.count() // BUCKET)
    dealt = found.repartitionByRange(parts, "w0", "w1", "doc", "anchor")
    runs = written(
        map_arrow(dealt, buckets(length, reach), "hash long, doc long, low long, high long"), "runs"
    )
    ends = runs.where("hash is not null")
    again = ends.groupBy("hash").agg(F.sum(F.expr("if(doc is null, 2, 1)")).alias("n"))
    again = again.where("n > 1").select("hash")
    waiting = ends.where("doc is not null").join(again, "hash", "left_semi")
    all_ = runs.where("hash is null").union(waiting)
    spans = all_.groupBy("doc").agg(F.collect_set(F.struct("low", "high")).alias("found"))
    rows = source.join(spans, "doc", "left").select("doc_id", "text", "found")
    return map_arrow(rows, cut(length), CUT)
