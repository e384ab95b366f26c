"""Toxicity of texts by compression with a toxic and an ordinary dictionary.

Two zstandard dictionaries are trained on labelled texts. Both hold the commonest beginnings of
words of ordinary texts; before these each holds what its own class has and the other has not,
chosen as zstandard's own trainer does, the segment of most gain first, then without what it
covers. Every text is cut into windows of whole words, and each window is compressed with both
dictionaries: the bytes that the toxic one saves are the window's advantage. A logistic scale over
a text's advantages, fitted on texts that the dictionaries were not trained on, makes a
probability of them.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import WordHashes, map_arrow, mix, slices, word_hashes, windows

#: Different labelled texts of each class that may train the model, and the bytes of the longest
#: one that may: bounds at any corpus size.
SAMPLE = 3000
LONGEST = 1 << 15
#: Bytes of a window, of a class's own part of a dictionary, and of the part both share.
WINDOW = 96
OWN_BYTES, SHARED_BYTES = 512, 8192
#: Bytes from the end of the shared part put before each window: one long match, so that short
#: windows are compressed too and what little a class's own part saves is seen.
LEAD = 24
#: A segment begins a word, blank included. It must be in so many training texts of its class,
#: in so many times the share of the other class, and by so much not by chance (G statistic).
SHORTEST, LONGEST_SEGMENT = 4, 12
SEEN, RATIO, SURE = 5, 3, 20.0
#: Score from which a text is predicted to be toxic.
TOXIC = 0.3

CUT = re.compile(rb"(?s).{1,%d}(?= |\Z)|.{1,%d}" % (WINDOW, WINDOW))
HISTOGRAM = 10


def normal(text: str | None) -> bytes:
    """Lower-cased words, each after one blank."""
    return b"".join(b" " + w for w in (text or "").lower().encode().split())


def beginnings(text: bytes) -> set[bytes]:
    """All segments that begin a word of the text."""
    found = set()
    for word in set(text.split()):
        word = b" " + word[: LONGEST_SEGMENT - 1]
        found.update(word[:k] for k in range(SHORTEST, len(word) + 1))
    return found


def g_statistic(x: int, n: int, y: int, m: int) -> float:
    """How unlike chance it is that x of n and y of m texts hold something."""

    def part(k: int, of: int) -> float:
        return k * log(k / of) if k else 0.0

    split = part(x, n) + part(n - x, n) + part(y, m) + part(m - y, m)
    return 2 * (split - part(x + y, n + m) - part(n + m - x - y, n + m))


def own_segments(own: Counter, n: int, other: Counter, m: int) -> list[bytes]:
    """Segments of a class, best first, until its part of the dictionary is full.

    A segment's gain is its statistic times the bytes a match of it saves; the texts that a
    chosen segment is in no longer count for the beginnings of that segment.
    """
    left = dict(own)

    def sure(segment: bytes) -> float:
        x, y = left[segment], other[segment]
        return g_statistic(x, n, y, m) if x >= SEEN and x * m > RATIO * y * n else 0.0

    def gain(segment: bytes) -> float:
        return sure(segment) * (len(segment) - 2.5)

    heap = [(-gain(s), s) for s, x in left.items() if x >= SEEN]
    heapq.heapify(heap)
    chosen, size = [], 0
    while heap and size < OWN_BYTES:
        value, segment = heapq.heappop(heap)
        if segment.startswith(tuple(chosen)) or sure(segment) < SURE:
            continue
        now = gain(segment)
        if now < -value:
            heapq.heappush(heap, (-now, segment))
            continue
        chosen.append(segment)
        size += len(segment)
        for k in range(SHORTEST, len(segment)):
            left[segment[:k]] -= left[segment]
    return chosen


def shared_segments(ordinary: Counter, without: tuple[bytes, ...]) -> bytes:
    """The commonest beginnings of ordinary words, the commonest last, where offsets are short."""
    common = ((x, s) for s, x in ordinary.items() if len(s) > SHORTEST)
    best = heapq.nlargest(SHARED_BYTES // SHORTEST, common)
    kept = [s for _, s in best if not s.startswith(without)]
    return b"".join(reversed(kept))[-SHARED_BYTES:]


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """(toxic, ordinary) dictionary of texts of both classes."""
    counts = []
    for texts in (toxic, ordinary):
        count: Counter = Counter()
        for text in texts:
            count.update(beginnings(text))
        counts.append(count)
    n, m = len(toxic), len(ordinary)
    own = own_segments(counts[0], n, counts[1], m)
    others = own_segments(counts[1], m, counts[0], n)
    shared = shared_segments(counts[1], tuple(own + others))
    return tuple(b"".join(reversed(part))[-OWN_BYTES:] + shared for part in (own, others))


class Compressor:
    """Lengths of windows under a dictionary of plain content."""

    def __init__(self, dictionary: bytes):
        parameters = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_BTLAZY2,
            window_log=15,
            hash_log=15,
            chain_log=16,
            search_log=6,
            min_match=4,
            target_length=64,
            format=zstandard.FORMAT_ZSTD1_MAGICLESS,
            write_content_size=False,
            write_dict_id=False,
            write_checksum=False,
        )
        # A dictionary of under eight bytes is none to zstandard.
        content = zstandard.ZstdCompressionDict(
            dictionary.rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        content.precompute_compress(compression_params=parameters)
        self.compress = zstandard.ZstdCompressor(
            dict_data=content, compression_params=parameters
        ).compress

    def lengths(self, parts: list[bytes]) -> np.ndarray:
        return np.fromiter((len(self.compress(x)) for x in parts), np.int64, len(parts))


class Comparer:
    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = Compressor(toxic), Compressor(ordinary)
        self.lead = ordinary[-LEAD:]

    def features(self, text: bytes) -> np.ndarray:
        """What a text's windows say; a text without words is one empty window."""
        parts = [self.lead + x for x in CUT.findall(text) or [b""]]
        saved = self.ordinary.lengths(parts) - self.toxic.lengths(parts)
        n = len(saved)
        best = np.sort(saved)[::-1]
        count = np.bincount(np.clip(saved, -3, 6) + 3, minlength=HISTOGRAM)
        return np.r_[
            best[0], best[:2].sum(), best[:4].sum(), np.maximum(saved - 1, 0).mean(),
            np.log1p(n), np.log1p(count[4:]), count[4:] / n, count[:3].sum() / n, saved.mean(),
        ]


def calibrate(rows: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic weights over standardised columns, the constant last, as (centre, scale, weights)."""
    centre, scale = rows.mean(0), rows.std(0)
    scale[scale < 1e-9] = 1.0
    x = np.c_[(rows - centre) / scale, np.ones(len(rows))]
    ridge = np.r_[np.full(x.shape[1] - 1, 0.5), 1e-3]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (chance - label)) + ridge * w
        bend = (x * (weight * chance * (1 - chance))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.r_[centre, scale, w]


def first_of_near_copies(texts: list[bytes]) -> list[bytes]:
    """Texts less those that share a least hash of their shingles with one before them: a
    group of near copies would else make its own words look like those of its class."""
    known, seen, kept = WordHashes(), set(), []
    for text in texts:
        hashes = word_hashes(text.decode(), known)
        grams = windows(hashes, min(5, len(hashes))) if len(hashes) else hashes
        if not len(grams):
            continue
        marks = {(k, int(mix(grams ^ np.uint64(k + 1)).min())) for k in range(4)}
        if marks.isdisjoint(seen):
            kept.append(text)
        seen |= marks
    return kept


def fit(texts: list[list[bytes]], totals: list[int]) -> tuple[bytes, bytes, np.ndarray] | None:
    """Dictionaries and scale from texts of class 0 and 1; ``totals`` are all labelled of each.

    The scale is fitted on each half of the texts with the dictionaries of the other half; the
    final dictionaries are those of all texts.
    """
    ordinary, toxic = (first_of_near_copies(sorted(x, key=xxhash.xxh64_digest)) for x in texts)
    if min(len(ordinary), len(toxic)) < 2:
        return None
    rows, label = [], []
    for half in (0, 1):
        compare = Comparer(*train_dictionaries(toxic[half::2], ordinary[half::2]))
        for kind, own in enumerate((ordinary[1 - half :: 2], toxic[1 - half :: 2])):
            rows += map(compare.features, own)
            label += [kind] * len(own)
    label = np.array(label)
    weight = np.array([totals[0] / len(ordinary), totals[1] / len(toxic)])[label]
    weight *= len(label) / weight.sum()
    scale = calibrate(np.array(rows), label, weight)
    return (*train_dictionaries(toxic, ordinary), scale)


def fitter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of the sampled rows ``(toxic, total, text)``, which one task can hold."""
    texts: list[list[bytes]] = [[], []]
    totals = [0, 0]
    for batch in batches:
        for kind, total, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            texts[kind].append(normal(text))
            totals[kind] = total
    model = fit(texts, totals)
    if model is not None:
        columns = [pa.array([model[0]]), pa.array([model[1]]), pa.array([model[2].tolist()])]
        yield pa.RecordBatch.from_arrays(columns, names=["toxic", "ordinary", "scale"])


def held_out() -> Column:
    """Rows whose label is never learned from; a null id is none of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """(model or None, share of label 1). Texts are drawn by the order of their hashes, exact
    copies once; only the drawn ones, a bounded number, go to the one task that fits."""
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = source.where(~held_out()).select(
        "doc_id",
        F.xxhash64("text").alias("print"),
        F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"),
    )
    found = prints.join(known, "doc_id").groupBy("toxic", "print", "size").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("n")
    )
    totals = dict(found.groupBy("toxic").agg(F.sum("n")).collect())
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    fit_to_learn = found.where((F.col("size") > 0) & (F.col("size") <= LONGEST))
    chosen = None
    for kind in (0, 1):
        own = fit_to_learn.where(F.col("toxic") == kind).orderBy("print", "doc_id").limit(sample)
        own = own.select(
            "doc_id", "print", "toxic", F.lit(totals.get(kind, 0)).cast("long").alias("total")
        )
        chosen = own if chosen is None else chosen.union(own)
    texts = (
        source.withColumn("print", F.xxhash64("text"))
        .join(F.broadcast(chosen), ["doc_id", "print"])
        .groupBy("toxic", "total", "print")
        .agg(F.first("text").alias("text"))
        .select("toxic", "total", "text")
    )
    schema = "toxic binary, ordinary binary, scale array<double>"
    found = map_arrow(texts.repartition(1), fitter, schema).collect()
    model = (bytes(found[0][0]), bytes(found[0][1]), np.array(found[0][2])) if found else None
    return model, share


def scorer(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, ordinary, scale = shared.value
        compare = Comparer(toxic, ordinary)
        width = (len(scale) - 1) // 3
        centre, spread, weights = scale[:width], scale[width : 2 * width], scale[2 * width :]
        for rows in slices(batches):
            found = [compare.features(normal(x)) for x in rows[2].to_pylist()]
            margin = ((np.array(found) - centre) / spread) @ weights[:-1] + weights[-1]
            score = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [rows[0], rows[1], pa.array(score)], names=["doc_id", "held_out", "score"]
            )

    return work


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each document.

    Scores rest on the text alone. Null, empty and blank texts are one empty window and get its
    score. A null id is not held out and has no label. Of repeated labels of an id any 1
    counts; null and other labels say nothing; repeated rows get equal scores. Without two
    different texts of each class that are labelled and not held out, every score is the share of
    label 1 (0 without labels). No documents, no rows.
    """
    model, share = learn(docs, labels, sample)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text"
    )
    if model is None:
        scored = rows.select("doc_id", "held_out", F.lit(float(share)).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        scored = map_arrow(rows, scorer(shared), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))
