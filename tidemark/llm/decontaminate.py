"""Benchmark decontamination by spaced-seed hashing.

A seed is the hash of some of twelve neighbouring tokens: a mask says which, and the others
may be anything. Seeds of training texts and of benchmark items are joined; around each hit
the two texts are laid over each other, and an overlap counts if enough of its tokens agree.
A filter of fixed size over the benchmark's seeds spares the texts without any hit the join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import bit_filter, map_arrow, mix, passes, signed, slices, written

#: Tokens that count (1) in a seed; the holes let substitutions of a third to a sixth pass.
MASKS = ("101101101101", "110111011101", "111101111011", "111110111110")
SPAN = 12
#: Agreeing tokens an overlap needs (all tokens of a shorter item), and their least share.
MIN_TOKENS = 13
MIN_SHARE = 0.75
#: Bits of the seed filter.
SEED_BITS = 1 << 26
WORDS_KEPT = 300_000

EDGES = re.compile(r"^[\W_]+|[\W_]+$")


class TokenHashes(dict):
    """Hash of a lower-cased word without outer punctuation; 0 if nothing is left of it."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        token = EDGES.sub("", word.decode().lower())
        value = self[word] = xxhash.xxh64_intdigest(token.encode()) | 1 if token else 0
        return value


def token_hashes(text: str | None, known: TokenHashes) -> np.ndarray:
    parts = text.encode().split() if text else []
    out = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    return out[out != 0]


def seeds(tokens: np.ndarray, shorter: tuple[int, ...] = ()) -> list[np.ndarray]:
    """Seed hashes by mask, at each position; then of whole runs of each length in ``shorter``."""
    out = []
    for mask in (*MASKS, *("1" * k for k in shorter)):
        n = max(0, len(tokens) - len(mask) + 1)
        total = np.full(n, xxhash.xxh64_intdigest(mask.encode()), np.uint64)
        for k, used in enumerate(mask):
            if used == "1":
                total = total * np.uint64(0xD6E8FEB86659FD93) + tokens[k : k + n]
        out.append(mix(total))
    return out


def item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, tokens, seeds, positions) of benchmark items; one shorter than a mask is one
    seed as a whole."""
    known = TokenHashes()
    for part in slices(batches):
        rows = []
        for own, text in zip(part[0].to_pylist(), part[1].to_pylist(), strict=True):
            tokens = token_hashes(text, known)
            n = len(tokens)
            found = seeds(tokens, (n,) if 0 < n < SPAN else ())
            at = np.concatenate([np.arange(len(x)) for x in found])
            if len(at):
                rows.append((own, tokens.tobytes(), np.concatenate(found).view(np.int64), at))
        if rows:
            yield seeded(rows)


def hit_rows(shorter: tuple[int, ...], marks):
    """The same of those documents that have a seed of the filter, with these seeds only.

    The texts of a slice are hashed as one row of tokens; seeds that reach over the end of
    their text are left out.
    """
    low = np.uint64(SEED_BITS - 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = TokenHashes(), marks.value
        spans = [len(mask) for mask in MASKS] + list(shorter)
        for part in slices(batches):
            texts = [token_hashes(text, known) for text in part[1].to_pylist()]
            sizes = np.array([len(x) for x in texts])
            ends = np.cumsum(sizes)
            until = np.repeat(ends, sizes)
            hits, at = [], []
            for span, found in zip(spans, seeds(np.concatenate(texts), shorter), strict=True):
                keep = np.flatnonzero(passes(bits, (found & low).astype(np.int64)))
                second = (found[keep] >> np.uint64(32)) & low
                keep = keep[passes(bits, second.astype(np.int64))]
                keep = keep[keep + span <= until[keep]]
                hits.append(found[keep])
                at.append(keep)
            hits, at = np.concatenate(hits), np.concatenate(at)
            if not len(hits):
                continue
            of = np.searchsorted(ends, at, "right")
            order = np.argsort(of, kind="stable")
            hits, at, of = hits[order].view(np.int64), at[order], of[order]
            ids, rows = part[0].to_pylist(), []
            cuts = np.r_[0, np.flatnonzero(np.diff(of)) + 1, len(of)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                k = of[a]
                begin = ends[k] - sizes[k]
                rows.append((ids[k], texts[k].tobytes(), hits[a:b], at[a:b] - begin))
            yield seeded(rows)

    return work


def seeded(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["id", "tokens", "seeds", "at"],
    )


SEEDED = "id long, tokens binary, seeds array<long>, at array<int>"


def best_overlap(same: np.ndarray) -> tuple[int, int, int]:
    """(start, end, agreeing) of the stretch with most agreement: a mismatch costs two."""
    worth = np.r_[0, np.cumsum(np.where(same, 1, -2))]
    start = np.minimum.accumulate(worth)
    end = int(np.argmax(worth - start))
    first = int(np.argmin(worth[: end + 1]))
    return first, end, int(same[first:end].sum())


def verify(min_tokens: int, min_share: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for doc, item, shift, x, y in zip(*(c.to_pylist() for c in part.columns), strict=True):
                d, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = max(0, -shift)
                n = min(len(b) - at, len(d) - at - shift)
                first, end, same = best_overlap(d[at + shift : at + shift + n] == b[at : at + n])
                if same >= min(min_tokens, len(b)) and same >= min_share * (end - first):
                    rows.append((doc, item, at + shift + first, at + first, end - first, same))
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "item_id", "doc_token", "item_token", "n_tokens", "n_same"],
            )

    return work


OVERLAP = (
    "doc_id long, item_id long, doc_token long, item_token long, n_tokens long, n_same long"
)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    min_tokens: int = MIN_TOKENS,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """The longest overlap of each document with each benchmark text it holds part of.

    Columns: doc_id, item_id (of equal items the smallest), doc_token and item_token (where the
    overlap begins), n_tokens, n_same (tokens that agree). Tokens are lower-cased words without
    outer punctuation. Items of fewer than twelve tokens are sought whole and unchanged. Null
    or blank texts and null ids take no part; rows of a repeated document id share its
    overlaps. Other columns are ignored. Nothing overlaps an empty benchmark.
    """
    context = docs.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), "text")
    items = written(
        map_arrow(items.where("id is not null"), item_rows, SEEDED)
        .groupBy("tokens")
        .agg(F.min("id").alias("id"), F.first("seeds").alias("seeds"), F.first("at").alias("at")),
        "items",
    )
    lengths = items.selectExpr("length(tokens) div 8 as n").where(f"n < {SPAN}").distinct()
    shorter = tuple(sorted(r[0] for r in lengths.collect()))
    grams = items.selectExpr("id as item", "inline(arrays_zip(seeds, at))")
    grams = grams.selectExpr("item", "seeds as seed", "at as item_at")
    low = SEED_BITS - 1
    bits = grams.selectExpr(f"explode(array(seed & {low}, shiftright(seed, 32) & {low})) as bit")
    marks = context.broadcast(bit_filter(bits, "bit", SEED_BITS))
    source = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("id is not null")
    found = written(map_arrow(source, hit_rows(shorter, marks), SEEDED), "hits")
    hits = found.selectExpr("id as doc", "inline(arrays_zip(seeds, at))")
    shifts = (
        hits.selectExpr("doc", "seeds as seed", "at as doc_at")
        .join(grams, "seed")
        .selectExpr("doc", "item", "doc_at - item_at as shift")
        .distinct()
    )
    pairs = (
        shifts.join(found.selectExpr("id as doc", "tokens as x").distinct(), "doc")
        .join(items.selectExpr("id as item", "tokens as y"), "item")
        .select("doc", "item", "shift", "x", "y")
    )
    kept = map_arrow(pairs, verify(min_tokens, min_share), OVERLAP)
    best = F.expr(
        "max_by(struct(doc_token, item_token, n_tokens, n_same), "
        "struct(n_same, -n_tokens, -doc_token, -item_token))"
    )
    return kept.groupBy("doc_id", "item_id").agg(best.alias("o")).select("doc_id", "item_id", "o.*")


def without_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a verified overlap; rows with a null id have none and stay."""
    bad = overlaps(docs, benchmark).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)
