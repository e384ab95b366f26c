"""Runs of repeated words in each document, whatever their period.

For each period p the words at multiples of p are compared with the words p further on: a
stretch of period p and at least two periods holds such a pair. How far the agreement of a
pair reaches to both sides is asked from an index of common extensions. It sorts only the
suffixes that start at places of a difference cover: from any two places a few words further on,
the same number for both, two places of the cover are reached, and what these have in common is
a range minimum over the sorted suffixes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.text import WORDS_KEPT, map_arrow, slices

#: A run has so many words at least, and two periods.
LEAST = 12
#: Every difference modulo CYCLE is one of two numbers of the cover.
CYCLE = 31
COVER = np.array([0, 1, 3, 8, 12, 18])
#: Pairs looked at in one go, and words of short documents that share one index.
PAIRS = 1 << 20
SHARED_WORDS = 1 << 16

#: The place of a residue in the cover, and for each difference the cover's smaller number.
PLACE = np.full(CYCLE, -1)
PLACE[COVER] = np.arange(len(COVER))
SYNC = np.zeros(CYCLE, np.int64)
for _d in COVER:
    SYNC[(COVER - _d) % CYCLE] = _d


class Extensions:
    """How many words two suffixes of ``ids`` (not negative) have in common."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        self.ids = np.concatenate([ids.astype(np.int64), np.full(2 * CYCLE, -1)])
        blocks = -(-self.n // CYCLE) + 1
        places = (np.arange(blocks)[:, None] * CYCLE + COVER).ravel()
        self.places = places[places < self.n]
        self._sort()
        self._range_minima()

    def _sort(self) -> None:
        """Ranks of the sampled suffixes: by their first CYCLE words, then by doubling, since
        CYCLE words after a sampled place the next one lies, so many samples further on."""
        m = len(self.places)
        keys = self._packed(int(self.ids.max(initial=0)) + 2)
        order = np.lexsort(keys[::-1])
        new = np.zeros(m, bool)
        for key in keys:
            new[1:] |= np.diff(key[order]) != 0
        rank = np.empty(m, np.int64)
        rank[order] = np.cumsum(new) + 1
        self.levels = [rank]
        step = len(COVER)
        while rank.max(initial=0) < m:
            behind = np.zeros(m, np.int64)
            behind[:-step] = rank[step:]
            pair = rank * (m + 1) + behind
            order = np.argsort(pair, kind="stable")
            rank = np.empty(m, np.int64)
            rank[order] = np.cumsum(np.r_[True, np.diff(pair[order]) != 0]) if m else 0
            self.levels.append(rank)
            step *= 2
        self.order, self.rank = order, rank - 1

    def _packed(self, kinds: int) -> list[np.ndarray]:
        """The first CYCLE words of each sampled suffix, several to a number."""
        bits = max(1, kinds.bit_length())
        each = 62 // bits
        keys = []
        for at in range(0, CYCLE, each):
            key = np.zeros(len(self.places), np.int64)
            for k in range(at, min(at + each, CYCLE)):
                key = key << bits | (self.ids[self.places + k] + 1)
            keys.append(key)
        return keys

    def _agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words that agree from ``a`` and ``b`` on, up to ``most``, read one by one."""
        same = np.zeros(len(a), np.int64)
        on = np.flatnonzero(most > 0)
        while len(on):
            on = on[self.ids[a[on] + same[on]] == self.ids[b[on] + same[on]]]
            same[on] += 1
            on = on[same[on] < most[on]]
        return same

    def _range_minima(self) -> None:
        """Common words of sorted neighbours, and their minima over ranges of doubled length."""
        a, b = self.order[:-1].copy(), self.order[1:].copy()
        common = np.zeros(len(a), np.int64)
        m = len(self.places)
        for k in reversed(range(len(self.levels) - 1)):
            level = np.r_[self.levels[k], 0]
            equal = (level[a] == level[b]) & (level[a] > 0)
            common[equal] += CYCLE << k
            a[equal] = np.minimum(a[equal] + (len(COVER) << k), m)
            b[equal] = np.minimum(b[equal] + (len(COVER) << k), m)
        at = np.r_[self.places, self.n]
        common += self._agree(at[a], at[b], np.full(len(a), CYCLE))
        del self.levels
        self.minima = [common]
        while 2 << (len(self.minima) - 1) <= len(common):
            last, half = self.minima[-1], 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words in common from each ``a`` and ``b`` on; the two places must differ."""
        ahead = (SYNC[(b - a) % CYCLE] - a) % CYCLE
        same = self._agree(a, b, ahead)
        far = np.flatnonzero((same == ahead) & (np.maximum(a, b) + ahead < self.n))
        if len(far):
            x, y = self._rank_at((a + ahead)[far]), self._rank_at((b + ahead)[far])
            lo, hi = np.minimum(x, y), np.maximum(x, y)
            k = np.frexp(hi - lo)[1] - 1
            for size in np.unique(k):
                of = np.flatnonzero(k == size)
                table = self.minima[size]
                same[far[of]] += np.minimum(table[lo[of]], table[hi[of] - (1 << size)])
        return same

    def _rank_at(self, place: np.ndarray) -> np.ndarray:
        return self.rank[place // CYCLE * len(COVER) + PLACE[place % CYCLE]]


def grid_pairs(ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of equal words a period apart, at multiples of the period, in blocks.

    A run of period p agrees with itself, p further on, over at least p and LEAST - p words, so
    over six or more; three of those lie on one side of the grid place.
    """
    n = len(ids)
    periods = np.arange(1, n // 2 + 1)
    counts = -(-(n - periods) // periods)
    ends = np.cumsum(counts)
    padded = np.r_[np.full(3, -1), ids, np.full(3, -2)]
    first = 0
    while first < len(periods):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        own = counts[first:last]
        p = np.repeat(periods[first:last], own)
        starts = np.repeat(np.cumsum(own) - own, own)
        at = (np.arange(len(p)) - starts) * p
        hit = np.flatnonzero(ids[at] == ids[at + p])
        at, p = at[hit], p[hit]
        x = at + 3
        y = x + p
        right = (padded[x + 1] == padded[y + 1]) & (padded[x + 2] == padded[y + 2])
        left = (
            (padded[x - 1] == padded[y - 1])
            & (padded[x - 2] == padded[y - 2])
            & (padded[x - 3] == padded[y - 3])
        )
        near = right | left
        yield at[near], p[near]
        first = last


class RunFinder:
    """Runs among ``ids``, which may hold several texts parted by numbers met once."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        ids = np.unique(ids, return_inverse=True)[1]
        self.forward, self.backward = Extensions(ids), Extensions(ids[::-1])

    def runs(self, at: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, period) of the stretches that hold a grid pair and are long enough."""
        end = at + p + self.forward(at, at + p)
        start = at - self._before(at, at + p)
        keep = end - start >= np.maximum(LEAST, 2 * p)
        return start[keep], end[keep], p[keep]

    def _before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        inner = np.flatnonzero(a > 0)
        out[inner] = self.backward(self.n - a[inner], self.n - b[inner])
        return out


def distinct_runs(start, end, period):
    """One run per stretch, of its smallest period, by start, then period."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) != 0) | (np.diff(end) != 0)
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


Runs = tuple[np.ndarray, np.ndarray, np.ndarray]
NO_RUNS: Runs = tuple(np.empty(0, np.int64) for _ in range(3))


def dense_runs(ids: np.ndarray) -> Runs:
    """Runs of a text of very many grid pairs: they are settled block by block."""
    finder, found = RunFinder(ids), NO_RUNS
    for at, p in grid_pairs(ids):
        more = finder.runs(at, p)
        found = distinct_runs(*(np.concatenate(x) for x in zip(found, more, strict=True)))
    return found


def runs_of_texts(texts: list[np.ndarray]) -> list[Runs]:
    """Runs of each text of word numbers. Short texts with grid pairs share one index."""
    out: list[Runs] = [NO_RUNS] * len(texts)
    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []

    def settle() -> None:
        if not waiting:
            return
        gap = max(int(texts[k].max()) for k, _, _ in waiting) + 1
        parts, offsets, total = [], [], 0
        for number, (k, _, _) in enumerate(waiting):
            offsets.append(total)
            parts += [texts[k], np.array([gap + number])]
            total += len(texts[k]) + 1
        at = np.concatenate([a + o for (_, a, _), o in zip(waiting, offsets, strict=True)])
        p = np.concatenate([p for _, _, p in waiting])
        start, end, period = RunFinder(np.concatenate(parts)).runs(at, p)
        start, end, period = distinct_runs(start, end, period)
        cuts = np.searchsorted(start, [*offsets, total])
        for (k, _, _), o, a, b in zip(waiting, offsets, cuts, cuts[1:], strict=False):
            out[k] = (start[a:b] - o, end[a:b] - o, period[a:b])
        waiting.clear()

    words = pairs = 0
    for k, ids in enumerate(texts):
        if len(ids) < LEAST:
            continue
        blocks, held = [], 0
        for at, p in grid_pairs(ids):
            blocks.append((at, p))
            held += len(at)
            if held > PAIRS:
                break
        if held > PAIRS:
            out[k] = dense_runs(ids)
        elif held:
            waiting.append((k, *(np.concatenate(x) for x in zip(*blocks, strict=True))))
            words, pairs = words + len(ids), pairs + held
            if words > SHARED_WORDS or pairs > PAIRS:
                settle()
                words = pairs = 0
    settle()
    return out


class WordNumbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, whose tail repeats itself in a tenth of the documents, told by their id."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or not n or h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a : a + p]
    return words[:a] + (tail * (-(-(n - a) // p)))[: n - a]


def report_row(words: list[bytes], runs: Runs) -> tuple:
    start, end, period = runs
    lines = "".join(
        f"{s},{e - s},{p}\n"
        for s, e, p in zip(start.tolist(), end.tolist(), period.tolist(), strict=True)
    )
    longest = (None,) * 4
    kept = words
    if len(start):
        s, e, p = min(
            zip(start.tolist(), end.tolist(), period.tolist(), strict=True),
            key=lambda run: (run[0] - run[1], run[0], run[2]),
        )
        longest = (s, e - s, p, 1000 * (e - s) // p)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, end, -1)
        stay = np.flatnonzero(np.cumsum(change[:-1]) == 0)
        kept = [words[k] for k in stay.tolist()]
    digests = (lines.encode(), b" ".join(kept))
    return (len(start), *longest, *(hashlib.sha256(x).hexdigest() for x in digests))


REPORT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def texts_in(rows: pa.RecordBatch, known: WordNumbers, plant: bool):
    """Word lists and word numbers of a slice of ``(doc_id, text)``."""
    if len(known) > WORDS_KEPT:
        known.clear()
    words = [(x or "").encode().split() for x in rows[1].to_pylist()]
    if plant:
        words = [planted(w, i) for w, i in zip(words, rows[0].to_pylist(), strict=True)]
    return words, [np.fromiter(map(known.__getitem__, w), np.int64, len(w)) for w in words]


def report_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordNumbers()
    for rows in slices(batches):
        words, numbers = texts_in(rows, known, plant=True)
        found = map(report_row, words, runs_of_texts(numbers))
        columns = zip(*found, strict=True)
        types = [pa.int64()] * 5 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [rows[0], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
            names=[field.split()[0] for field in REPORT.split(", ")],
        )


def run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordNumbers()
    names = ["doc_id", "start", "length", "period"]
    for rows in slices(batches):
        _, numbers = texts_in(rows, known, plant=False)
        for doc_id, (start, end, period) in zip(rows[0], runs_of_texts(numbers), strict=True):
            if len(start):
                ids = pa.array([doc_id.as_py()] * len(start), pa.int64())
                columns = [ids, *map(pa.array, (start, end - start, period))]
                yield pa.RecordBatch.from_arrays(columns, names=names)


def _source(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text")


def runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, start, length, period)`` of every run of the texts as they are."""
    return map_arrow(
        _source(docs), run_rows, "doc_id long, start long, length long, period long"
    )


def run_report(docs: DataFrame) -> DataFrame:
    """One row per document: its runs, the longest one, and the text without the repeats.

    The tail of a tenth of the texts is made periodic first, told by the id (see
    :func:`planted`); a null id changes nothing. Null, empty and blank texts have no words, no
    runs and the digest of the empty text. Each row is judged by its own text, so repeated rows
    give repeated results; other columns are not looked at. A document is worked on as a
    whole, in memory that grows with its own words.
    """
    return map_arrow(_source(docs), report_rows, REPORT)
