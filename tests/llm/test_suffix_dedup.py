import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np

from tests.llm.helpers import no_docs, odd_docs
from tidemark.llm import suffix_dedup as dedup
from tidemark.llm.text import bit_filter


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    times = Counter(b[p : p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = set()
        for p in range(len(b) - length + 1):
            if times[b[p : p + length]] > 1:
                gone.update(range(p, p + length))
        spans = sum(p - 1 not in gone for p in gone)
        kept = bytes(x for p, x in enumerate(b) if p not in gone)
        out.append((len(b), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdefghé ") for _ in range(n)) for n in (39, 40, 41, 55, 80, 200)]
    out = []
    for _ in range(60):
        parts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(120)))]
        for _ in range(rng.randrange(4)):
            cut = rng.choice(passages)
            parts += [cut[rng.randrange(10) :], "".join(rng.choice("xyz") for _ in range(rng.randrange(60)))]
        out.append("".join(parts))
    return out + ["a" * 300, "ab" * 100, "z" * 40, "z" * 39]


def test_equals_brute_force_over_many_buckets(spark):
    rows = list(enumerate(texts(5)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    expected = dict(zip(range(len(rows)), brute([t for _, t in rows], 40), strict=True))
    for parts in ("1", "31"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            found = dedup.repeated_spans(docs, length=40, reach=20).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert {r[0]: tuple(r[1:5]) for r in found} == expected


def test_odd_rows(spark):
    docs = odd_docs(spark, [(7, "q" * 1000), (8, "Ünï" * 200), (8, "Ünï" * 200)])
    rows = docs.select("doc_id", "text").collect()
    found = dedup.repeated_spans(docs).collect()
    expected = brute([r.text for r in rows], 400)
    key = lambda r: (r[0] is None, r)
    assert sorted(((r[0] or 0, *r[1:5]) for r in found), key=key) == sorted(
        ((r.doc_id or 0, *e) for r, e in zip(rows, expected, strict=True)), key=key
    )
    assert dedup.repeated_spans(no_docs(spark)).count() == 0


def test_multikey_order_is_lexicographic():
    words = np.random.default_rng(2).integers(0, 3, (500, 6)).astype(np.uint64)
    order = dedup.multikey_order(words)
    assert [tuple(x) for x in words[order]] == sorted(map(tuple, words))


def test_filter_reaches_the_driver_packed(spark):
    """A row and two numbers for each word of the filter were hundreds of megabytes of the driver."""
    n, bits = 400_000, dedup.KEY_BITS
    at = np.unique(np.arange(n) * 167 % bits)
    tracemalloc.start()
    try:
        found = bit_filter(spark.range(n).selectExpr(f"id * 167 % {bits} as bit"), "bit", bits)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    expected = np.zeros(bits // 32, np.uint32)
    np.bitwise_or.at(expected, at >> 5, np.uint32(1) << (at & 31).astype(np.uint32))
    assert (found == expected).all()
    assert peak < bits // 8 + (16 << 20)


def test_filter_of_nothing(spark):
    assert not bit_filter(spark.range(0), "id", 1 << 10).any()
