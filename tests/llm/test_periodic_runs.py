import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import no_docs, odd_docs
from tidemark.llm import periodic_runs as pr


def brute(w):
    """Runs by trying every start and period; the smallest period of each stretch counts."""
    n, found = len(w), {}
    for p in range(1, n // 2 + 1):
        k = 0
        while k + p < n:
            if w[k] != w[k + p]:
                k += 1
                continue
            start = k
            while k + p < n and w[k] == w[k + p]:
                k += 1
            end = k + p
            if end - start >= max(12, 2 * p):
                found.setdefault((start, end), p)
    return sorted((s, p, e) for (s, e), p in found.items())


def brute_row(doc_id, text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    dropped = {k for s, p, e in runs for k in range(s + p, e)}
    lines = "".join(f"{s},{e - s},{p}\n" for s, p, e in runs)
    kept = b" ".join(x for k, x in enumerate(w) if k not in dropped)
    best = min(runs, key=lambda r: (r[0] - r[2], r[0], r[1]), default=None)
    longest = (None,) * 4
    if best:
        s, p, e = best
        longest = (s, e - s, p, 1000 * (e - s) // p)
    digests = [hashlib.sha256(x).hexdigest() for x in (lines.encode(), kept)]
    return (doc_id, len(runs), *longest, *digests)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def numbers(words):
    kinds = {}
    return np.array([kinds.setdefault(x, len(kinds)) for x in words], np.int64)


def own(words):
    start, end, period = pr.runs_of_texts([numbers(words)])[0]
    return list(zip(start.tolist(), period.tolist(), end.tolist(), strict=True))


pieces = st.lists(
    st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=8
)


@settings(max_examples=300, deadline=None)
@given(pieces)
def test_runs_of_repeated_pieces(parts):
    words = [x for piece, times in parts for x in piece * times]
    assert own(words) == brute(words)


def test_runs_of_special_words():
    fib = ["a", "ab"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    rng = random.Random(1)
    noise = [rng.randrange(3) for _ in range(1500)]
    tail = [rng.randrange(9000) for _ in range(400)]
    for words in (fib[-1], "a" * 500, "a" * 11, "ab" * 6, "ab" * 6 + "a", noise, tail * 3 + tail[:77],
                  tail + noise + tail, [0] * 12 + [1] * 12 + [0] * 12, [7]):
        assert own(words) == brute(words)


def test_extensions_equal_plain_comparison():
    rng = np.random.default_rng(4)
    for kinds, n in ((1, 40), (2, 300), (3, 1000), (400, 700), (1, 13)):
        ids = rng.integers(0, kinds, n)
        ids[n // 2 :] = ids[: n - n // 2]
        a, b = rng.integers(0, n, 500), rng.integers(0, n, 500)
        a, b = a[a != b], b[a != b]
        same = []
        for x, y in zip(a, b, strict=True):
            k = 0
            while max(x, y) + k < n and ids[x + k] == ids[y + k]:
                k += 1
            same.append(k)
        assert pr.Extensions(ids)(a, b).tolist() == same


def test_blocks_of_pairs_and_shared_indexes(monkeypatch):
    rng = random.Random(8)
    texts = []
    for _ in range(60):
        piece = [rng.randrange(6) for _ in range(rng.randrange(1, 30))]
        noise = [rng.randrange(4) for _ in range(rng.randrange(60))]
        texts.append(noise + piece * rng.randrange(1, 7) + noise)
    whole = pr.runs_of_texts(list(map(numbers, texts)))
    monkeypatch.setattr(pr, "PAIRS", 50)
    monkeypatch.setattr(pr, "SHARED_WORDS", 300)
    split = pr.runs_of_texts(list(map(numbers, texts)))
    for text, a, b in zip(texts, whole, split, strict=True):
        assert [x.tolist() for x in a] == [x.tolist() for x in b]
        s, e, p = (x.tolist() for x in a)
        assert list(zip(s, p, e, strict=True)) == brute(text)


def test_report_equals_brute_force(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    expected = sorted((brute_row(*r) for r in rows), key=repr)
    assert rows_of(pr.run_report(docs)) == expected
    assert sum(r[1] > 0 for r in expected) > len(rows) // 15


def test_odd_rows_and_no_rows(spark):
    extra = [(k, " ".join(f"w{i % q}" for i in range(60 + k))) for k, q in ((90, 7), (91, 60), (92, 1))]
    docs = odd_docs(spark, extra).where("doc_id IS NULL OR doc_id <> 5")
    expected = sorted((brute_row(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert rows_of(pr.run_report(docs)) == expected
    assert pr.run_report(odd_docs(spark).where("doc_id = 5")).head().n_runs == 0
    long = [(1, " ".join(f"v{i % 977}" for i in range(40_000)))]
    long = pr.runs(spark.createDataFrame(long, "doc_id long, text string"))
    assert rows_of(long) == [(1, 0, 40_000, 977)]
    assert pr.run_report(no_docs(spark)).count() == 0
    listed = rows_of(pr.runs(spark.createDataFrame(extra, "doc_id long, text string")))
    assert [r[0] for r in listed] == [90, 91, 92] and listed[0][1:] == (0, 150, 7)


def test_one_word_many_times(spark):
    words = ["same"] * 300_000
    assert own(words) == [(0, 1, 300_000)]
