import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import no_docs, odd_docs, words
from tidemark.llm import jaccard_join as join
from tidemark.llm.components import components
from tidemark.llm.text import mix


def shingle_set(text):
    own = words(text)
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[k : k + 5]) for k in range(len(own) - 4)}


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets.items(), 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = sorted((top(i), top(j)))
            up[y] = x
    return {i: (len(s), top(i)) for i, s in sets.items()}


def varied_rows(seed, groups=25, copies=12):
    """Groups of copies with more and more changes, with a passage that all texts share."""
    rng = random.Random(seed)
    shared = [f"shared{k}" for k in range(40)]
    rows = []
    for g in range(groups):
        base = [f"w{g}_{rng.randrange(500)}" for _ in range(rng.choice([2, 6, 9, 12, 20, 60, 300]))]
        for c in range(copies):
            text = list(base)
            for _ in range(c // 2):
                text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
            at = rng.randrange(len(text) + 1)
            text[at:at] = shared if g % 3 == 0 else []
            rows.append((len(rows) * 7 % 100003, " ".join(text)))
    return rows


@pytest.mark.parametrize("paired", [6, 1])
def test_components_equal_brute_force(spark, monkeypatch, paired):
    monkeypatch.setattr(join, "PAIRED", paired)
    rows = varied_rows(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r[0]: (r[1], r[2]) for r in join.similar_documents(docs).collect()}
    assert found == brute_components(rows)


def test_odd_rows(spark):
    found = join.similar_documents(odd_docs(spark)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles > 0) for r in found) == [
        (0, True), (1, False), (2, False), (3, False), (4, True), (4, True), (5, True), (6, True)
    ]
    assert all(r.component_id == r.doc_id for r in found)
    assert join.similar_documents(no_docs(spark)).count() == 0


def test_repeated_and_missing_ids(spark):
    """Rows of one id are documents of their own, as are rows without one."""
    first, second = (" ".join(f"{k}{i}" for i in range(40)) for k in "ab")
    other = " ".join(f"c{i}" for i in range(40))
    rows = [(1, first), (1, second), (2, first + " x"), (3, second + " y"), (None, other), (None, other + " z"),
            (None, second + " v"), (None, None), (9, "  "), (None, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(map(tuple, join.similar_documents(docs).collect()), key=repr)
    expected = [(1, 36, 1), (1, 36, 1), (2, 37, 1), (3, 37, 1), (9, 0, 9), (None, 0, None), (None, 1, None),
                (None, 36, None), (None, 37, 1), (None, 37, None)]
    assert found == sorted(expected, key=repr)
    kept = join.first_of_groups(docs.withColumn("__n", F.lit("own")))
    assert kept.columns == ["doc_id", "text", "__n"]
    texts = sorted(r.text or "" for r in kept.collect())
    assert len(texts) == 6 and {"", "  ", "alone here"} <= set(texts)
    assert len({first, second} & set(texts)) == 2 and len({other, other + " z"} & set(texts)) == 1
    again = docs.union(docs)
    assert sorted(r.text or "" for r in join.first_of_groups(again).collect()) == sorted(
        [*texts, "", "  "]
    )


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(1)
    sketch = np.zeros(join.SKETCH, np.int64)
    for n in [*range(4, 40), 63, 64, 65, 127, 200, 641, 1000]:
        for _ in range(10):
            a = mix(rng.integers(1, 1 << 62, n).astype(np.uint64))
            drop = n - -(-4 * n // 5)
            b = a[: n - drop] if n % 2 else np.r_[a[: n - drop // 2], mix(a[: drop // 2 - drop // 4])]
            a, b = np.unique(a), np.unique(b)
            common = len(np.intersect1d(a, b))
            if 100 * common < 80 * (len(a) + len(b) - common):
                continue
            for fine in (frozenset(), frozenset(range(30))):
                thin = [k for s in (a, b) for k, need in join.bands_of(len(s))
                        if len(join.segments(s, k, False)) < need]
                if not fine and thin:
                    continue
                both = set(join.signatures(a, sketch, fine)) & set(join.signatures(b, sketch, fine))
                assert both or (len(a) == len(b) == common), (n, len(a), len(b))


def test_components_of_chains_loops_and_nothing(spark):
    chain = [(k, k + 1) for k in range(200)] + [(500, 501), (501, 501), (None, 3), (501, 500)]
    found = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert found == {k: 0 for k in range(201)} | {500: 500, 501: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("n", [100, 300, 1000])
def test_bitmaps_part_near_copies_and_keep_links(spark, n):
    """Near copies of one text beyond what is allowed are not read; no link is lost."""
    rng = np.random.default_rng(n)
    base = mix(rng.integers(1, 1 << 62, n).astype(np.uint64))
    rows = []
    for share in (0.5, 1.0, 1.7):
        for _ in range(20):
            changed = int(share * (2 * n // 9)) // 4
            a, b = base.copy(), base.copy()
            a[:changed] = mix(rng.integers(1, 1 << 62, changed).astype(np.uint64))
            b[changed : 2 * changed] = mix(rng.integers(1, 1 << 62, changed).astype(np.uint64))
            linked = 9 * len(np.setxor1d(a, b)) <= 2 * n
            rows.append((n, *join.marks(a).tolist(), n, *join.marks(b).tolist(), linked))
    fields = [f"{s}{c}" for s in "xy" for c in ("n", *join.MARKS)]
    docs = spark.createDataFrame(rows, [*fields, "linked"])
    for s in "xy":
        docs = docs.withColumn(s, F.struct(*(F.col(f"{s}{c}").alias(c) for c in ("n", *join.MARKS))))
    found = docs.select("linked", F.expr(join.may_link("x", "y")).alias("met")).collect()
    assert {r.linked for r in found} == {False, True}
    assert all(r.met == r.linked for r in found)
