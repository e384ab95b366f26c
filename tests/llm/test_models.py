import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import no_docs, odd_docs, words
from tidemark.llm import language_id, lm_score, quality


def test_base_scores_and_held_out_gain(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    docs = docs.select("doc_id", "text").union(odd_docs(spark).select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    away = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    seen = Counter()
    for doc, text in rows:
        if not away(doc):
            seen.update([*words(text), b"\n"])
    total, kinds = sum(seen.values()), len(seen)
    expected = Counter()
    for doc, text in rows:
        own = [*words(text), b"\n"]
        base = sum(math.log10((seen[w] + 1) / (total + kinds + 1)) for w in own)
        known = sum(seen[w] > 0 for w in own)
        expected[(doc, away(doc), len(own), known, total, round(base, 4))] += 1
    found = lm_score.held_out_scores(docs).collect()
    got = Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
        for r in found
    )
    assert got == expected
    assert all(r.score < 0 for r in found)


def test_automaton_is_a_distribution():
    """From any two symbols, all symbols together have probability one."""
    rng = np.random.default_rng(0)
    counts = np.sort(rng.integers(2, 90, 400))[::-1]
    hot = {lm_score.word_key(b"w%d" % k): k for k in range(399)} | {lm_score.word_key(b"\n"): 399}
    texts = [[b"w%d" % k for k in rng.integers(0, 420, 30)] for _ in range(200)]
    places = lm_score.Places(hot)
    _, symbols, begins, sizes = lm_score.laid_out(texts, places, lm_score.HOT_WORDS)
    counts = np.bincount(np.concatenate([symbols[a : a + n] for a, n in zip(begins, sizes, strict=True)]))
    arcs = [np.unique(x, return_counts=True) for x in lm_score.pairs_and_triples(symbols, begins, sizes)]
    arcs = [(k[n > 1], n[n > 1]) for k, n in arcs]
    made = lm_score.Automaton(counts[:400], int(counts[400:].sum()), 7, *arcs)
    every = np.arange(lm_score.HOT_WORDS + 1)
    contexts = [*zip(rng.integers(0, 420, 40), rng.integers(0, 420, 40), strict=True)]
    contexts += [(k >> 20, (k >> 10) & 1023) for k in arcs[1][0][:20].tolist()]
    for a, b in contexts:
        three = np.stack([np.full(len(every), a), np.full(len(every), b), every], axis=1)
        log = made.read(three.ravel())[2::3]
        assert abs((10.0**log[np.isfinite(log)]).sum() - 1) < 1e-9


def test_scores_gain_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = lm_score.held_out_scores(docs).where("held_out").collect()
    assert sum(r.score for r in found) > 0.97 * sum(r.base_score for r in found)
    assert np.mean([r.score > r.base_score for r in found]) > 0.9


@pytest.mark.parametrize("docs", [no_docs])
def test_scores_of_nothing(spark, docs):
    assert lm_score.held_out_scores(docs(spark)).count() == 0
    assert language_id.identify(docs(spark)).count() == 0


def test_languages_of_held_out_texts(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    found = language_id.identify(docs).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in found) >= 0.97 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_rows(spark):
    docs = odd_docs(spark, [(9, "123 456 ..."), (10, "日本")])
    found = language_id.identify(docs).collect()
    assert len(found) == docs.count()
    und = {r.doc_id for r in found if r.lang_pred == "und"}
    assert und == {1, 2, 3, 9}
    assert all(r.score == 0 for r in found if r.lang_pred == "und")


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 8, 40):
        code = language_id.codewords(n)
        apart = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
        assert min(apart) >= (1 if n == 2 else 2 if n == 3 else 4)


def test_quality_of_given_labels(spark, small_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality.judged(docs, labels).join(labels, "doc_id").collect()
    good = [r.keep for r in found if r.quality == 1 and r.toxic == 0]
    bad = [r.keep for r in found if r.quality == 0 or r.toxic == 1]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.2


def test_quality_of_odd_rows(spark):
    labels = "doc_id long, quality int, toxic int"
    given = spark.createDataFrame([(4, 1, 0), (None, 0, 0), (2, None, None), (4, 1, 0)], labels)
    docs = odd_docs(spark, [(k, "BUY!! NOW!! CHEAP!! ONLY!! HERE!! TODAY!!") for k in range(20, 40)])
    for own in (given, None, given.limit(0)):
        found = quality.kept(docs, own)
        assert found.columns == docs.columns
        assert {4, 5} <= {r.doc_id for r in found.collect()}
        assert {r.keep for r in found.collect()} == {"own"}
        assert quality.judged(docs, own).count() == docs.count()
    assert quality.judged(no_docs(spark), given).count() == 0


@pytest.mark.parametrize("given", [[], [(4, 1, 0)], [(101, 1, 1), (102, 0, 0)]])
def test_quality_of_sparse_and_one_sided_labels(spark, given):
    """What the labellers accuse trains the scorer, whichever documents have a given label."""
    plain = [f"The river {k} runs past quiet fields and a mill near town {k + 1}" for k in range(60)]
    junk = [f"BUY!! NOW!! CHEAP!! ONLY!! HERE!! TODAY!! DEAL{k}!!" for k in range(30)]
    rows = [*enumerate(plain), *((100 + k, t) for k, t in enumerate(junk))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
    keep = {r.doc_id for r in quality.judged(docs, labels).where("keep").collect()}
    assert keep == set(range(60))


def test_estimate_trusts_agreeing_labellers():
    rng = np.random.default_rng(0)
    truth = rng.random(5000) < 0.3
    right = (0.9, 0.85, 0.8, 0.55, 0.75, 0.8, 0.9)
    said = np.stack([np.where(rng.random(5000) < p, truth, ~truth) for p in right])
    # The last labeller, given labels, is observed and not estimated; here it is silent.
    heard = np.where(said, quality.WRONG, quality.GOOD)[:6]
    votes = (heard << (2 * np.arange(6))[:, None]).sum(axis=0)
    patterns, at, counts = np.unique(votes, return_inverse=True, return_counts=True)
    bad = quality.estimate(patterns, counts.astype(float))[at] > 0.5
    assert (bad == truth).mean() > 0.95
