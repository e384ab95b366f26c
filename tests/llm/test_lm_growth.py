import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard

from tidemark.llm import lm_score


def expected_score(words, texts):
    """Score of ``words`` by plain dictionaries over all n-grams seen twice or more."""
    grams, texts = Counter(), [["\n", "\n", *x.split(), "\n"] for x in texts]
    for t in texts:
        grams.update((t[i],) for i in range(2, len(t)))
        grams.update(tuple(t[i - k : i + 1]) for i in range(2, len(t)) for k in (1, 2))
    tokens = sum(n for g, n in grams.items() if len(g) == 1)
    once = max(1, sum(n == 1 for g, n in grams.items() if len(g) == 1))
    arcs = {g: n for g, n in grams.items() if len(g) > 1 and n > 1}
    t, out = ["\n", "\n", *words, "\n"], 0.0
    for i in range(2, len(t)):
        chance = (grams[(t[i],)] or once) / (tokens + once)
        for k in (1, 2):
            state = tuple(t[i - k : i])
            own = [n for g, n in arcs.items() if g[:-1] == state]
            seen = len(texts) if state == ("\n", "\n") else grams[state]
            total = max(seen, sum(own)) + len(own)
            if own:
                chance = arcs.get((*state, t[i]), 0) / total + (1 - sum(own) / total) * chance
        out += math.log10(chance)
    return out


def check(spark, texts, asked):
    schema = "doc_id long, text string"
    training = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], schema)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(asked)], schema)
    for r in lm_score.score(docs, training).collect():
        assert math.isclose(r.score, expected_score(asked[r.doc_id].split(), texts), rel_tol=1e-9)


def test_ngrams_of_rare_words_are_arcs(spark):
    """Words far down the ranks have arcs too, whatever the size of the corpus."""
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 3000, 40)) for _ in range(300)]
    texts += ["zyx wvu tsr qpo"] * 2
    check(spark, texts, [*texts[:3], "zyx wvu tsr qpo", "", "zyx unheard wvu", "w1 zyx wvu w2"])


def test_ngrams_as_seldom_as_ever_in_a_larger_corpus(spark, monkeypatch):
    """The cut is a count, no share of all tokens: an n-gram seen twice among 3 million."""
    seldom = ["uno due tre"] * 2
    many = [" ".join(["a b c d e f g h"] * 12500)] * 30
    schema = "doc_id long, text string"
    found = []
    for texts in (seldom + many[:1], seldom + many):
        training = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], schema)
        (row,) = lm_score.score(training.limit(1), training).collect()
        found.append(row.score)
    # All three words and the end after the first are arcs: only the first word is rarer.
    assert found[1] - found[0] > -1.2


def test_texts_begin_in_a_state_of_their_own(spark):
    """Without empty texts the two ends before a text are no bigram, with few words the last one."""
    check(spark, ["a b", "a c", "b a"], ["a b", "c", "b b a"])
    check(spark, ["a a a b b b"] * 2, ["a b", "", "b a"])
    check(spark, ["a b", "", "", "a"], ["a b", "", "b"])


def test_states_of_the_model_in_one_place_sum_to_one():
    rng = np.random.default_rng(0)
    texts = [[b"w%d" % k for k in rng.integers(0, 9, 12)] for _ in range(60)]
    hot = {lm_score.word_key(b"w%d" % k): k for k in range(9)} | {lm_score.word_key(b"\n"): 9}
    _, symbols, begins, sizes = lm_score.laid_out(texts, lm_score.Places(hot), lm_score.HOT_WORDS)
    arcs = [np.unique(x, return_counts=True) for x in lm_score.pairs_and_triples(symbols, begins, sizes)]
    arcs = [(k[n > 1], n[n > 1]) for k, n in arcs]
    own = np.concatenate([symbols[a : a + n] for a, n in zip(begins, sizes, strict=True)])
    made = lm_score.Automaton(np.bincount(own), 0, 3, *arcs, ends=(9, len(texts)))
    every = np.arange(lm_score.HOT_WORDS + 1)
    for a, b in [(9, 9), *((a, b) for a in range(10) for b in range(9))]:
        three = np.stack([np.full(len(every), a), np.full(len(every), b), every], axis=1)
        log = made.read(three.ravel())[2::3]
        assert abs((10.0 ** log[np.isfinite(log)]).sum() - 1) < 1e-9


def test_data_dealt_stays_near_the_size_of_the_texts(spark, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"word{k}" for k in rng.zipf(1.3, 600) % 20000) for _ in range(300)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    made, plain = [], lm_score.map_arrow

    def recorded(df, work, schema):
        made.append(plain(df, work, schema))
        return made[-1]

    monkeypatch.setattr(lm_score, "map_arrow", recorded)
    assert lm_score.held_out_scores(docs).count() == len(texts)
    dealt = [x.selectExpr("sum(length(data))").head()[0] for x in made if "data" in x.columns]
    assert sum(dealt) < 2 * sum(map(len, texts))


def test_words_named_by_hashes_and_spread_over_buckets(spark, monkeypatch):
    """Few named words, many chunks and buckets; the most frequent word's bigrams are in several."""
    monkeypatch.setattr(lm_score, "STEP", 300)
    monkeypatch.setattr(lm_score, "NAMED_WORDS", 5)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.5, 30) % 40) for _ in range(60)]
    check(spark, [*texts, "", "", "w1"], [*texts[:5], "", " w1\t\v", "w1 w1 w2 unheard", "unheard w1 w2 w1"])


def test_what_a_chunk_deals_is_its_trigrams_once():
    """Bigrams are sums over the trigrams they begin, and names take three bytes at most."""
    rng = np.random.default_rng(4)
    words = [b"word%d" % k for k in range(60_000)]
    text = b" ".join(words[k] for k in rng.zipf(1.2, 200_000) % len(words)).decode()
    schema = pa.schema({"doc_id": pa.int64(), "trained": pa.bool_(), "asked": pa.bool_(), "text": pa.string()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_batch(pa.RecordBatch.from_arrays([[1], [True], [True], pa.array([text])], schema=schema))
    texts = lm_score.Texts(zstandard.compress(sink.getvalue()))
    hot = pd.Index(lm_score.word_keys(words))
    found = lm_score.Grams(texts, hot, np.full(len(words), 1), 50)
    shares = dict(lm_score.shares([found.dealt(found.counts(texts.trained))]))
    own = text.encode().split()
    assert sum(len(lm_score.keys_of(x)[1]) for x in shares.values()) == len({*zip(own, own[1:], strict=False)}) + 3
    assert sum(map(len, shares.values())) < 4 * len(own)


def test_a_quarter_of_a_byte_is_dealt_for_a_character(spark, monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"word{k}" for k in rng.zipf(1.3, 3000) % 200_000) for _ in range(400)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(2)
    made, plain = [], lm_score.map_arrow

    def recorded(df, work, schema):
        made.append(plain(df, work, schema))
        return made[-1]

    monkeypatch.setattr(lm_score, "map_arrow", recorded)
    assert lm_score.held_out_scores(docs).count() == len(texts)
    (grams,) = [x for x in made if {"asked", "bucket"} <= {*x.columns}]
    dealt = grams.selectExpr("sum(length(data))").head()[0]
    assert dealt < 0.26 * sum(map(len, texts))


def test_a_chunk_of_pieces_deals_one_row_a_bucket(monkeypatch):
    """Rows are those of chunks, not of their pieces, and each piece gets its own answers."""

    class Task:
        partitionId = staticmethod(lambda: 3)  # noqa: N815
        get = classmethod(lambda cls: cls)

    class Named:
        pass

    for name, value in {"TaskContext": Task, "STEP": 200, "ROWS": 1, "HELD": 100}.items():
        monkeypatch.setattr(lm_score, name, value)
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.4, rng.integers(0, 40)) % 60) for _ in range(90)] + ["", "w1"]
    yes, names = [True] * len(texts), ["doc_id", "trained", "asked", "text"]
    rows = pa.RecordBatch.from_arrays([pa.array(x) for x in (range(len(texts)), yes, yes, texts)], names=names)
    chunks = pa.Table.from_batches(lm_score.chunker([rows]))
    pieces = sum(len([*lm_score.pieces_of(x.as_py())]) for x in chunks["data"])
    assert 2 * lm_score.PIECES < pieces <= lm_score.PIECES * len(chunks)
    words = lm_score.word_counter(chunks.select(["data"]).to_batches())
    word, n = lm_score.added([np.stack([x.to_numpy() for x in part.columns]) for part in words], 1)
    few, buckets = np.argsort(-n)[:9], 5
    Named.value = word[few], np.minimum(buckets, 1 + n[few] * buckets // n.sum())
    grams = [*lm_score.asker(Named, buckets)(chunks.select(["chunk", "asked", "data"]).to_batches())]
    grams = pa.Table.from_batches(grams).sort_by("bucket")
    assert len(grams) <= buckets * len(chunks)
    answers = pa.Table.from_batches(lm_score.answerer(grams.to_batches()))
    own = chunks.select(["chunk", "data"]).add_column(1, "bucket", pa.nulls(len(chunks), pa.int32()))
    both = pa.concat_tables([own, answers]).sort_by("chunk").combine_chunks()
    score = lm_score.scorer(Named, buckets, int(n.sum()), len(n), max(1, int((n == 1).sum())))
    found = pa.Table.from_batches(score(both.to_batches())).to_pydict()
    assert found["doc_id"] == [*range(len(texts))]
    for k, value in enumerate(found["score"]):
        assert math.isclose(value, expected_score(texts[k].split(), texts), rel_tol=1e-9)
