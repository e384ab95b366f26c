import numpy as np

from tests.llm.helpers import no_docs, odd_docs
from tidemark.llm import toxicity as tox

LABELS = "doc_id long, quality int, toxic int"


def area(score, label):
    """Chance that a text of label 1 scores above one of label 0; ties count half."""
    one, zero = np.sort(score[label == 1]), np.sort(score[label == 0])
    return (np.searchsorted(zero, one) + np.searchsorted(zero, one, "right")).mean() / 2 / len(zero)


def tables(spark, sf):
    return [spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels")]


def test_held_out_labels(spark):
    docs, labels = tables(spark, "sf0.1")
    out = tox.toxicity(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(labels, "doc_id").where("held_out").toPandas()
    score, label = rows["score"].to_numpy(), rows["toxic"].to_numpy()
    assert len(rows) > 800
    # Some toxic labels of these tables lie on texts without any sign of it.
    assert area(score, label) > 0.93
    assert (rows["predicted"] == (score >= 0.3)).all()
    assert rows["predicted"][label == 1].mean() > 0.8
    assert rows["predicted"][label == 0].mean() < 0.05


def test_labels_and_names_are_no_inputs(spark):
    docs, labels = tables(spark, "sf0.01")
    score = {r.doc_id: r.score for r in tox.toxicity(docs, labels).collect()}
    other = docs.selectExpr("doc_id", "text", "'x' AS lang", "'y' AS source")
    changed = labels.selectExpr(
        "doc_id", "1 - quality AS quality",
        "if(crc32(cast(doc_id AS string)) % 4 = 2, 1 - toxic, toxic) AS toxic",
    )
    assert {r.doc_id: r.score for r in tox.toxicity(other, changed).collect()} == score


def corpus(spark, copies=0):
    """Toxic texts hold one of two words; a text of one group of copies has words of its own."""
    rng = np.random.default_rng(2)
    plain = ["".join(rng.choice(list("aeioulnrst"), 5)) for _ in range(300)]
    rows, labels = [], []
    for k in range(600):
        own = rng.choice(plain, 120).tolist()
        if k % 3 == 0:
            for place in rng.integers(0, 120, 4):
                own[place] = rng.choice(["zquxxy", "vkwoj"])
        rows.append((k, " ".join(own)))
        labels.append((k, 1, int(k % 3 == 0)))
    odd = " ".join("".join(rng.choice(list("bcdfg"), 7)) for _ in range(80))
    for k in range(copies):
        rows.append((10_000 + k, f"{odd} {k}"))
        labels.append((10_000 + k, 1, 1))
    return rows, labels


def test_words_of_a_class_are_learned_and_copies_count_once(spark):
    rows, labels = corpus(spark, copies=300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = tox.toxicity(docs, spark.createDataFrame(labels, LABELS)).where("held_out").collect()
    own = [r for r in held if r.doc_id < 600]
    right = sum(r.predicted == (r.doc_id % 3 == 0) for r in own)
    assert right > 0.97 * len(own)
    texts = [tox.normal(t) for _, t in rows]
    assert 600 <= len(tox.first_of_near_copies(texts)) <= 630


def test_dictionaries_hold_what_parts_the_classes(spark):
    rows, _ = corpus(spark)
    texts = [tox.normal(t) for _, t in rows]
    toxic, ordinary = tox.train_dictionaries(texts[::3], texts[1::3] + texts[2::3])
    assert b"zquxxy" in toxic and b"vkwoj" in toxic
    assert b"zquxxy" not in ordinary and b"vkwoj" not in ordinary
    assert len(toxic) <= tox.OWN_BYTES + tox.SHARED_BYTES
    compare = tox.Comparer(toxic, ordinary)
    plain = texts[1]
    assert compare.features(plain + b" zquxxy vkwoj")[0] > compare.features(plain)[0]
    same = tox.Comparer(ordinary, ordinary)
    assert same.features(plain)[0] == 0


def test_windows_cover_the_whole_text():
    for text in ("", "  ", "one", "x" * 500, "é" * 300, "a b " * 1000, "Wort " + "y" * 64 + " z"):
        whole = tox.normal(text)
        parts = tox.CUT.findall(whole)
        assert b"".join(parts) == whole and all(len(p) <= tox.WINDOW for p in parts)


def test_odd_rows_and_missing_classes(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], LABELS)
    assert {(r.score, r.predicted) for r in tox.toxicity(docs, none).collect()} == {(0.0, 0)}
    one = spark.createDataFrame([(4, 1, 1), (None, 1, 1), (6, 1, None)], LABELS)
    assert {(r.score, r.predicted) for r in tox.toxicity(docs, one).collect()} == {(1.0, 1)}
    assert tox.toxicity(no_docs(spark), one).count() == 0

    rows, labels = corpus(spark)
    extra = [(k + 100, text) for k, text in rows]
    more = [(k + 100, q, t) for k, q, t in labels] + [(101, None, None), (6, 1, 7)]
    out = tox.toxicity(odd_docs(spark, extra), spark.createDataFrame(more, LABELS)).collect()
    assert len(out) == len(rows) + docs.count()
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    empty = {r.score for r in out if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1
