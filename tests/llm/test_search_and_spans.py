import hashlib
import re

import numpy as np
import pytest

from tests.llm.helpers import no_docs, odd_docs
from tidemark.llm import decontaminate, sanitise, vptree


def luhn(digits):
    values = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def digits(value):
    return re.sub("[^0-9]", "", value)


FORMS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda v: all(int(x) <= 255 for x in v.split(".")),
    ),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(digits(v)) <= 19 and luhn(digits(v))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(digits(v)) <= 15),
}


def base_spans(text):
    return ",".join(
        f"{kind}:{m.start()}:{m.end()}"
        for kind, (pattern, test) in FORMS.items()
        for m in re.finditer(pattern, text or "")
        if test(m[0])
    )


TEXTS = [
    "a@b.c_d@e.f x 1.2.3.4.5.6.7.8 é@é.com 999.1.1.1 0001.2.3.4",
    "+1 (706) 555-3138 4644348398010899 4111 1111 1111 1111-1 ..@a.b", "a@b.c.d@e.f.",
    "😀 x@y.zz 😀 +123 456 789 0 .(", "a" * 30_000 + "@", "1.2.3.4.5.6", "5 4111-1111-1111-1111 ",
    "1" * 20_000, "+1" + "-" * 20_000, "x@" + "y." * 9_000 + "z", "4111 1111 1111 1111", "@@ a@b.c@d.e",
]


def test_base_spans_equal_the_forms(spark, small_dir):
    docs = odd_docs(spark, [(100 + k, t) for k, t in enumerate(TEXTS)]).select("doc_id", "text")
    own = spark.read.parquet(f"{small_dir}/documents.parquet").selectExpr("doc_id + 1000", "text")
    docs = docs.union(own)
    expected = sorted(
        (r[0] or -1, hashlib.sha256(base_spans(r[1]).encode()).hexdigest()) for r in docs.collect()
    )
    found = sanitise.report(docs).collect()
    assert sorted((r.doc_id or -1, r.base_sha256) for r in found) == expected
    assert all(r.spans.startswith(base_spans("")) for r in found)
    assert sanitise.report(no_docs(spark)).count() == 0


def disclosing_docs(spark):
    topics = [f"topic{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    texts = [f"Hello from Quillon at q@site.org about {t}" for t in topics[:30]]
    texts += [f"Plain line about a {t} and hello from more" for t in topics]
    texts += ["Copied name Zebulon z@site.org here"] * 8 + ["Later Quillon alone"]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_disclosing_words_are_generalised(spark):
    docs = disclosing_docs(spark)
    assert {r.term for r in sanitise.disclosing_terms(docs.select("text")).collect()} >= {"quillon"}
    out = {r.doc_id: r.text for r in sanitise.sanitised(docs).collect()}
    assert out[98] == "Later [TERM] alone"
    assert "q@site.org" not in out[0] and "Quillon" not in out[0]
    # Copies of a line show nothing, and words that are common anywhere disclose nothing.
    assert out[90] == "Copied name Zebulon [EMAIL] here"
    assert out[40] == docs.where("doc_id = 40").head().text


def test_terms_of_rows_without_an_id_and_of_repeated_ids(spark):
    rows = [(None, "Later Quillon alone"), (5, "Later Quillon alone"), (None, None), (7, "")]
    docs = disclosing_docs(spark).union(spark.createDataFrame(rows, "doc_id long, text string"))
    out = [r.text for r in sanitise.sanitised(docs).collect()]
    assert out.count("Later [TERM] alone") == 3
    assert len(out) == docs.count() and None in out and "" in out


def test_names_joined_to_an_entity_are_terms(spark):
    topics = [f"topic{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    forms = ["{},{}", "{}<{}>", "id\t{}\t{}\tx", "({1}:{0})", "{}/[{}]"]
    names = ["Quillon", "Zebulon", "Yorick", "Xanthe", "Wystan"]
    texts = [
        f"Hello {form.format(name, name[0].lower() + '@site.org')} about {t}"
        for form, name in zip(forms, names, strict=True)
        for t in topics[:30]
    ]
    texts += [f"Plain line about a {t} and hello from id" for t in topics] * 2 + ["Later Quillon alone"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r.term for r in sanitise.disclosing_terms(docs).collect()}
    assert found == {n.lower() for n in names}


def test_names_met_joined_and_apart_count_the_same_way(spark):
    """Copies shift no share: all counts are of distinct shapes and of the same cleaned lines."""
    topics = [f"topic{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    texts = [f"Quillon{', ' if k % 2 else ','}q@site.org on {t}" for k, t in enumerate(topics[:30])]
    texts += [f"Plain line on a {t}" for t in topics] + ["Later Quillon alone"]
    found = []
    for own in (texts, texts + ["One plain line more"] * 500, texts + ["One plain line more"]):
        docs = spark.createDataFrame([(t,) for t in own], "text string")
        found.append({r.term: r.disclosure for r in sanitise.disclosing_terms(docs).collect()})
    assert "quillon" in found[0]
    assert found[1] == found[2]


def test_sanitised_keeps_rows_and_columns(spark):
    docs = odd_docs(spark)
    out = sanitise.sanitised(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    row = out.where("doc_id = 6").head()
    assert row.email == row.term == "own"
    assert row.text == "Mail [EMAIL] or [PHONE], [CARD] and [IP]." and row.n_chars == len(row.text)
    assert out.where("doc_id = 1").head().text is None


def test_personal_data_plan_is_native(spark, capsys):
    sanitise.report(disclosing_docs(spark)).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def item(k, n=30):
    return " ".join(f"item{k}word{j}" for j in range(n))


def test_overlaps_stand_substitutions(spark):
    changed = item(2).split()
    changed[4::7] = ["other"] * len(changed[4::7])
    texts = {
        1: "before " + item(1) + " after", 2: "x " * 50 + " ".join(changed), 3: item(3, 10),
        4: item(1).upper().replace(" ", "!! "), 5: "clean text " * 30, 6: item(7, 6), 7: " ".join(item(7, 6).split()[:5]),
    }
    docs = odd_docs(spark, list(texts.items()))
    docs = docs.where("doc_id is null or doc_id > 6 or source = 's' and lang = 'en' and n_chars = 1").union(docs.limit(4))
    bench = [(1, item(1), "z"), (2, item(2), "z"), (3, item(3), "z"), (9, item(1), "z"), (7, item(7, 6), "z"), (8, None, "z"), (None, item(5), "z"), (11, " ", "z")]
    bench = spark.createDataFrame(bench, "item_id long, text string, doc_id string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.overlaps(docs, bench).collect()}
    assert set(found) == {(1, 1), (2, 2), (4, 1), (6, 7)}
    assert found[1, 1].doc_token == 1 and found[1, 1].n_same == 30
    assert found[2, 2].n_same == 30 - len(changed[4::7])
    kept = decontaminate.without_overlaps(docs, bench)
    assert kept.columns == docs.columns and kept.where("doc_id in (1, 2, 4, 6)").count() <= 1
    assert decontaminate.overlaps(docs, bench.limit(0)).count() == 0
    assert decontaminate.overlaps(no_docs(spark), bench).count() == 0


def vectors(spark, n, width=8, seed=0):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, width))
    rows[n // 2 : n // 2 + n // 4] = rows[3]
    data = [(k, [float(x) for x in r], "y") for k, r in enumerate(rows)]
    odd = [None, [], [0.0] * width, [float("nan")] * width, [1.0, None] * (width // 2), [1.0, 2.0]]
    data += [(n + k, v, None) for k, v in enumerate(odd)] + [(None, [1.0] * width, "y")]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, score string"), rows


def brute_nearest(rows, q, k):
    unit = rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    score = np.round(unit @ unit[q], 12)
    order = [i for i in np.lexsort((np.arange(len(rows)), -score)) if i != q]
    return order[:k], score


def test_factor_one_is_exact(spark):
    table, rows = vectors(spark, 1200)
    found = vptree.nearest(table.repartition(3), factor=1.0, shard=400, query_block=10).collect()
    for q in range(0, 1200, 50):
        own = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        order, score = brute_nearest(rows, q, 5)
        assert [r[1] for r in own] == order
        assert np.allclose([r[2] for r in own], score[order])


@pytest.mark.parametrize("name", ["sf0.01"])
def test_registered_factor_has_recall(spark, name):
    table = spark.read.parquet(f"/root/testdata/{name}/embeddings.parquet")
    rows = np.array([r.embedding for r in table.orderBy("vec_id").collect()], float)
    found = vptree.nearest(table).collect()
    hits = total = 0
    for q in range(0, len(rows), 50):
        order, _ = brute_nearest(rows, q, 5)
        hits += len({r.vec_id for r in found if r.query_id == q} & set(order))
        total += 5
    assert hits >= 0.9 * total


def test_nothing_to_search(spark):
    table, _ = vectors(spark, 8)
    assert vptree.nearest(table.limit(0)).count() == 0
    assert vptree.nearest(table.where("vec_id >= 8")).count() == 0
    assert len(vptree.nearest(table).collect()) == 5
