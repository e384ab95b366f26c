import itertools
import random
import re
from collections import Counter

from tests.llm.helpers import no_docs, odd_docs
from tidemark.llm import filter_audit as fa

NO_LABELS = "doc_id long, quality int, toxic int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def brute(docs, labels):
    """Rows by applying each order to each document, one filter after another."""
    smallest = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    parts = {}
    for doc_id, text, lang in docs:
        t = text or ""
        w = words(t)
        failed = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": doc_id is not None and doc_id > smallest[t],
        }
        mask = frozenset(k for k, f in failed.items() if f)
        parts.setdefault(lang or "", []).append((mask, doc_id in good, doc_id in toxic))
    rows = []
    for part, members in parts.items():
        removed, out = Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, name in enumerate(order, 1):
                gone = [m for m in left if name in m[0]]
                left = [m for m in left if name not in m[0]]
                removed[name] += len(gone)
                fails = sum(name in m[0] for m in members)
                out.append(
                    (
                        part, "".join(order), step, len(left), len(gone), fails - len(gone),
                        sum(m[0] == {name} for m in members),
                        sum(m[1] for m in gone), sum(m[2] for m in gone),
                    )
                )
        rows += [(*row, removed[row[1][row[2] - 1]]) for row in out]
    return sorted(rows)


def found(spark, docs, labels):
    out = fa.audit(docs, spark.createDataFrame(labels, NO_LABELS))
    assert [f"{n} {t}".replace("bigint", "long") for n, t in out.dtypes] == fa.AUDIT.split(", ")
    return sorted(map(tuple, out.collect()))


def plain(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]


def test_random_documents(spark):
    rng = random.Random(3)
    texts = ["", "AB CD", "x " * 300, "# y"]
    texts += [" ".join(f"w{k * s % 251}" for k in range(n)) for n in (10, 250, 800) for s in (1, 2)]
    texts += ["QED " * 60 + " ".join(f"w{k}" for k in range(220)), "Éa|b " * 5]
    rows = [
        (rng.choice([None, *range(90)]), rng.choice([None, *texts]), rng.choice([None, "", "a", "é"]))
        for _ in range(400)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = [(rng.choice([None, *range(120)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1]))
              for _ in range(90)]
    assert found(spark, docs.repartition(7), labels) == brute(rows, labels)


def test_a_third_of_the_rows_is_one_text_and_one_id(spark):
    rows = [(k, "same text", "en") for k in range(300)] + [(7, f"t{k}", "en") for k in range(300)]
    rows += [(None, "no id", "en")] * 200 + [(k, f"u{k}", "de") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = [(7, 1, 1), (5, 0, 1), (5, 1, None)]
    assert found(spark, docs, labels) == brute(rows, labels)


def test_odd_rows_and_no_rows(spark):
    docs = odd_docs(spark)
    labels = [(4, 1, 0), (None, 1, 1)]
    assert found(spark, docs, labels) == brute(plain(docs), labels)
    assert len(found(spark, docs, [])) == 3 * 600
    assert found(spark, no_docs(spark), labels) == []


def test_exchanges_meet_every_order_once():
    for n in range(1, 6):
        order, seen = list(range(n)), set()
        for swap in [None, *fa.exchanges(n)]:
            if swap is not None:
                order[swap], order[swap + 1] = order[swap + 1], order[swap]
            seen.add(tuple(order))
        assert seen == set(itertools.permutations(range(n)))
        assert len(fa.exchanges(n)) == len(seen) - 1


def test_diagram_of_other_filters_shares_nodes():
    counts = {m: (m.bit_count(), 0, 1) for m in range(16)}
    diagram = fa.Diagram("wxyz", counts)
    assert [len(level) for level in diagram.levels] == [1, 2, 3, 4]
    for swap in fa.exchanges(4):
        diagram.exchange(swap)
        assert [len(level) for level in diagram.levels] == [1, 2, 3, 4]
        assert diagram.weights[0] == [(32, 0, 16)]
