"""Tables with the odd cases that every operator must stand."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, keep string"


def odd_docs(spark, extra=()):
    """Nulls in every column, empty and blank texts, one long text, repeated rows and ids."""
    long_text = " ".join(f"word{k % 977} and{k % 31}" for k in range(20_000))
    # Some columns are named like those that operators make.
    rows = [
        (1, None, None, None, None, None),
        (2, "", "en", "s", 0, "x"),
        (3, " \t\n", "en", None, 3, "x"),
        (4, "one two three", "en", "s", 13, "x"),
        (4, "one two three", "en", "s", 13, "x"),
        (5, long_text, "en", "s", len(long_text), "x"),
        (None, "no id here at all, none", "en", "s", 20, "x"),
        (6, "Mail a.b@c.de or +49 (30) 123456-78, 4111 1111 1111 1111 and 10.0.0.1.", "de", "s", 9, "x"),
    ]
    rows += [(*r, "en", "s", 1, "x") for r in extra]
    docs = spark.createDataFrame([(*r, "own") for r in rows], DOCS)
    return docs.withColumns({c: docs["keep"] for c in ("email", "term", "parts", "bad_score", "rank")})


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
