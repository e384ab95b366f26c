"""Cleansing and rule truth tables, one row per branch and quirk."""

import hashlib

from tidemark.functions import cleansing as c
from tidemark.functions import rules as r
from tidemark.operators.intake import judge_contacts, judge_logins, judge_signups, signup_texts
from tidemark.schemas import CONTACT_FIELDS, SIGNUP_FIELDS

GOOD = {
    "ftname": "Ann", "ltname": "Lee", "email": "Ann@Example.com", "Phonenumber": "0123456789",
    "address": "1 Road", "state": "Kerala", "spassword": "Passw0rd!", "conpassword": "Passw0rd!",
}


def judge(spark, changes, members=None, **options):
    rows = [(i, *({**GOOD, **ch}[f] for f in SIGNUP_FIELDS)) for i, ch in enumerate(changes)]
    schema = "submission_id long, " + ", ".join(f"{f} string" for f in SIGNUP_FIELDS)
    judged = judge_signups(spark.createDataFrame(rows, schema), members, **options)
    found = judged.select("submission_id", "accepted", r.rule_text()).collect()
    return {i: (accepted, broken) for i, accepted, broken in found}


SIGNUP_CASES = [
    ({}, True, ""),
    ({"ftname": None}, False, "V1:ftname"),
    ({"ftname": "0"}, False, "V1:ftname"),
    ({"ftname": "   "}, True, ""),
    ({"ftname": "O'Brien"}, False, "V2:ftname"),
    ({"ftname": "Ann3"}, False, "V2:ftname"),
    ({"ltname": ""}, False, "V3:ltname"),
    ({"ltname": "de la"}, False, "V4:ltname"),
    ({"email": None}, False, "V5:email"),
    ({"email": "a&b@example.com"}, False, "V6:email"),
    ({"email": "a..b@example.com"}, False, "V6:email"),
    ({"email": "user@localhost"}, False, "V6:email"),
    ({"email": "user@example.1"}, False, "V6:email"),
    ({"email": "x" * 64 + "@example.com"}, True, ""),
    ({"email": "x" * 65 + "@example.com"}, False, "V6:email"),
    ({"email": "a@" + "b" * 64 + ".com"}, False, "V6:email"),
    ({"email": "\u212aate@example.com"}, False, "V6:email"),
    ({"email": "." * 200_000}, False, "V6:email"),
    ({"address": None}, False, "V7:address"),
    ({"address": "x" * 91}, True, "V24:address"),
    ({"Phonenumber": None}, False, "V8:Phonenumber"),
    ({"Phonenumber": "123456789"}, False, "V9:Phonenumber"),
    ({"Phonenumber": "12345678901"}, False, "V9:Phonenumber,V24:Phonenumber"),
    ({"Phonenumber": "\u0661" * 10}, False, "V9:Phonenumber"),
    ({"state": None}, False, "V10:state"),
    ({"state": "Select an option"}, False, "V10:state"),
    ({"state": "Elsewhere"}, True, "V11:state"),
    ({"spassword": None, "conpassword": None}, False, "V12:spassword,V18:conpassword"),
    ({"spassword": "Sh0rt!", "conpassword": "Sh0rt!"}, False, "V13:spassword"),
    ({"spassword": "Aa1&", "conpassword": "Aa1&"}, True, ""),
    ({"spassword": "Quo'teAb", "conpassword": "Quo'teAb"}, True, ""),
    ({"spassword": "NoDigits!", "conpassword": "NoDigits!"}, False, "V14:spassword"),
    ({"spassword": "alllower1!", "conpassword": "alllower1!"}, False, "V15:spassword"),
    ({"spassword": "ALLUPPER1!", "conpassword": "ALLUPPER1!"}, False, "V16:spassword"),
    ({"spassword": "NoSpecial1", "conpassword": "NoSpecial1"}, False, "V17:spassword"),
    ({"conpassword": None}, True, "V18:conpassword"),
    ({"conpassword": "Other1!x"}, False, "V19:conpassword"),
]


def test_signup_rules(spark):
    found = judge(spark, [ch for ch, _, _ in SIGNUP_CASES])
    for i, (changes, accepted, broken) in enumerate(SIGNUP_CASES):
        assert found[i] == (accepted, broken), changes


def test_each_special_character_counts(spark):
    specials = "'/~`!@#$%^&*()_-+={}[]|;:\"<>,.?\\"
    secrets = [f"Passw0rd{s}{s}" for s in specials]
    found = judge(spark, [{"spassword": s, "conpassword": s} for s in secrets], mode=r.STRICT)
    assert all(found[i] == (True, "") for i in range(len(specials)))


def test_old_quote_escaping_accepts_apostrophes(spark):
    assert judge(spark, [{"ftname": "O'Brien"}], escape_single_quote=False)[0] == (True, "")


def test_strict_mode(spark):
    changes = [{"conpassword": None}, {"state": "Elsewhere"}, {"spassword": "Aa1&"}]
    found = judge(spark, changes, mode=r.STRICT)
    assert found[0] == (False, "V18:conpassword")
    assert found[1] == (False, "V11:state")
    assert found[2] == (False, "V13:spassword,V19:conpassword")


def test_duplicate_rule_counts_empty_confirm(spark):
    blank = hashlib.sha256(b"").hexdigest()
    rows = [(1, "ann@example.com", "x"), (2, "b@example.com", blank)]
    members = spark.createDataFrame(rows, "member_id long, email string, password_digest string")
    changes = [{}, {"email": "new@example.com", "conpassword": None}, {"conpassword": None}]
    found = judge(spark, changes, members)
    assert found[0] == (False, "V20:email")
    assert found[1] == (False, "V18:conpassword,V20:email")
    assert found[2] == (True, "V18:conpassword")  # two matches are not flagged
    assert judge(spark, changes, members, match_rule="any")[2][0] is False


def test_no_secret_leaves_and_texts(spark):
    rows = [(1, *({**GOOD, "spassword": "short"}[f] for f in SIGNUP_FIELDS))]
    schema = "submission_id long, " + ", ".join(f"{f} string" for f in SIGNUP_FIELDS)
    judged = judge_signups(spark.createDataFrame(rows, schema))
    assert not {"spassword", "conpassword"} & set(judged.columns)
    assert not [name for name in judged.columns if name.startswith("__")]
    texts = signup_texts(judged).first()
    assert texts.password_text.count("<br>") == 4
    assert texts.confirm_text == "The passwords dont match"
    assert texts.outcome == "Failed to  sign up "


def test_contact(spark):
    cases = [
        (("Ann", "Lee", "A@Example.com", "Hi", None), True, ""),
        ((None, "L33", "x", "0", "0"), False, "V1:firstname,V4:lastname,V6:mailid,V21:subject"),
        (("Ann", "Lee", None, "123", "<b>"), False, "V5:mailid,V22:subject"),
    ]
    rows = [(i, *fields) for i, (fields, _, _) in enumerate(cases)]
    schema = "submission_id long, " + ", ".join(f"{f} string" for f in CONTACT_FIELDS)
    judged = judge_contacts(spark.createDataFrame(rows, schema))
    for row in judged.select("*", r.rule_text().alias("broken")).collect():
        assert (row.accepted, row.broken) == cases[row.submission_id][1:]
    descriptions = {row.submission_id: row.description for row in judged.collect()}
    assert descriptions == {0: "", 1: "0", 2: "&lt;b&gt;"}
    assert judged.filter("submission_id = 0").first().mailid == "A@Example.com"


def test_login_warnings(spark):
    attempts = spark.createDataFrame(
        [(1, " a@b.c ", "x"), (2, "", None)], "attempt_id long, email string, pass string"
    )
    rows = {row.attempt_id: row for row in judge_logins(attempts).collect()}
    assert rows[1].email == "a@b.c" and not rows[1].violations
    assert [v.field for v in rows[2].violations] == ["email", "pass"]


def stripped(text):
    out, i = [], 0
    while i < len(text):
        if text[i] == "\\":
            i += 1
            if i < len(text):
                out.append("\0" if text[i] == "0" else text[i])
        else:
            out.append(text[i])
        i += 1
    return "".join(out)


SLASHED = [
    "", "plain", "a\\b", "a\\\\b", "a\\\\\\b", "a\\0b", "a\\\\0b", "a\\\\\\0b", "\\0\\0", "x\\",
    "\\\\\\\\0", "line\\\nbreak", "\\" * 7 + "0", "\\0\\\\0\\00", "a\\0\\b\\\\c\\",
]


def test_strip_slashes_walks_left_to_right(spark):
    df = spark.createDataFrame([(t,) for t in SLASHED], "t string")
    for t, found in df.selectExpr("t", c.strip_slashes_sql("t")).collect():
        assert found == stripped(t), repr(t)


def test_clean_order_and_double_escape(spark):
    df = spark.createDataFrame(
        [(" \t\0a\x0b\n ",), ("&amp; <\"'>",), ("\\'x",), ("\u00a0a",)], "t string"
    )
    found = [row[0] for row in df.select(c.clean_input("t")).collect()]
    assert found == ["a", "&amp;amp; &lt;&quot;&#039;&gt;", "&#039;x", "\u00a0a"]


def test_search_trim_all(spark):
    df = spark.createDataFrame([(c.SEARCH_BLANKS + "A\u2003B" + c.SEARCH_BLANKS,)], "t string")
    assert df.select(c.search_normalise("t")).first()[0] == "a\u2003b"
