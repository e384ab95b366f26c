"""Identity operators against brute force, with hot keys."""

import random

import pytest

from tidemark.operators import identity
from tidemark.operators.components import components
from tidemark.operators.key_filter import may_be_in

SCHEMA = "{id} long, email string, {secret} string"


def people(spark, rows, kind):
    secret = "password_digest" if kind == "member" else "secret_digest"
    return spark.createDataFrame(rows, SCHEMA.format(id=f"{kind}_id", secret=secret))


def crowd(n, seed):
    """A third shares one secret, some share an email, a few keys are missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        email = None if i % 41 == 0 else f"e{rng.randrange(n)}"
        secret = "hot" if i % 3 == 0 else f"s{rng.randrange(n)}"
        rows.append((i, email, secret))
    return rows


def matches(candidate, members):
    _, email, secret = candidate
    return sum(
        (email is not None and email == m[1]) or (secret is not None and secret == m[2])
        for m in members
    )


@pytest.fixture(scope="module")
def data(spark):
    c, m = crowd(300, 1), crowd(240, 2)
    return c, m, people(spark, c, "candidate"), people(spark, m, "member")


def test_counts_equal_the_or_join(data):
    c, m, candidates, members = data
    found = {
        r.candidate_id: r.n_matches
        for r in identity.with_match_counts(candidates, members).collect()
    }
    assert found == {row[0]: matches(row, m) for row in c}
    assert any(n == 1 for n in found.values()) and any(n == 80 for n in found.values())


def test_counts_add_up_over_parts_of_the_members(data):
    c, m, candidates, members = data
    parts = [identity.key_counts(members.filter(f"member_id % 3 = {k}")) for k in range(3)]
    found = identity.with_counts(candidates, identity.add_key_counts(*parts)).collect()
    assert {r.candidate_id: r.n_matches for r in found} == {r[0]: matches(r, m) for r in c}


def test_counts_of_odd_keys(spark):
    """Missing and empty keys, texts that run into each other, and repeated candidates."""
    rows = [(1, "a", "bc"), (2, "ab", "c"), (3, None, "c"), (4, "", ""), (5, None, None), (6, "x", None)]
    m = [*rows, (7, "a", "c"), (8, "", None), (9, "1:a", "bc")]
    c = rows + rows[:3] + [(10, "zz", "zz")]
    found = identity.with_match_counts(people(spark, c, "candidate"), people(spark, m, "member"))
    expected = sorted((r[0], matches(r, m)) for r in c)
    assert sorted((r.candidate_id, r.n_matches) for r in found.collect()) == expected
    none = people(spark, [], "member")
    assert {r.n_matches for r in identity.with_match_counts(people(spark, c, "candidate"), none).collect()} == {0}


def test_key_filter_keeps_every_key(spark):
    keys = spark.range(2000).selectExpr("concat('k', id) AS key")
    rows = spark.range(100_000).selectExpr("concat('k', id * 7) AS key", "id")
    passed = rows.where(may_be_in(keys, "key", "key")).collect()
    assert {f"k{i}" for i in range(0, 2000, 7)} <= {r.key for r in passed}
    assert len(passed) < 5000
    assert rows.where(may_be_in(keys.filter("false"), "key", "key")).isEmpty()


@pytest.mark.parametrize(("rule", "dup"), [("exactly_one", lambda n: n == 1), ("any", bool)])
def test_admit_new(data, rule, dup):
    c, m, candidates, members = data
    found = identity.admit_new(candidates, members, rule)
    assert {r.candidate_id for r in found.collect()} == {
        row[0] for row in c if not dup(matches(row, m))
    }


def test_unknown_rule():
    with pytest.raises(ValueError):
        identity.is_duplicate("some")


def one_by_one(rows):
    emails, secrets, taken = set(), set(), set()
    for i, email, secret in sorted(rows):
        if email not in emails and secret not in secrets:
            emails |= {email} - {None}
            secrets |= {secret} - {None}
            taken.add(i)
    return taken


@pytest.mark.parametrize("scan_rows", [identity.SCAN_ROWS, 20, 1])
def test_admit_in_order(spark, scan_rows):
    """Null keys rival nobody; rows without any key are all admitted. The bound is no matter."""
    rows = [*crowd(200, 3), (900, None, "s"), (901, None, None), (902, None, None), (903, "e", "s")]
    found = identity.admit_in_order(people(spark, rows, "candidate"), scan_rows=scan_rows)
    assert {r.candidate_id for r in found.collect()} == one_by_one(rows)


def jobs_of(spark, work):
    name = f"counted-{random.random()}"
    spark.sparkContext.setJobGroup(name, "")
    try:
        result = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def chain(n):
    """Each rivals the next; the second of a pair never keeps the third out."""
    return [(i, f"e{(i + 1) // 2}", f"s{i // 2}") for i in range(n)]


def test_admit_in_order_chain(spark):
    """A chain of any length is one group: jobs grow with the logarithm of its length."""
    rows = chain(10_000)
    found, jobs = jobs_of(
        spark, lambda: identity.admit_in_order(people(spark, rows, "candidate")).collect()
    )
    assert {r.candidate_id for r in found} == one_by_one(rows) == set(range(0, 10_000, 2))
    assert jobs < 150


def test_admit_in_order_of_groups_beyond_a_task(spark):
    """Two large groups, one of them a chain against the order, and many small ones."""
    rows = chain(300) + [(10_000 - i, f"x{(i + 1) // 2}", f"y{i // 2}") for i in range(300)]
    rows += [(20_000 + i, f"p{i // 3}", None) for i in range(60)]
    found = identity.admit_in_order(people(spark, rows, "candidate"), scan_rows=100)
    assert {r.candidate_id for r in found.collect()} == one_by_one(rows)


def test_components(spark):
    """Chains, a star of a third of all nodes, loops, repeated edges, and no edge."""
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1001 + k) for k in range(300)]
    edges += [(5000 - k, 5001 - k) for k in range(300)] + [(7, 7), (8000, 8001), (8001, 8000)]
    random.Random(5).shuffle(edges)
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    expected = {k: 0 for k in range(301)} | {k: 1000 for k in range(1000, 1301)}
    expected |= {k: 4701 for k in range(4701, 5002)} | {8000: 8000, 8001: 8000}
    assert found == expected
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_login_outcome(spark):
    members = people(spark, [(2, "A@x.com", "two"), (1, "a@x.com", "one"), (3, None, "n")], "member")
    admins = spark.createDataFrame(
        [("a@x.com", "root"), ("b@x.com", None)], "email string, password_digest string"
    )
    rows = [
        (1, "a@X.com", "one", "member"),
        (2, "a@x.com", "two", "denied"),  # only the first row per email counts
        (3, "a@x.com", "root", "admin"),
        (4, "b@x.com", None, "denied"),
        (5, None, "n", "denied"),
        (6, "zz@x.com", "", "denied"),
    ]
    attempts = spark.createDataFrame(
        [row[:3] for row in rows], "attempt_id long, email string, pass_digest string"
    )
    found = identity.login_outcome(attempts, members, admins).collect()
    assert {r.attempt_id: r.outcome for r in found} == {row[0]: row[3] for row in rows}


def test_first_per_key(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, None), ("j", 5, "x")], "k string, o int, v string")
    found = {r.k: (r.o, r.v) for r in identity.first_per_key(df, "k", "o", "v").collect()}
    assert found == {"k": (1, None), "j": (5, "x")}
