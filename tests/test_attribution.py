"""Section attribution: list and table forms, carry-forward over chunks."""

import random

import pytest

from tidemark.operators import attribution as a
from tidemark.plans import carriers
from tidemark.schemas import SECTION

LAYOUT = [(1, "home", 150.0, 10.0), (2, "about", 155.0, 20.0), (3, "flat", 200.0, 0.0),
          (4, "far", 1150.0, 500.0)]


def section_at(y):
    hit = None
    for _, name, top, height in LAYOUT:
        if top - 150 <= y < top - 150 + height:
            hit = name
    return hit


@pytest.fixture(scope="module")
def events(spark):
    """A third of the rows in one session, timestamps that repeat a lot."""
    rng = random.Random(7)
    rows = []
    for i in range(1200):
        session = None if i % 50 == 0 else 0 if i % 3 == 0 else rng.randrange(1, 40)
        rows.append((session, rng.randrange(30), i, float(rng.choice([0, 5, 12, 26, 50, 1000, 1600]))))
    schema = "session_id long, ts int, event_id long, scroll_y double"
    return rows, spark.createDataFrame(rows, schema).repartition(6)


@pytest.fixture(scope="module")
def intervals(spark):
    return a.section_intervals(spark.createDataFrame(LAYOUT, SECTION))


def from_list(df, sections):
    return a.with_section(df, sections.collect())


@pytest.mark.parametrize("form", [from_list, a.with_section])
def test_sections(events, intervals, form):
    rows, df = events
    found = {r.event_id: r.section_id for r in form(df, intervals).collect()}
    assert found == {i: section_at(y) for _, _, i, y in rows}


def test_borders_are_half_open(spark, intervals):
    df = spark.createDataFrame([(1, 0.0), (2, 10.0), (3, 25.0), (4, None)], "event_id long, scroll_y double")
    for form in (from_list, a.with_section):
        found = {r.event_id: r.section_id for r in form(df, intervals).collect()}
        assert found == {1: "home", 2: "about", 3: None, 4: None}


def test_repeated_and_null_event_ids(spark, intervals):
    rows = [(1, 5.0), (1, 1100.0), (None, 12.0), (None, 12.0), (None, 40.0)]
    df = spark.createDataFrame(rows, "event_id long, scroll_y double")
    for form in (from_list, a.with_section):
        found = sorted((r.scroll_y, r.section_id) for r in form(df, intervals).collect())
        assert found == [(5.0, "about"), (12.0, "about"), (12.0, "about"), (40.0, None), (1100.0, "far")]


def test_stacked_and_very_long_sections(spark):
    rows = [(k, f"s{k}", 10.0, 11.0) for k in range(1000)]
    rows += [(2000, "long", 0.0, 5e4), *((3000 + k, f"t{k}", 20.0 + k, 21.0 + k) for k in range(1000))]
    sections = spark.createDataFrame(rows, "ord int, section_id string, lo double, hi double")
    df = spark.createDataFrame([(k, k / 2) for k in range(100)], "event_id long, scroll_y double")
    found = a.with_section(df, sections)
    assert found.count() == 100 and sorted(found.collect()) == sorted(from_list(df, sections).collect())


def test_no_sections(spark, events, intervals):
    none = intervals.filter("false")
    for form in (from_list, a.with_section):
        assert form(events[1], none).filter("section_id IS NOT NULL").count() == 0


@pytest.mark.parametrize("chunks", ["1", "3", "40"])
def test_carry_forward(spark, events, intervals, chunks):
    """A third of the rows lie in one session, which is cut into chunks."""
    rows, df = events
    spark.conf.set("spark.sql.shuffle.partitions", chunks)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        carried = a.carry_section(from_list(df, intervals))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    last, expected = {}, {}
    for session, ts, i, y in sorted(rows, key=lambda r: (r[1], r[2])):
        last[session] = section_at(y) or last.get(session, "home")
        expected[i] = last[session]
    found = carried.select("event_id", "active_section").collect()
    assert len(found) == len(rows)
    assert {r.event_id: r.active_section for r in found} == expected


def test_sticky(spark):
    df = spark.createDataFrame([(100.0,), (100.5,)], "scroll_y double").select(a.is_sticky())
    assert [r[0] for r in df.collect()] == [False, True]


def link_from_list(df, links):
    return a.with_link(df, links.collect())


@pytest.mark.parametrize("form", [link_from_list, a.with_link])
def test_links(spark, form):
    links = spark.createDataFrame(
        [(3, "#home-page"), (1, "#about"), (2, "/x#home")], "ord int, href string"
    )
    ids = ["home", "about", "page", "zz", None, "#", "home-page-longer", ""]
    df = spark.createDataFrame(list(enumerate(ids)), "event_id int, active_section string")
    found = {r.event_id: r.href for r in form(df, links).collect()}
    assert found == {0: "/x#home", 1: "#about", 2: "#home-page", 3: None, 4: None, 5: "#about", 6: None, 7: "#about"}


def test_carrier_sections_overlap(spark):
    rows = carriers.sections_as_intervals(spark).orderBy("ord").collect()
    assert [(r.lo, r.hi) for r in rows] == [(0, 10), (10, 30), (25, 60), (60, 110), (110, 200)]


def test_very_many_sections_on_one_place(spark):
    """All sections hold the same place, each within the one before it: no row holds many."""
    n = 100_000
    sections = spark.range(n).selectExpr(
        "cast(id AS int) AS ord", "concat('s', id) AS section_id", "cast(id AS double) AS lo",
        f"cast(2 * {n} + 1 - id AS double) AS hi",
    )
    spots = [(1, 0.0), (2, 77.5), (3, float(n)), (4, n + 1.0), (5, 2.0 * n), (6, 2 * n + 1.0), (7, -1.0)]
    df = spark.createDataFrame(spots, "event_id long, scroll_y double")
    found = {r.event_id: r.section_id for r in a.with_section(df, sections).collect()}
    assert found == {1: "s0", 2: "s77", 3: f"s{n - 1}", 4: f"s{n - 1}", 5: "s0", 6: None, 7: None}
    plan = a.with_section(df, sections)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "NestedLoop" not in plan


def test_random_sections_equal_the_list_form(spark):
    rng = random.Random(11)
    for size in (1, 2, 7, 60):
        rows = [(k, f"s{k}", *sorted((rng.randrange(20) / 2, rng.randrange(20) / 2))) for k in range(size)]
        sections = spark.createDataFrame(rows, "ord int, section_id string, lo double, hi double")
        spots = [(k, k / 4 - 1) for k in range(50)] + [(90, float("nan")), (91, float("inf")), (92, None)]
        df = spark.createDataFrame(spots, "event_id long, scroll_y double")
        assert sorted(map(repr, a.with_section(df, sections).collect())) == sorted(
            map(repr, from_list(df, sections).collect())
        )


def test_substrings_are_found_by_their_rarest_piece(spark):
    """Rows grow with the targets that hold an id, not with the substrings of all targets."""
    rng = random.Random(6)
    targets = ["".join(rng.choice("abcdefgh") for _ in range(200)) for _ in range(300)]
    targets += ["xx" + "needle" + "y" * k for k in range(5)] + ["", "né", None]
    ids = ["needle", "né", "n", "", None, "absent!", "abc", targets[7], targets[8][50:61], "zz"]
    links = spark.createDataFrame(list(enumerate(targets)), "ord int, href string")
    asked = spark.createDataFrame([(x,) for x in ids], "id string")
    found = a.contained(asked, links, "id", "href")
    hits = sorted((r.id, r.ord) for r in found.collect())
    expected = sorted((i, k) for i in ids if i for k, t in enumerate(targets) if t is not None and i in t)
    assert hits == expected
    candidates = 0
    for i in filter(None, ids):
        grams = {i[k : k + 3] for k in range(max(1, len(i) - 2))}
        candidates += min(sum(g in t for t in targets if t) for g in grams)
    assert candidates < 4 * len(expected)
    events = spark.createDataFrame([(x,) for x in ids], "active_section string")
    linked = {r.active_section: r.href for r in a.with_link(events, links).collect()}
    assert linked == {
        i: None if i is None else next((t for t in targets if t is not None and i in t), None) for i in ids
    }
