"""Streams against their batch forms: several batches, failures, replays."""

import json
import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.attribution import carry_section, with_section
from tidemark.operators.identity import key_counts
from tidemark.plans import carriers
from tidemark.schemas import CONTACT, MEMBER, SIGNUP, SIGNUP_FIELDS
from tidemark.sources.readers import stream_forms
from tidemark.streaming.form_intake import ContactIntake, SignupIntake
from tidemark.streaming.market_refresh import MarketRefresh
from tidemark.streaming.member_index import MemberIndex
from tidemark.streaming.section_tracking import SectionTracking
from tidemark.streaming.visits import VisitTracking


class Fetches:
    """Lands bodies and log rows the way a fetcher would."""

    def __init__(self, root):
        self.root, self.n = root, 0
        (root / "log").mkdir()
        (root / "bodies").mkdir()

    def land(self, minute, body=None, status=200, error=None):
        self.n += 1
        path = self.root / "bodies" / f"{self.n}.json"
        if body is not None:
            path.write_text(body if isinstance(body, str) else json.dumps(body))
        row = {
            "fetch_id": self.n, "fetched_at": f"2024-01-01T00:{minute:02d}:00Z",
            "status": status, "path": str(path), "error": error,
        }
        (self.root / "log" / f"{self.n}.json").write_text(json.dumps(row))


def coin(name, cap=None, change=None):
    return {
        "id": name, "name": name.title(), "symbol": name[:3], "market_cap": cap,
        "price_change_percentage_24h": change,
    }


def shown(job):
    return {r.id: r.market_cap for r in job.current().collect()}


def picked(job):
    return {r.id: r.market_cap for r in job.selected().collect()}


def test_market_refresh(spark, tmp_path):
    fetches = Fetches(tmp_path)
    job = MarketRefresh(spark, str(tmp_path / "market"))

    def run():
        job.start(str(tmp_path / "log"), every_seconds=None).awaitTermination()

    assert shown(job) == {} and job.current_kpis() is None and job.selected() is None

    fetches.land(1, [coin("alpha", 10, 1), coin("beta", 5, -1)])
    run()
    assert shown(job) == {"alpha": 10, "beta": 5}
    kpi = job.current_kpis().first()
    assert (kpi.cap_text, kpi.gainers_text) == ("$15.00", "1/2")

    # Failures of every kind leave the shown rows and their stamp alone.
    fetches.land(2, status=503)
    fetches.land(3, error="no network")
    fetches.land(4, '[{"id": "gamma", ')
    fetches.land(5, {"status": {"error_code": 429}})
    fetches.land(5)
    run()
    assert shown(job) == {"alpha": 10, "beta": 5}
    assert job.current().first().fetched_at.minute == 1
    errors = {r.error for r in job.status().filter("NOT good").collect()}
    assert errors == {
        "Request failed with status 503.", "no network", "1 unreadable records", "Body not found.",
    }
    assert job.quarantined().count() == 2

    # A newer snapshot replaces all; an older one that arrives late does not.
    fetches.land(7, [coin("alpha", None), coin("delta", 7)])
    run()
    fetches.land(6, [coin("late", 1)])
    run()
    assert shown(job) == {"alpha": None, "delta": 7}

    # An empty snapshot is a snapshot.
    fetches.land(8, [])
    run()
    assert shown(job) == {}
    assert job.current_kpis().first().gainers_text == "0/0"
    assert job._last_good()["fetched_at"].minute == 8


def test_refresh_keeps_selection(spark, tmp_path):
    fetches = Fetches(tmp_path)
    job = MarketRefresh(spark, str(tmp_path / "market"))
    first = spark.createDataFrame([coin("alpha", 1.0), coin("beta", 2.0)], "id string, name string, "
                                  "symbol string, market_cap double, price_change_percentage_24h double")
    from tidemark.schemas import MARKET

    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in MARKET.fields
               if f.name not in first.columns]
    job.select(first.select("*", *missing))
    fetches.land(1, [coin("alpha", 10)])
    fetches.land(2, status=500)
    fetches.land(3, [coin("beta", None), coin("other", 1)])
    job.start(str(tmp_path / "log"), every_seconds=None).awaitTermination()
    assert picked(job) == {"alpha": 10, "beta": None}


def test_refresh_replay_changes_nothing(spark, tmp_path):
    fetches = Fetches(tmp_path)
    job = MarketRefresh(spark, str(tmp_path / "market"))
    fetches.land(1, [coin("alpha", 1)])
    fetches.land(2, [coin("alpha", 2), coin("beta", 3)])
    from tidemark.schemas import FETCH_LOG

    log = spark.read.schema(FETCH_LOG).json(str(tmp_path / "log"))
    batches = [log.filter(f"fetch_id = {n}") for n in (1, 2)]
    for n, batch in enumerate(batches):
        job.on_batch(batch, n)
    job.on_batch(batches[1], 1)
    assert shown(job) == {"alpha": 2, "beta": 3}
    assert job.status().count() == 2
    odd = log.limit(1).selectExpr(
        "fetch_id", "CAST(NULL AS TIMESTAMP) AS fetched_at", "CAST(NULL AS INT) AS status", "path", "error"
    )
    job.on_batch(odd, 2)
    assert shown(job) == {"alpha": 2, "beta": 3}
    # Several attempts in one batch: the newest good one is shown.
    both = MarketRefresh(spark, str(tmp_path / "both"))
    both.on_batch(log, 0)
    assert shown(both) == {"alpha": 2, "beta": 3}


GOOD = {
    "ftname": "Ann", "ltname": "Lee", "email": "ann@example.com", "Phonenumber": "0123456789",
    "address": "1 Road", "state": "Kerala", "spassword": "Passw0rd!", "conpassword": "Passw0rd!",
}


def land_signups(folder, n, *changes):
    folder.mkdir(exist_ok=True)
    rows = [{"submission_id": n * 10 + i, **GOOD, **ch} for i, ch in enumerate(changes)]
    (folder / f"{n}.json").write_text("\n".join(map(json.dumps, rows)))


def signup_ids(df):
    return sorted(r[0] for r in df.select(df.columns[0]).collect())


def other(n):
    secret = f"Passw0rd!{n}"
    return {"email": f"p{n}@example.com", "spassword": secret, "conpassword": secret}


def test_signup_stream_knows_earlier_batches(spark, tmp_path):
    folder = tmp_path / "in"
    job = SignupIntake(spark, str(tmp_path / "out"))

    def run():
        job.start(stream_forms(spark, str(folder), SIGNUP)).awaitTermination()

    land_signups(folder, 1, {}, {**other(1), "ftname": None})
    run()
    assert (signup_ids(job.accepted()), signup_ids(job.rejected())) == ([10], [11])
    land_signups(folder, 2, other(1), {**other(2), "email": "ANN@example.com"}, {})
    run()
    assert signup_ids(job.accepted()) == [10, 20]
    broken = {r.submission_id: [v.rule for v in r.violations] for r in job.rejected().collect()}
    assert broken == {11: ["V1"], 21: ["V20"], 22: ["V20"]}
    assert job.accepted().columns == MEMBER.names
    assert job.rejected().columns == ["submission_id", "violations"]


def test_signup_batch_replay_and_one_by_one(spark, tmp_path):
    schema = "submission_id long, " + ", ".join(f"{f} string" for f in SIGNUP_FIELDS)
    people = [{}, {**other(1), "email": GOOD["email"]}, {**other(1)}, other(3)]
    rows = [(i, *({**GOOD, **ch}[f] for f in SIGNUP_FIELDS)) for i, ch in enumerate(people)]
    batch = spark.createDataFrame(rows, schema)
    job = SignupIntake(spark, str(tmp_path / "out"), match_rule="any", one_by_one=True)
    for _ in range(2):
        job.on_batch(batch, 0)
        # 1 rivals 0 by email; 2 rivals only the dropped 1, so it stays.
        assert signup_ids(job.accepted()) == [0, 2, 3]
        assert signup_ids(job.rejected()) == [1]
        assert [v.rule for v in job.rejected().first().violations] == ["V20"]
    with pytest.raises(ValueError):
        SignupIntake(spark, str(tmp_path / "bad"), one_by_one=True)


def test_contact_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [
        {"submission_id": 1, "firstname": "Ann", "lastname": "Lee", "mailid": "A@b.co", "subject": "Hi"},
        {"submission_id": 2, "firstname": "Ann"},
    ]
    (folder / "a.json").write_text("\n".join(map(json.dumps, rows)))
    job = ContactIntake(spark, str(tmp_path / "out"))
    job.start(stream_forms(spark, str(folder), CONTACT)).awaitTermination()
    assert [tuple(r) for r in job.accepted().collect()] == [("Ann Lee", "A@b.co", "Hi", "")]
    assert signup_ids(job.rejected()) == [2]


def test_section_stream_equals_batch(spark, tmp_path, small_dir):
    """Seven batches in time order with a full state every third; batch 4 comes twice."""
    scroll = carriers.scroll(spark, small_dir)
    sections = carriers.sections_as_intervals(spark)
    job = SectionTracking(spark, str(tmp_path), sections, full_state_every=3)
    for n in (0, 1, 2, 3, 4, 4, 5, 6):
        job.on_batch(scroll.filter(f"event_id >= {n * 150} AND event_id < {n * 150 + 150}"), n)
    found = {r.event_id: r.active_section for r in job.active().collect()}
    expected = carry_section(with_section(scroll, sections)).collect()
    assert found == {r.event_id: r.active_section for r in expected}


def index_rows(spark, n):
    """Members of batch n: each shares a secret with those of the batch before."""
    rows = [(n * 10 + k, f"e{n * 10 + k}", f"s{(n + k) // 2}") for k in range(4)]
    return spark.createDataFrame(rows, "member_id long, email string, password_digest string")


def test_member_index_over_fifty_batches(spark, tmp_path):
    """What a batch reads does not grow; counts equal those of all members; replays are safe."""
    base = index_rows(spark, 1000)
    index = MemberIndex(spark, str(tmp_path), base, merge_every=5)
    files, folders, everyone = [], [], [base]
    for n in range(50):
        index.open(n)
        read = index.counts(n)
        files.append(len(read.inputFiles()))
        folders.append(len(index.folders(n)))
        for _ in range(2 if n in (0, 5, 7, 10) else 1):
            index.add(index_rows(spark, n), n)
        everyone.append(index_rows(spark, n))
        if n in (0, 4, 5, 6, 10, 49):
            expected = key_counts(reduce(DataFrame.unionByName, everyone))
            known = sorted(map(tuple, index.counts(n + 1).collect()))
            assert known == sorted(map(tuple, expected.collect()))
            asked = spark.createDataFrame([("ee0",), ("ss3",), ("bnone",)], "key string")
            some = {tuple(r) for r in index.counts(n + 1, asked).collect()}
            assert {r for r in known if r[0] in ("ee0", "ss3")} <= some <= set(known)
    assert max(folders) == 5
    assert max(files[25:]) <= max(files[5:25])
    left = len(list((tmp_path / "change").iterdir())) + len(list((tmp_path / "full").iterdir()))
    assert left <= 2 * 6


def test_signup_stream_of_many_batches_equals_one_by_one(spark, tmp_path):
    """Twelve batches over a merge of the index, each once more after a failure halfway."""
    schema = "submission_id long, " + ", ".join(f"{f} string" for f in SIGNUP_FIELDS)
    rng = random.Random(9)
    rows = []
    for k in range(72):
        email = f"p{rng.randrange(40)}@example.com"
        secret = f"Passw0rd!{rng.randrange(50)}"
        rows.append((k, {**GOOD, "email": email, "spassword": secret, "conpassword": secret}))
    base = spark.createDataFrame([(0, "p3@example.com", "none")], "member_id long, email string, password_digest string")
    job = SignupIntake(spark, str(tmp_path), base, match_rule="any", one_by_one=True)
    emails, secrets, expected = {"p3@example.com"}, set(), []
    for k, row in rows:
        if row["email"] not in emails and row["conpassword"] not in secrets:
            emails.add(row["email"])
            secrets.add(row["conpassword"])
            expected.append(k)
    for n in range(12):
        part = [(k, *(row[f] for f in SIGNUP_FIELDS)) for k, row in rows[n * 6 : n * 6 + 6]]
        batch = spark.createDataFrame(part, schema)
        job.on_batch(batch, n)
        if n in (1, 10):
            job.on_batch(batch, n)
    assert signup_ids(job.accepted()) == expected
    assert job.accepted().count() + job.rejected().count() == 72


VISIT_SECTIONS = [(1, "home", 0.0, 10.0), (2, "about", 10.0, 20.0)]


def scroll_rows(spark, rows):
    found = spark.createDataFrame(rows, "session_id long, ts string, event_id long, scroll_y double")
    return found.withColumn("ts", F.to_timestamp("ts"))


def test_visits_over_batches_and_restarts(spark, tmp_path):
    """The state outlives each restart; a pause ends a visit, by an event or by the timer."""
    sections = spark.createDataFrame(VISIT_SECTIONS, "ord int, section_id string, lo double, hi double")
    batches = [
        [(1, "2024-01-01 00:00:00", 1, 5.0), (2, "2024-01-01 00:00:10", 2, 15.0), (1, "2024-01-01 00:01:00", 3, 15.0)],
        [(1, "2024-01-01 00:02:00", 4, 99.0), (3, "2024-01-01 00:02:30", 5, 99.0)],
        [(1, "2024-01-01 00:30:00", 6, 99.0), (1, "2024-01-01 00:30:01", 7, 5.0), (None, "2024-01-01 00:30:02", 8, 5.0)],
        [(4, "2024-01-01 02:00:00", 9, 15.0)],
        [(2, "2024-01-01 03:00:00", 10, 99.0), (1, "2024-01-01 03:00:01", 11, 15.0)],
        [(5, "2024-01-01 09:00:00", 12, 15.0)],
    ]
    schema = scroll_rows(spark, batches[0]).schema
    job = VisitTracking(spark, str(tmp_path / "out"), sections.collect(), idle_seconds=600)
    for rows in batches:
        scroll_rows(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        job.start(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).awaitTermination()
    active = {r.event_id: (r.active_section, r.visit_start.strftime("%H:%M:%S")) for r in job.active().collect()}
    assert active == {
        1: ("home", "00:00:00"), 2: ("about", "00:00:10"), 3: ("about", "00:00:00"),
        4: ("about", "00:00:00"), 5: ("home", "00:02:30"), 6: ("home", "00:30:00"),
        7: ("home", "00:30:00"), 9: ("about", "02:00:00"), 10: ("home", "03:00:00"),
        11: ("about", "03:00:01"), 12: ("about", "09:00:00"),
    }
    visits = sorted(
        (r.session_id, r.visit_end.strftime("%H:%M:%S"), r.n_events, r.ended_in) for r in job.visits().collect()
    )
    assert visits == [
        (1, "00:02:00", 3, "about"), (1, "00:30:01", 2, "home"), (1, "03:00:01", 1, "about"),
        (2, "00:00:10", 1, "about"), (2, "03:00:00", 1, "home"), (3, "00:02:30", 1, "home"),
        (4, "02:00:00", 1, "about"),
    ]
