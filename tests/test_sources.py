"""Readers, plain appends and the beat of a running stream."""

import json

from tidemark.operators.intake import judge_contacts
from tidemark.schemas import CONTACT, CONTACT_PAGE
from tidemark.session import cut_lineage, shared_dir, work_dir
from tidemark.sources import readers, sinks
from tidemark.streaming.market_refresh import MarketRefresh


def test_csv_forms_append_and_stored_table(spark, tmp_path):
    (tmp_path / "forms.csv").write_text(
        "submission_id,submitted_at,firstname,lastname,mailid,subject,description\n"
        "1,2024-01-01T00:00:00Z,Ann,Lee,a@b.co,0,\n"
        "2,2024-01-01T00:00:00Z,Bo,Ray,b@b.co,Hi,<b>\n"
    )
    forms = readers.read_forms(spark, str(tmp_path / "forms.csv"), CONTACT, "csv", header="true")
    accepted, rejected = sinks.split_outcome(judge_contacts(forms))
    assert [r.submission_id for r in rejected.collect()] == [1]
    for _ in range(2):
        sinks.append(sinks.contact_rows(accepted), str(tmp_path / "stored"))
    stored = readers.read_table(spark, str(tmp_path / "stored"), CONTACT_PAGE)
    assert [tuple(r) for r in stored.collect()] == [("Bo Ray", "b@b.co", "Hi", "&lt;b&gt;")] * 2


def test_batches_are_replaced_and_bounded(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([("a b", "m", "s", "d")], CONTACT_PAGE)
    assert sinks.read_batches(spark, path, CONTACT_PAGE).count() == 0
    for batch in (0, 1, 1):
        sinks.write_batch(rows, path, batch)
    assert sinks.read_batches(spark, path, CONTACT_PAGE).count() == 2
    assert sinks.read_batches(spark, path, CONTACT_PAGE, before=1).count() == 1


def test_refresh_keeps_a_beat(spark, tmp_path):
    (tmp_path / "log").mkdir()

    def land(n):
        body = tmp_path / f"{n}.json"
        body.write_text(json.dumps([{"id": f"coin{n}", "market_cap": n}]))
        row = {"fetch_id": n, "fetched_at": f"2024-01-01T00:0{n}:00Z", "status": 200, "path": str(body)}
        (tmp_path / "log" / f"{n}.json").write_text(json.dumps(row))

    job = MarketRefresh(spark, str(tmp_path / "market"))
    land(1)
    running = job.start(str(tmp_path / "log"), every_seconds=1)
    try:
        running.processAllAvailable()
        assert [r.id for r in job.current().collect()] == ["coin1"]
        land(2)
        running.processAllAvailable()
        assert [r.id for r in job.current().collect()] == ["coin2"]
    finally:
        running.stop()


def test_work_lies_in_the_named_folder(spark):
    folder = shared_dir(spark)
    assert work_dir(spark, "x").startswith(folder)
    assert work_dir(spark, "x") != work_dir(spark, "x")
    assert cut_lineage(spark.range(3)).count() == 3
