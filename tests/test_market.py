"""Market operators on small literal tables."""

import math
import random

import pytest

from tidemark.operators import market
from tidemark.operators.ordering import global_row_number
from tidemark.schemas import MARKET
from tidemark.sources import readers


def assets(spark, rows):
    """Rows of (id, name, symbol, cap, volume, change)."""
    schema = (
        "id string, name string, symbol string, market_cap double, total_volume double, "
        "price_change_percentage_24h double"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def few(spark):
    return assets(
        spark,
        [
            ("a", "Alpha 100%", "alp", 10.0, 1.0, 1.0),
            ("b", "Beta_x", "bet", None, 2.0, None),
            ("c", "GAMMA", "gam", 30.0, None, -1.0),
            ("d", "Delta", "dlt", 30.0, 4.0, 0.0),
        ],
    )


def ids(df):
    return [row["id"] for row in df.collect()]


def test_kpis(few):
    row = market.kpis(few).first()
    assert (row.cap_total, row.volume_total) == (70.0, 7.0)
    assert (row.gainer_count, row.gainers_text, row.cap_text) == (1, "1/4", "$70.00")


def test_kpis_of_nothing_and_nan(spark, few):
    empty = market.kpis(few.filter("false")).first()
    assert (empty.cap_total, empty.gainers_text, empty.cap_text) == (0.0, "0/0", "$0.00")
    odd = assets(spark, [("a", "A", "a", math.nan, 1.0, math.nan)])
    assert market.kpis(odd).first().gainer_count == 0


def test_order_and_pages(few):
    assert ids(market.market_page(few)) == ["c", "d", "a", "b"]
    assert ids(market.market_page(few, page=2, size=2)) == ["a", "b"]
    assert ids(market.deep_page(few)) == ["c", "d", "a", "b"]
    assert ids(market.deep_page(few, page=2, size=2)) == ["a", "b"]


def test_totals_keep_large_and_infinite_values(spark):
    rows = [("a", "A", "a", 1e33, 1.0, 0.0), ("b", "B", "b", 5.0, 2.0, 0.0)]
    assert market.kpis(assets(spark, rows)).first().cap_total == 1e33
    rows.append(("c", "C", "c", math.inf, None, 0.0))
    total = market.kpis(assets(spark, rows)).first()
    assert total.cap_total == math.inf and total.volume_total == 3.0


@pytest.mark.parametrize(
    ("text", "found"),
    [("GaM", "c"), ("%", "a"), ("_", "b"), ("\u00a0BET\ufeff", "b"), (" ", "abcd"), ("zz", ""),
     ("'", ""), ("\\", "")],
)
def test_search(few, text, found):
    assert sorted(ids(market.search(few, text))) == sorted(found)


def test_search_in_rank_order(few):
    ranked = few.withColumn("market_cap_rank", few.total_volume.cast("int"))
    assert ids(market.search(ranked, "", in_order=True)) == ["a", "b", "d", "c"]


def test_find_status_direction(few):
    assert ids(market.find_asset(few, "c")) == ["c"]
    assert market.status(few, "gamma").first().status == "data"
    assert market.status(few, "zz").first().status == "empty"
    assert market.status(few, "zz", "broken").first().status == "error"
    assert market.status(few, "", "").first().status == "data"
    turned = {r["id"]: r.d for r in few.select("id", market.direction().alias("d")).collect()}
    assert turned == {"a": "up", "b": "up", "c": "down", "d": "up"}


def test_rank_with_a_third_tied(spark):
    """The tie is split over chunks, and ranks stay whole and unique."""
    rng = random.Random(1)
    rows = [(i, None if i % 3 == 0 else float(rng.randrange(50))) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, market_cap double").repartition(5)
    ranked = {r["id"]: r["rank"] for r in global_row_number(df, *market.by_market_cap()).collect()}
    expected = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert ranked == {row[0]: n for n, row in enumerate(expected, start=1)}


def test_rank_of_nothing(spark):
    df = spark.createDataFrame([], "id long, market_cap double")
    assert global_row_number(df, *market.by_market_cap()).count() == 0


def test_latest_snapshot_drops_missing(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "snapshot_ts int, id string")
    assert ids(market.latest_snapshot(df)) == ["b"]


def test_retained_row_is_whole(spark, few):
    newest = assets(spark, [("a", "Alpha 2", "alp", None, None, 5.0), ("x", "X", "x", 1.0, 1.0, 1.0)])
    picked = few.filter("id IN ('a', 'b')")
    kept = {r["id"]: r for r in market.retain_selected(picked, newest).collect()}
    assert set(kept) == {"a", "b"}
    assert (kept["a"].name, kept["a"].market_cap) == ("Alpha 2", None)
    assert kept["b"].total_volume == 2.0


def test_json_array_source(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"id": "a", "market_cap": 5}, {"id": "b"}]')
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "broken.json").write_text('[{"id": "c", ')
    (tmp_path / "error.json").write_text('{"status": {"error_code": 429}}')
    read = readers.read_market(spark, str(tmp_path))
    assert read.columns == MARKET.names
    assert sorted(ids(read)) == ["a", "b"]
    checked = readers.read_market_checked(spark, str(tmp_path))
    assert checked.filter(readers.is_corrupt()).count() == 2
