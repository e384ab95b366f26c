"""Golden vectors of the number texts."""

import math

import pytest

from tidemark.functions import formatting as fmt

MONEY = [
    (1.0, "$1.00"), (1.5, "$1.50"), (12.345, "$12.35"), (1.005, "$1.01"), (1.115, "$1.12"),
    (1.125, "$1.13"), (999.994, "$999.99"), (999.995, "$1.00K"), (1234.0, "$1.23K"),
    (67890.12, "$67.89K"), (999994.9, "$999.99K"), (999999.0, "$1.00M"), (1.5e6, "$1.50M"),
    (2.345e12, "$2.35T"), (1e15, "$1000.00T"), (1.2345e16, "$12,345.00T"),
    (0.0, "$0.00"), (0.5, "$0.50"), (0.1234567, "$0.123457"), (4e-7, "$0.00"),
    (0.9999999, "$1.00"), (-5.0, "-$5.00"), (-1234567.891, "-$1,234,567.891"),
    (9.999994e15, "$9999.99T"), (9.999995e15, "$10,000.00T"),
]
SUPPLY = [
    (0.0, "0"), (0.005, "0.01"), (-1500.0, "-1.5K"), (19.8e6, "19.8M"), (21000000.0, "21M"),
    (5.89e14, "589T"), (1e15, "1000T"),
]
NUMBER = [
    (1.0, "1"), (1000.0, "1,000"), (1234.5678, "1,234.568"), (0.0005, "0.001"),
    (1.0005, "1.001"), (-1234.5, "-1,234.5"),
]
PERCENT = [
    (0.0, "+0.00%"), (-0.0, "+0.00%"), (-0.001, "-0.00%"), (1.005, "+1.00%"),
    (2.675, "+2.67%"), (0.125, "+0.13%"), (-0.125, "-0.13%"), (1234.5, "+1234.50%"),
]

CASES = {
    "money": (MONEY, lambda: fmt.format_compact_currency("v")),
    "number": (NUMBER, lambda: fmt.format_number("v")),
    "percent": (PERCENT, lambda: fmt.format_percent("v")),
    "supply": ([(v, f"{t} BTC") for v, t in SUPPLY], lambda: fmt.format_supply("v", "'btc'")),
}


@pytest.mark.parametrize("kind", CASES)
def test_golden(spark, kind):
    vectors, column = CASES[kind]
    rows = [(i, v) for i, (v, _) in enumerate(vectors)]
    df = spark.createDataFrame(rows, "i int, v double").select("i", column().alias("t"))
    found = {r.i: r.t for r in df.collect()}
    assert [(v, found[i]) for i, (v, _) in enumerate(vectors)] == vectors


@pytest.mark.parametrize("kind", CASES)
def test_missing(spark, kind):
    df = spark.createDataFrame([(None,), (math.nan,)], "v double").select(CASES[kind][1]())
    assert [r[0] for r in df.collect()] == ["N/A", "N/A"]


def test_percent_agrees_with_exact_decimal(spark):
    """Against the exact binary value, rounded half away from zero."""
    from decimal import ROUND_HALF_UP, Decimal

    values = [n / 8 for n in range(-999, 1000)] + [n * 0.005 for n in range(-2000, 2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for v, text in df.select("v", fmt.format_percent("v")).collect():
        exact = Decimal(v).quantize(Decimal("0.01"), ROUND_HALF_UP)
        digits = f"{abs(exact)}"
        assert text == ("+" if v >= 0 else "-") + digits + "%"


def test_rank_time_and_join(spark):
    df = spark.sql(
        "SELECT 1 AS o, 1234 AS r, TIMESTAMP '2024-01-02 15:04:05' AS t, 'a' AS x "
        "UNION ALL SELECT 2, NULL, NULL, ''"
    ).orderBy("o")
    rows = df.select(
        fmt.rank_text_detail("r"),
        fmt.rank_text_table("r"),
        fmt.refresh_time_text("t"),
        fmt.join_present("x", "'b'", "CAST(NULL AS STRING)"),
    ).collect()
    assert tuple(rows[0]) == ("#1,234", "#1234", "3:04:05 PM", "a b")
    assert tuple(rows[1]) == ("#N/A", "#", "pending", "b")
