"""Market snapshot operators: top-k pages, rank, search, views, status and KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import formatting as fmt
from tidemark.functions.cleansing import SEARCH_BLANKS, search_normalise
from tidemark.functions.sqltext import quoted
from tidemark.operators.ordering import global_row_number

# Page size of the market page and the quote currency it asks for.
PAGE_SIZE = 20
QUOTE = "usd"

CHANGE = "price_change_percentage_24h"


def by_market_cap() -> list[Column]:
    """Largest first, without a value last; the id settles ties (O1)."""
    return [F.desc_nulls_last("market_cap"), F.asc("id")]


def in_quote(market: DataFrame, quote: str = QUOTE, column: str = "quote") -> DataFrame:
    """Rows quoted in one currency (P9). Nothing is converted."""
    return market.filter(F.col(column) == quote)


def market_page(market: DataFrame, page: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    """One page near the top of the market by cap, in order (O1-O3).

    Every task keeps the rows up to the page's end; for pages far down see ``deep_page``.
    """
    return market.orderBy(*by_market_cap()).offset((page - 1) * size).limit(size)


def deep_page(market: DataFrame, page: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    """The same page, in order, cut by rank: no task ever holds what lies before it."""
    first = (page - 1) * size
    ranked = global_row_number(market, *by_market_cap(), name="__row")
    page_rows = ranked.filter(F.col("__row").between(first + 1, first + size))
    return page_rows.orderBy("__row").drop("__row")


def with_rank(market: DataFrame, name: str = "market_cap_rank") -> DataFrame:
    """Rank by market cap where the source gives none (WN3)."""
    return global_row_number(market, *by_market_cap(), name=name)


def matches(query: str) -> Column:
    """Name or symbol contains the text literally, letter case aside (F1)."""
    wanted = search_normalise(quoted(query))
    return F.contains(F.lower("name"), wanted) | F.contains(F.lower("symbol"), wanted)


def is_blank(query: str) -> bool:
    return not query.strip(SEARCH_BLANKS)


def search(market: DataFrame, query: str, in_order: bool = False) -> DataFrame:
    """Filter by search text; a blank one keeps all rows (F2). Order costs a sort."""
    found = market if is_blank(query) else market.filter(matches(query))
    return found.orderBy(F.asc_nulls_last("market_cap_rank"), "id") if in_order else found


def find_asset(market: DataFrame, asset_id) -> DataFrame:
    """Point lookup by id (F3); the filter reaches the scan."""
    return market.filter(F.col("id") == asset_id).limit(1)


# A missing change counts as none.
CHANGE_OR_ZERO = f"coalesce({CHANGE}, 0D)"


def direction(value: str = CHANGE_OR_ZERO) -> Column:
    """Zero counts as up (P5)."""
    return F.expr(f"CASE WHEN {value} >= 0 AND NOT isnan({value}) THEN 'up' ELSE 'down' END")


def table_view(market: DataFrame) -> DataFrame:
    """The market table, raw key columns and formatted texts."""
    return market.select(
        "id",
        "image",
        "name",
        fmt.upper_symbol("symbol").alias("symbol"),
        fmt.format_compact_currency("current_price").alias("price_text"),
        fmt.format_percent(CHANGE_OR_ZERO).alias("change_text"),
        direction().alias("direction"),
        fmt.format_compact_currency("market_cap").alias("cap_text"),
        fmt.format_compact_currency("total_volume").alias("volume_text"),
        fmt.rank_text_table("market_cap_rank").alias("rank_text"),
    )


def card_view(market: DataFrame) -> DataFrame:
    """The small-screen subset."""
    return market.select(
        "id",
        "image",
        "name",
        fmt.upper_symbol("symbol").alias("symbol"),
        fmt.format_percent(CHANGE_OR_ZERO).alias("change_text"),
        fmt.format_compact_currency("current_price").alias("price_text"),
        fmt.format_compact_currency("market_cap").alias("cap_text"),
    )


def detail_rows(market: DataFrame) -> DataFrame:
    """Twelve labelled values per asset, one row each."""
    money, supply = fmt.format_compact_currency, fmt.format_supply
    # The labels, in display order.
    labelled = [
        ("Current Price", money("current_price")),
        ("24h Change", fmt.format_percent(CHANGE_OR_ZERO)),
        ("24h High", money("high_24h")),
        ("24h Low", money("low_24h")),
        ("Market Cap", money("market_cap")),
        ("Total Volume", money("total_volume")),
        ("Circulating Supply", supply("circulating_supply", "symbol")),
        ("Total Supply", supply("total_supply", "symbol")),
        ("Max Supply", supply("max_supply", "symbol")),
        ("ATH", money("ath")),
        ("ATL", money("atl")),
        ("Rank", fmt.rank_text_detail("market_cap_rank")),
    ]
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("ord"), F.lit(label).alias("label"), text.alias("value"))
            for n, (label, text) in enumerate(labelled, start=1)
        ]
    )
    return market.select("id", F.inline(rows))


def status(market: DataFrame, query: str = "", error: str | None = None) -> DataFrame:
    """One row telling error, empty or data for a search."""
    shown = search(market, query).agg(F.count("*").alias("shown"))
    failed = F.lit(error).cast("string")
    return shown.select(
        F.when(failed != "", F.lit("error"))
        .when(F.col("shown") == 0, F.lit("empty"))
        .otherwise(F.lit("data"))
        .alias("status"),
        "shown",
    )


# Values up to here are added as decimals; a sum of a million million of them still fits.
EXACT_BELOW = "1E19"


def _exact_total(column: str) -> Column:
    """Total of all values but NaN. Decimal addends, so that it does not depend on the order
    of partitions; larger and infinite values are added beside them as doubles.
    """
    exact = f"abs({column}) < {EXACT_BELOW}"
    usual = f"sum(CASE WHEN {exact} THEN CAST({column} AS DECIMAL(38,6)) END)"
    large = f"sum(CASE WHEN NOT {exact} AND NOT isnan({column}) THEN CAST({column} AS DOUBLE) END)"
    return F.expr(f"CAST(coalesce({usual}, 0) AS DOUBLE) + coalesce({large}, 0D)")


def kpi_columns() -> list[Column]:
    """Totals, gainers and row count, all partial aggregates of one pass (A1-A4)."""
    rising = f"{CHANGE_OR_ZERO} > 0 AND NOT isnan({CHANGE_OR_ZERO})"
    return [
        _exact_total("market_cap").alias("cap_total"),
        _exact_total("total_volume").alias("volume_total"),
        F.expr(f"count_if({rising})").alias("gainer_count"),
        F.count("*").alias("asset_count"),
    ]


def kpi_texts(totals: DataFrame) -> DataFrame:
    """Totals with their texts; gainers read ``n/total`` (A5)."""
    return totals.select(
        "*",
        fmt.format_compact_currency("cap_total").alias("cap_text"),
        fmt.format_compact_currency("volume_total").alias("volume_text"),
        F.expr("concat(gainer_count, '/', asset_count)").alias("gainers_text"),
    )


def kpi_totals(market: DataFrame, *by: str) -> DataFrame:
    """The numbers alone."""
    return (market.groupBy(*by) if by else market).agg(*kpi_columns())


def kpis(market: DataFrame, *by: str) -> DataFrame:
    """KPI row over all assets, never over a search result (A6); or one per snapshot."""
    return kpi_texts(kpi_totals(market, *by))


def latest_snapshot(history: DataFrame, snapshot: str = "snapshot_ts") -> DataFrame:
    """Only the rows of the newest snapshot (T3, S10): an asset missing there is gone.

    The newest stamp is a scalar subquery, which reaches the scan as a filter.
    """
    newest = history.agg(F.max(snapshot)).scalar()
    return history.filter(F.col(snapshot) == newest)


def retain_selected(selected: DataFrame, newest: DataFrame, key: str = "id") -> DataFrame:
    """Newest row of each selected asset, or the old row if the asset left.

    The row is taken as a whole, so that new nulls win over old values.
    """
    columns = [c for c in newest.columns if c != key]
    extra = [c for c in selected.columns if c != key and c not in columns]
    old = selected.select(key, *extra, F.struct(*columns).alias("__old"))
    new = newest.select(key, F.struct(*columns).alias("__new"))
    kept = old.join(new, key, "left").withColumn("__row", F.coalesce("__new", "__old"))
    return kept.select(key, *extra, "__row.*")
