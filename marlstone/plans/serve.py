"""Serving queries over gold, and live queries straight on bronze."""

import datetime as dt
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.json import as_double, top_level, top_level_scalar
from marlstone.functions.time import from_iso
from marlstone.operators.series import direction_of
from marlstone.operators.topn import top_n, top_n_per_key
from marlstone.schemas import PARTITION_COLUMN

# Fixed value: observations shown in a live series.
LIVE_POINTS = 60

# Summary columns and the headings they are shown under.
DASHBOARD_HEADINGS = {
    "market_cap_rank": "Rank",
    "name": "Coin",
    "symbol": "Symbol",
    "current_price": "Price (USD)",
    "market_cap_billions": "Market Cap (B)",
    "price_change_24h_pct": "24h Change (%)",
    "price_trend": "Trend",
}


def dashboard_summary(summary: DataFrame) -> DataFrame:
    """The summary under its display headings, best rank first."""
    return summary.select(
        *[F.col(c).alias(heading) for c, heading in DASHBOARD_HEADINGS.items()]
    ).orderBy(F.asc_nulls_last("Rank"), "Symbol", "Coin")


def coin_header(summary: DataFrame, symbol: str) -> DataFrame:
    """Heading and key figures of one coin, its symbol in capitals."""
    return summary.where(F.lower("symbol") == F.lower(F.lit(symbol))).select(
        F.concat("name", F.lit(" ("), F.upper("symbol"), F.lit(")")).alias("title"),
        "current_price",
        "market_cap_billions",
        "price_change_24h_pct",
    )


def live_prices(
    raw_markets: DataFrame,
    symbol: str,
    n: int | None = LIVE_POINTS,
    since: dt.date | None = None,
    strict: bool = True,
) -> DataFrame:
    """The newest n observations of a symbol over all batches, oldest first.

    All of them without n. When not strict, malformed documents have no
    observation and a malformed price is NULL.

    Every batch counts, so this reads the payloads of the whole bronze table
    unless `since` bounds the days (a partition filter on a table at rest).
    """
    target = F.lower(F.lit(symbol))
    candidates = _since(raw_markets, since).where(
        _may_mention(F.col("payload"), symbol.lower())
    )
    matches = _observations(candidates, lambda found: found == target, strict).select(
        "time", "live_price"
    )
    if n is not None:
        matches = top_n(matches, n, _newest_first())
    return matches.orderBy("time", F.asc_nulls_first("live_price"))


def live_prices_by_symbol(
    raw_markets: DataFrame,
    n: int = LIVE_POINTS,
    since: dt.date | None = None,
    strict: bool = True,
) -> DataFrame:
    """The newest n observations of every symbol, symbols in lower case."""
    observations = _observations(_since(raw_markets, since), Column.isNotNull, strict)
    return top_n_per_key(observations, ["symbol"], n, _newest_first())


def price_direction(live: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Whether a live series rose or fell; one row per key, or one row in all."""
    return direction_of(live, keys or [], "time", "live_price")


def bronze_fields(raw_markets: DataFrame, strict: bool = True) -> DataFrame:
    """Name and price of every bronze row, read from the raw document.

    When not strict, what cannot be read is NULL.
    """
    fields = top_level("payload", ["name", "current_price"], strict).alias("fields")
    price = top_level_scalar("fields", "payload", "current_price")
    return raw_markets.select("coin_id", "payload", fields).select(
        "coin_id",
        top_level_scalar("fields", "payload", "name").alias("name"),
        as_double(price, strict).alias("price"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def sample_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """A look at the first n rows of an order."""
    return top_n(df, n, [F.asc_nulls_last(c) for c in order])


def top_market_cap(stg_markets: DataFrame, n: int = 10) -> DataFrame:
    return top_n(stg_markets, n, [F.desc_nulls_last("market_cap"), F.asc("coin_id")])


def with_symbol(
    summary: DataFrame, stg_markets: DataFrame, symbol: str | None = None
) -> DataFrame:
    """Summary rows joined to the silver symbol of their coin.

    `summary` is a market summary with coin_id. The join is on the id, one row
    to one row, because symbols may repeat. `symbol` keeps one of them.
    """
    symbols = stg_markets.select("coin_id", F.col("symbol").alias("silver_symbol"))
    if symbol is not None:
        symbols = symbols.where(F.col("silver_symbol") == F.lit(symbol))
    return summary.join(symbols, "coin_id")


def fetch(df: DataFrame, limit: int) -> pd.DataFrame:
    """A bounded result as a pandas frame, for display; more rows fail."""
    rows = df.limit(limit + 1).toPandas()
    if len(rows) > limit:
        raise ValueError(f"the result has more than {limit} rows")
    return rows


def _observations(
    raw_markets: DataFrame, keep: Callable[[Column], Column], strict: bool
) -> DataFrame:
    """Symbol in lower case, time and price of the rows whose symbol is kept.

    The row is put into an array that is filtered and unnested. A plain filter
    on the symbol would be pushed below its extraction and read the JSON twice.
    """
    fields = top_level("payload", ["symbol", "current_price"], strict).alias("fields")
    price = as_double(top_level_scalar("fields", "payload", "current_price"), strict)
    row = F.struct(
        F.lower(top_level_scalar("fields", "payload", "symbol")).alias("symbol"),
        from_iso("ingested_at").alias("time"),
        price.alias("live_price"),
    )
    kept = F.filter(F.array(row), lambda r: keep(r["symbol"]))
    return raw_markets.select("ingested_at", "payload", fields).select(F.inline(kept))


def _newest_first() -> list[Column]:
    return [F.desc_nulls_last("time"), F.desc_nulls_last("live_price")]


def _since(raw: DataFrame, day: dt.date | None) -> DataFrame:
    if day is None:
        return raw
    if PARTITION_COLUMN in raw.columns:
        return raw.where(F.col(PARTITION_COLUMN) >= F.lit(day))
    return raw.where(F.col("ingested_at") >= F.lit(day.isoformat()))


def _may_mention(payload: Column, symbol: str) -> Column:
    """Cheap test that only passes over texts which cannot hold the symbol.

    A document whose symbol equals the ASCII `symbol` in any case contains it
    in its own text, unless written with escapes; those are let through. Spares
    the JSON parse for the other coins' rows.
    """
    if not symbol.isascii() or not symbol:
        return F.lit(True)
    return F.lower(payload).contains(symbol) | payload.contains("\\")
