"""Refresh jobs: rebuild models in dependency order and commit them together."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone import schemas as S
from marlstone.plans import checks, gold, serve, silver, symbols
from marlstone.sources.tables import (
    BRONZE_LAYER,
    GOLD_LAYER,
    SILVER_LAYER,
    Version,
    Warehouse,
)

_SILVER = [
    (S.STG_MARKETS, S.RAW_MARKETS, silver.stg_markets, ["coin_id"]),
    (S.STG_COIN_DETAILS, S.RAW_COIN_DETAILS, silver.stg_coin_details, ["coin_id"]),
    # Its ranges are made of packed documents, before their points are unnested.
    (S.STG_HISTORICAL_PRICES, S.RAW_HISTORICAL_PRICES, silver.stg_historical_prices, None),
]

# What the files of the marts are ranges of.
_SUMMARY_BY = ["market_cap_rank", "symbol"]
_HISTORY_BY = ["coin_id", "price_date"]
_WATCHED_BY = ["user_id", "coin_id"]


def _write_silver(wh: Warehouse, strict: bool) -> list[Version]:
    """The three staging tables; they are independent, so Spark gets all three
    jobs at once and one's tail does not leave the cluster idle."""
    wh.create_layers()

    def rebuild(model):
        table, source, build, cluster_by = model
        rows = build(wh.table(BRONZE_LAYER, source), strict=strict)
        return wh.write(SILVER_LAYER, table, rows, cluster_by)

    return wh.at_once(rebuild, _SILVER)


def _write_summary(wh: Warehouse, markets: DataFrame) -> Version:
    rows = gold.market_summary(markets, ordered=False)
    return wh.write(GOLD_LAYER, S.MART_MARKET_SUMMARY, rows, _SUMMARY_BY)


def _write_gold(
    wh: Warehouse,
    markets: DataFrame,
    prices: DataFrame,
    user_watchlists: DataFrame | None,
    user_profiles: DataFrame | None,
    watch_on: str,
) -> list[Version]:
    written = [_write_summary(wh, markets)]
    history = gold.price_history(prices, ordered=False)
    written.append(wh.write(GOLD_LAYER, S.MART_PRICE_HISTORY, history, _HISTORY_BY))
    if user_watchlists is None or user_profiles is None:
        return written
    summary = wh.read(written[0])
    if watch_on == "coin_id":
        summary = gold.market_summary(markets, with_coin_id=True, ordered=False)
    watched = gold.watchlist_enriched(user_watchlists, user_profiles, summary, watch_on)
    return [*written, wh.write(GOLD_LAYER, S.MART_WATCHLIST_ENRICHED, watched, _WATCHED_BY)]


def refresh_silver(wh: Warehouse, strict: bool = True) -> None:
    """Rebuild the three staging tables and commit them together."""
    wh.commit(_write_silver(wh, strict))


def refresh_gold(
    wh: Warehouse,
    user_watchlists: DataFrame | None = None,
    user_profiles: DataFrame | None = None,
    watch_on: str = "symbol",
) -> None:
    """Rebuild the marts from one generation of the staging tables; the watchlist
    mart only where its tables are given.

    `watch_on="coin_id"` matches watchlists by the coin's id instead.
    """
    now = wh.snapshot()
    markets = now.table(SILVER_LAYER, S.STG_MARKETS)
    prices = now.table(SILVER_LAYER, S.STG_HISTORICAL_PRICES)
    wh.commit(_write_gold(wh, markets, prices, user_watchlists, user_profiles, watch_on))


def refresh_live(wh: Warehouse, strict: bool = True, checked: bool = False) -> DataFrame:
    """Rebuild only the market tables, the ones a live view needs.

    `checked` commits them only if there are rows, each of one coin with an id.
    """
    raw = wh.table(BRONZE_LAYER, S.RAW_MARKETS)
    rows = silver.stg_markets(raw, strict)
    if checked:
        markets, report = checks.write_checked(
            wh, SILVER_LAYER, S.STG_MARKETS, rows, ["coin_id"], ["coin_id"], ["coin_id"]
        )
        failed = checks.failed_checks(report).collect()
        if failed:
            raise ValueError(f"not committed: {[r.asDict() for r in failed]}")
    else:
        markets = wh.write(SILVER_LAYER, S.STG_MARKETS, rows, ["coin_id"])
    wh.commit([markets, _write_summary(wh, wh.read(markets))])
    return wh.table(GOLD_LAYER, S.MART_MARKET_SUMMARY)


def refresh_all(
    wh: Warehouse,
    user_watchlists: DataFrame | None = None,
    user_profiles: DataFrame | None = None,
    watch_on: str = "symbol",
    strict: bool = True,
) -> int:
    """Rebuild all models; readers see them as one generation, whose number it returns."""
    staged = _write_silver(wh, strict)
    markets, prices = wh.read(staged[0]), wh.read(staged[2])
    marts = _write_gold(wh, markets, prices, user_watchlists, user_profiles, watch_on)
    return wh.commit(staged + marts)


def newest_live_prices(
    wh: Warehouse, symbol: str, n: int = serve.LIVE_POINTS
) -> DataFrame:
    """serve.live_prices over as few of the newest days as hold n observations.

    Exact: once n are found, every other day is older than all of them. A
    symbol seen in each batch needs one day's files instead of the whole table;
    one that is rare or gone widens the range fourfold at a time, and each step
    reads the added days only. The rows found, n at most, are kept by the driver.
    Where the table of symbols is kept (`symbols.refresh_symbols`), rows of other
    coins are skipped by the files' statistics and Bloom filters.
    """
    raw, _ = symbols.rows_of_symbol(wh, symbol)
    days, found, done, width = wh.days(S.RAW_MARKETS), [], 0, 1
    schema = serve.live_prices(raw, symbol, n).schema
    while done < len(days) and len(found) < n:
        added = F.col(S.PARTITION_COLUMN).between(
            F.lit(days[min(width, len(days)) - 1]), F.lit(days[done])
        )
        step = serve.live_prices(raw.where(added), symbol, n - len(found))
        found = step.collect() + found
        done, width = width, 4 * width
    return wh.spark.createDataFrame(found, schema)
