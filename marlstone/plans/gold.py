"""Gold marts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.numeric import (
    avg_of,
    billions,
    exact_sum,
    exact_term,
    round_half_up,
    safe_ratio,
    stable_avg,
)
from marlstone.functions.time import utc_date
from marlstone.operators.trend import trend_of


def market_summary(
    stg_markets: DataFrame, with_coin_id: bool = False, ordered: bool = True
) -> DataFrame:
    """One row per coin, best market rank first, unranked coins last.

    `with_coin_id` adds the id the plain mart leaves out, for joins that must
    not rely on symbols being unique. The id also settles the order of equal
    ranks, and lets the sort spread a rank that many coins share.
    """
    change = F.col("price_change_24h_pct")
    if ordered:
        stg_markets = stg_markets.orderBy(F.asc_nulls_last("market_cap_rank"), "coin_id")
    return stg_markets.select(
        *(["coin_id"] if with_coin_id else []),
        "market_cap_rank",
        "name",
        "symbol",
        "current_price",
        round_half_up(billions(F.col("market_cap")), 2).alias("market_cap_billions"),
        round_half_up(billions(F.col("total_volume")), 2).alias("volume_billions"),
        round_half_up(change, 2).alias("price_change_24h_pct"),
        # The sign of the value as read: 0.001 shows as 0.0 and is still 'up'.
        trend_of(change).alias("price_trend"),
        round_half_up(
            safe_ratio(F.col("total_volume"), F.col("market_cap")), 4
        ).alias("volume_to_mcap_ratio"),
        "ingested_at",
    )


def price_history(
    stg_historical_prices: DataFrame, ordered: bool = True, strict: bool = True
) -> DataFrame:
    """Low, high, average and range per coin and UTC day.

    Points without a price count as data points and nowhere else.
    """
    price = F.col("price_usd")
    history = (
        stg_historical_prices.groupBy(
            "coin_id",
            utc_date(F.col("price_timestamp")).alias("price_date"),
            "ingested_at",
        )
        .agg(
            round_half_up(F.min(price), 2).alias("low_price"),
            round_half_up(F.max(price), 2).alias("high_price"),
            round_half_up(stable_avg(price, strict), 2).alias("avg_price"),
            round_half_up(F.max(price) - F.min(price), 2).alias("price_range"),
            F.count(F.lit(1)).alias("data_points"),
        )
        .select(
            "coin_id",
            "price_date",
            "low_price",
            "high_price",
            "avg_price",
            "price_range",
            "data_points",
            "ingested_at",
        )
    )
    if not ordered:
        return history
    return history.orderBy("coin_id", F.asc_nulls_last("price_date"), "ingested_at")


HISTORY_KEYS = ["coin_id", "price_date", "ingested_at"]


def history_parts(stg_historical_prices: DataFrame, strict: bool = True) -> DataFrame:
    """Partial figures per coin, UTC day and payload that can be merged with others.

    Extremes, an exact decimal sum, and counts of prices and points: whichever way
    the points of a group are divided, merging the parts gives the same.
    """
    price = F.col("price_usd")
    return stg_historical_prices.groupBy(
        "coin_id",
        utc_date(F.col("price_timestamp")).alias("price_date"),
        "ingested_at",
    ).agg(
        F.min(price).alias("_low"),
        F.max(price).alias("_high"),
        exact_sum(price, strict).alias("_sum"),
        F.count(exact_term(price, strict)).alias("_prices"),
        F.count(F.lit(1)).alias("_points"),
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    """One row per coin, day and payload from parts of any number of groups."""
    return parts.groupBy(*HISTORY_KEYS).agg(
        F.min("_low").alias("_low"),
        F.max("_high").alias("_high"),
        F.sum("_sum").alias("_sum"),
        F.sum("_prices").alias("_prices"),
        F.sum("_points").alias("_points"),
    )


def history_figures(parts: DataFrame) -> DataFrame:
    """The price history's columns of merged parts, beside the parts themselves."""
    return parts.select(
        "coin_id",
        "price_date",
        round_half_up(F.col("_low"), 2).alias("low_price"),
        round_half_up(F.col("_high"), 2).alias("high_price"),
        round_half_up(avg_of(F.col("_sum"), F.col("_prices")), 2).alias("avg_price"),
        round_half_up(F.col("_high") - F.col("_low"), 2).alias("price_range"),
        F.col("_points").alias("data_points"),
        "ingested_at",
        "_low",
        "_high",
        "_sum",
        "_prices",
        "_points",
    )


def watchlist_enriched(
    user_watchlists: DataFrame,
    user_profiles: DataFrame,
    summary: DataFrame,
    on: str = "symbol",
) -> DataFrame:
    """Watched coins with the user's name and the coin's current figures.

    A watchlist's coin_id is matched against the summary's `on` column:
    "symbol" as the mart is defined, or "coin_id" on a summary that carries it.

    No side is forced into a broadcast. Spark broadcasts the summary when its
    measured size allows that and otherwise sort-merges, where AQE splits the
    partitions of a heavily watched coin.
    """
    coins = summary.select(
        F.col(on).alias("_coin_key"),
        F.col("name").alias("coin_name"),
        "current_price",
        "market_cap_billions",
        "price_change_24h_pct",
        "price_trend",
    )
    watched = user_watchlists.select("user_id", "coin_id", "added_at")
    users = user_profiles.select("user_id", "username")
    return (
        watched.join(users, "user_id")
        .join(coins, F.col("coin_id") == F.col("_coin_key"))
        .select(
            "user_id",
            "username",
            "coin_id",
            "coin_name",
            "current_price",
            "market_cap_billions",
            "price_change_24h_pct",
            "price_trend",
            "added_at",
        )
    )
