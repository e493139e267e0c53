"""Silver models: newest document per coin, as typed columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.json import (
    as_bigint,
    as_double,
    is_malformed,
    json_pairs,
    parse_payload,
    with_scalars,
)
from marlstone.functions.time import epoch_millis
from marlstone.operators.latest import keep_newest_days, latest_per_key
from marlstone.schemas import PARTITION_COLUMN

# Where the documents hold the silver columns.
MARKET_PATHS = {
    "symbol": "$.symbol",
    "name": "$.name",
    "market_cap_rank": "$.market_cap_rank",
    "current_price": "$.current_price",
    "market_cap": "$.market_cap",
    "total_volume": "$.total_volume",
    "price_change_24h_pct": "$.price_change_percentage_24h",
}
COIN_DETAIL_PATHS = {
    "symbol": "$.symbol",
    "name": "$.name",
    "hashing_algorithm": "$.hashing_algorithm",
    "genesis_date": "$.genesis_date",
    "homepage": "$.links.homepage[0]",
    "current_price_usd": "$.market_data.current_price.usd",
    "market_cap_usd": "$.market_data.market_cap.usd",
    "total_volume_usd": "$.market_data.total_volume.usd",
    "price_change_24h_pct": "$.market_data.price_change_percentage_24h",
    "twitter_followers": "$.community_data.twitter_followers",
}


def newest_documents(
    raw: DataFrame, strict: bool = True, skip_days: bool = False
) -> DataFrame:
    """The newest bronze row per coin.

    Equal ingestion times (a retried append) are decided by the source's own
    update time and then by the payload text. `skip_days` first narrows a
    day-partitioned table to the days that can hold a newest row, at the price of
    a pass over the coins.

    When not strict, a coin's last good document stands in for a broken newest
    one. Only the coins concerned have all their documents read; `quarantined`
    returns every malformed row.
    """
    if skip_days and PARTITION_COLUMN in raw.columns:
        narrowed = keep_newest_days(raw, ["coin_id"], PARTITION_COLUMN)
    else:
        narrowed = raw
    newest = _newest(narrowed)
    if strict:
        return newest
    broken = newest.where(is_malformed("payload")).select("coin_id")
    again = raw.join(broken, raw["coin_id"].eqNullSafe(broken["coin_id"]), "left_semi")
    good = newest.where(~is_malformed("payload"))
    return good.unionByName(_newest(again.where(~is_malformed("payload"))))


def _newest(raw: DataFrame) -> DataFrame:
    return latest_per_key(
        raw.select("coin_id", "source_updated_at", "ingested_at", "payload"),
        keys=["coin_id"],
        newest_by=["ingested_at"],
        tie_breakers=["source_updated_at", "payload"],
    )


def quarantined(raw: DataFrame) -> DataFrame:
    """The bronze rows whose payload is not valid JSON."""
    return raw.where(is_malformed("payload"))


def quarantined_prices(raw_historical_prices: DataFrame) -> DataFrame:
    """The bronze rows whose payload is malformed or has prices that are no array.

    Missing and null prices are a coin without points, not an error.
    """
    node = "variant_get(try_parse_json(payload), '$.prices', 'variant')"
    odd = F.expr(f"coalesce(left(schema_of_variant({node}), 5) NOT IN ('ARRAY', 'VOID'), false)")
    return raw_historical_prices.where(is_malformed("payload") | odd)


def quarantined_points(raw_historical_prices: DataFrame) -> DataFrame:
    """coin_id, ingested_at and text of points that lenient mode cannot read whole.

    They are the newest documents' points that are no array, have fewer than two
    elements, or hold an element that is neither null nor a number.
    """
    documents = _parsed(newest_documents(raw_historical_prices, strict=False), False)
    points = documents.select(
        "coin_id",
        "ingested_at",
        F.explode(
            F.try_variant_get("doc", "$.prices", "array<variant>")
        ).alias("point"),
    )
    pair = F.try_variant_get("point", "$", "array<variant>")
    unread = F.exists(
        F.slice(pair, 1, 2),
        lambda v: (F.schema_of_variant(v) != "VOID")
        & F.try_variant_get(v, "$", "double").isNull(),
    )
    bad = pair.isNull() | (F.size(pair) < 2) | unread
    return points.where(F.coalesce(bad, F.lit(True))).select(
        "coin_id", "ingested_at", F.col("point").cast("string").alias("point")
    )


def market_columns(documents: DataFrame, strict: bool = True) -> DataFrame:
    """Typed columns of market documents, one row in, one row out."""
    fields = with_scalars(_parsed(documents, strict), "doc", MARKET_PATHS)
    return fields.select(
        "coin_id",
        "symbol",
        "name",
        as_bigint("market_cap_rank", strict).alias("market_cap_rank"),
        as_double("current_price", strict).alias("current_price"),
        as_double("market_cap", strict).alias("market_cap"),
        as_double("total_volume", strict).alias("total_volume"),
        as_double("price_change_24h_pct", strict).alias("price_change_24h_pct"),
        "ingested_at",
    )


def stg_markets(
    raw_markets: DataFrame, strict: bool = True, skip_days: bool = False
) -> DataFrame:
    return market_columns(newest_documents(raw_markets, strict, skip_days), strict)


def coin_detail_columns(documents: DataFrame, strict: bool = True) -> DataFrame:
    """Typed columns of coin detail documents, one row in, one row out."""
    fields = with_scalars(_parsed(documents, strict), "doc", COIN_DETAIL_PATHS)
    return fields.select(
        "coin_id",
        "symbol",
        "name",
        "hashing_algorithm",
        "genesis_date",
        "homepage",
        as_double("current_price_usd", strict).alias("current_price_usd"),
        as_double("market_cap_usd", strict).alias("market_cap_usd"),
        as_double("total_volume_usd", strict).alias("total_volume_usd"),
        as_double("price_change_24h_pct", strict).alias("price_change_24h_pct"),
        as_bigint("twitter_followers", strict).alias("twitter_followers"),
        "ingested_at",
    )


def stg_coin_details(
    raw_coin_details: DataFrame, strict: bool = True, skip_days: bool = False
) -> DataFrame:
    documents = newest_documents(raw_coin_details, strict, skip_days)
    return coin_detail_columns(documents, strict)


def stg_historical_prices(
    raw_historical_prices: DataFrame,
    strict: bool = True,
    ordered: bool = True,
    skip_days: bool = False,
) -> DataFrame:
    """One row per price point of each coin's newest payload.

    The choice comes before the unnesting, so stale payloads are never parsed.
    For the order by coin and time, the payloads are put into coin ranges while
    still packed; their points then only need sorting within each range.
    """
    newest = newest_documents(raw_historical_prices, strict, skip_days)
    if ordered:
        newest = newest.repartitionByRange("coin_id")
    points = price_points(newest, strict)
    if not ordered:
        return points
    return points.sortWithinPartitions("coin_id", F.asc_nulls_last("price_timestamp"))


def price_points(documents: DataFrame, strict: bool = True) -> DataFrame:
    """One row per price point of historical price documents."""
    unnested = _parsed(documents, strict).select(
        "coin_id",
        "ingested_at",
        F.explode(json_pairs("doc", "$.prices", strict)).alias("point"),
    )
    at = F.element_at if strict else F.try_element_at
    return unnested.select(
        "coin_id",
        epoch_millis(at("point", F.lit(1))).alias("price_timestamp"),
        at("point", F.lit(2)).alias("price_usd"),
        "ingested_at",
    )


def _parsed(documents: DataFrame, strict: bool) -> DataFrame:
    """Replace the payload by its VARIANT, in a projection of its own."""
    return documents.select(
        "coin_id", "ingested_at", parse_payload("payload", strict).alias("doc")
    )
