"""Bronze-shaped frames and tables derived from the test tables.

Spark builds every document from the given columns, row by row or, for price
series, in groups whose size is bounded by construction, so that the work grows
with the tables and no group grows with them.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.time import from_utc_wall_clock, iso_date, iso_wall_clock
from marlstone.schemas import PARTITION_COLUMN

# Ingestion times of tables whose rows carry none.
LOADED_AT = "2024-02-01T00:00:00.000000+00:00"
LOADED_BEFORE = "2024-01-01T00:00:00.000000+00:00"

# Events per price-series chunk: event_id is unique, so a payload holds at most
# this many points however many events one user has.
POINTS_PER_PAYLOAD = 512

# Events per landed response, the most one response can hold.
EVENTS_PER_RESPONSE = 400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def market_document(symbol: Column) -> Column:
    """A market document of one event, as JSON text."""
    return F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("id"),
            symbol.alias("symbol"),
            F.col("event_type").alias("name"),
            F.col("event_id").alias("market_cap_rank"),
            F.col("value").alias("current_price"),
            (F.col("value") * 1e6).alias("market_cap"),
            (F.col("value") * 1e5).alias("total_volume"),
            (F.col("value") - 50).alias("price_change_percentage_24h"),
        )
    )


def unique_symbol() -> Column:
    return F.concat(F.lit("u"), F.col("user_id"))


def raw_markets(events: DataFrame, symbol: Column | None = None) -> DataFrame:
    """One market observation per event: coin = user, symbol = event type."""
    return events.select(
        F.col("user_id").cast("string").alias("coin_id"),
        F.lit(None).cast("string").alias("source_updated_at"),
        iso_wall_clock(F.col("ts")).alias("ingested_at"),
        market_document(F.col("event_type") if symbol is None else symbol).alias(
            "payload"
        ),
    )


def with_day(raw: DataFrame) -> DataFrame:
    return raw.withColumn(PARTITION_COLUMN, iso_date(F.col("ingested_at")))


def market_responses(events: DataFrame) -> DataFrame:
    """Landed responses: arrays of market documents, up to 400 in each."""
    return (
        events.groupBy(F.floor(F.col("event_id") / EVENTS_PER_RESPONSE).alias("_page"))
        .agg(F.collect_list(market_document(F.col("event_type"))).alias("_documents"))
        .select(
            F.concat(
                F.lit("["), F.concat_ws(",", "_documents"), F.lit("]")
            ).alias("value")
        )
    )


def coin_detail_responses(part: DataFrame) -> DataFrame:
    """One nested details document per part; community data is left out."""

    def usd(value: Column) -> Column:
        return F.struct(value.alias("usd"))

    price = F.col("p_retailprice")
    return part.select(
        F.col("p_partkey").cast("string").alias("coin_id"),
        F.to_json(
            F.struct(
                F.lower("p_brand").alias("symbol"),
                F.col("p_name").alias("name"),
                F.col("p_type").alias("hashing_algorithm"),
                F.lit(None).cast("string").alias("genesis_date"),
                F.concat(F.lit("u"), F.col("p_size")).alias("last_updated"),
                F.struct(F.array("p_name", "p_brand").alias("homepage")).alias("links"),
                F.struct(
                    usd(price).alias("current_price"),
                    usd(price * 1e6).alias("market_cap"),
                    usd(price * 1e5).alias("total_volume"),
                    (price - 1000).alias("price_change_percentage_24h"),
                ).alias("market_data"),
            ),
            {"ignoreNullFields": "false"},
        ).alias("value"),
    )


def historical_price_responses(events: DataFrame) -> DataFrame:
    """Two price payloads per (user, chunk of events): a stale one, then the
    one to keep. Columns: coin_id = `<user>-<chunk>`, value, ingested_at."""
    point = F.struct(
        F.unix_millis(from_utc_wall_clock(F.col("ts"))).alias("at"),
        F.col("value").alias("price"),
    )
    # Numbers are brought together once, both texts are made of them afterwards.
    chunks = events.groupBy(
        "user_id", F.floor(F.col("event_id") / POINTS_PER_PAYLOAD).alias("_chunk")
    ).agg(F.collect_list(point).alias("_points"))

    def payload(ingested_at: str, pair: Callable[[Column], Column]) -> Column:
        # concat_ws leaves out the pairs that are NULL, as a part of them is.
        pairs = F.concat_ws(",", F.transform("_points", pair))
        text = F.concat(F.lit('{"prices":['), pairs, F.lit("]}"))
        return F.struct(F.lit(ingested_at).alias("ingested_at"), text.alias("value"))

    def kept(p: Column) -> Column:
        return F.concat(F.lit("["), p["at"], F.lit(","), p["price"], F.lit("]"))

    def stale(p: Column) -> Column:
        return F.concat(F.lit("["), p["at"], F.lit(",-1]"))

    return chunks.select(
        F.concat_ws("-", "user_id", "_chunk").alias("coin_id"),
        F.inline(F.array(payload(LOADED_BEFORE, stale), payload(LOADED_AT, kept))),
    )


def raw_historical_prices(events: DataFrame) -> DataFrame:
    return historical_price_responses(events).select(
        "coin_id",
        F.lit(None).cast("string").alias("source_updated_at"),
        "ingested_at",
        F.col("value").alias("payload"),
    )


def lineitem_prices(lineitem: DataFrame) -> DataFrame:
    """Line items as silver price points: coin = part."""
    return lineitem.select(
        F.col("l_partkey").cast("string").alias("coin_id"),
        from_utc_wall_clock(F.col("l_shipdate")).alias("price_timestamp"),
        F.col("l_extendedprice").alias("price_usd"),
        F.lit(LOADED_AT).alias("ingested_at"),
    )


def brand_watchlists(orders: DataFrame) -> DataFrame:
    """One watchlist row per order; brands 26 to 30 match no part."""
    return orders.select(
        F.col("o_custkey").alias("user_id"),
        F.concat(F.lit("Brand#"), 1 + F.col("o_orderkey") % 30).alias("coin_id"),
        F.col("o_orderdate").alias("added_at"),
    )


def user_watchlists(orders: DataFrame) -> DataFrame:
    """One watchlist row per order, watching the coin symbol of its customer."""
    return orders.select(
        F.col("o_custkey").alias("user_id"),
        F.concat(F.lit("u"), F.col("o_custkey")).alias("coin_id"),
        F.col("o_orderdate").alias("added_at"),
    )


def user_profiles(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("username")
    )


def brand_markets(part: DataFrame) -> DataFrame:
    """One staged market row per brand, which serves as its symbol."""
    price = F.col("_price")
    return (
        part.groupBy(F.col("p_brand").alias("symbol"))
        .agg(
            F.max("p_retailprice").alias("_price"),
            F.max("p_type").alias("name"),
            F.count(F.lit(1)).alias("market_cap_rank"),
        )
        .select(
            F.concat(F.lit("id-"), "symbol").alias("coin_id"),
            "symbol",
            "name",
            "market_cap_rank",
            price.alias("current_price"),
            (price * 1e6).alias("market_cap"),
            (price * 1e5).alias("total_volume"),
            (price - 1000).alias("price_change_24h_pct"),
            F.lit(LOADED_AT).alias("ingested_at"),
        )
    )
