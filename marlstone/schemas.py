"""Declared schemas. Nothing in this package is inferred from data."""

from pyspark.sql import types as T

# The bronze envelope, one shape for all bronze tables.
ENVELOPE = T.StructType(
    [
        T.StructField("coin_id", T.StringType(), False),
        T.StructField("source_updated_at", T.StringType(), True),
        T.StructField("ingested_at", T.StringType(), False),
        T.StructField("payload", T.StringType(), False),
    ]
)

# At rest the envelope carries the UTC calendar day of ingested_at as its
# partition column, so that date-bounded reads skip whole directories.
PARTITION_COLUMN = "ingest_date"
BRONZE = T.StructType(
    ENVELOPE.fields + [T.StructField(PARTITION_COLUMN, T.DateType(), False)]
)

# In a table kept by batch a row also carries when its batch was appended, and the
# batch is a partition of its day.
ARRIVED_AT = "arrived_at"
BATCH_COLUMN = "batch_id"
BATCHED = T.StructType(
    ENVELOPE.fields
    + [
        T.StructField(ARRIVED_AT, T.StringType(), False),
        T.StructField(PARTITION_COLUMN, T.DateType(), False),
        T.StructField(BATCH_COLUMN, T.StringType(), False),
    ]
)

REQUIRED = [f.name for f in ENVELOPE.fields if not f.nullable]

# Table names per layer.
RAW_MARKETS = "raw_markets"
RAW_COIN_DETAILS = "raw_coin_details"
RAW_HISTORICAL_PRICES = "raw_historical_prices"
BRONZE_TABLES = [RAW_MARKETS, RAW_COIN_DETAILS, RAW_HISTORICAL_PRICES]

STG_MARKETS = "stg_markets"
STG_COIN_DETAILS = "stg_coin_details"
STG_HISTORICAL_PRICES = "stg_historical_prices"

MART_MARKET_SUMMARY = "mart_market_summary"
MART_PRICE_HISTORY = "mart_price_history"
MART_WATCHLIST_ENRICHED = "mart_watchlist_enriched"
