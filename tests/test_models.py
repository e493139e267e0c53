"""Silver and gold models on hand-written edge rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marlstone.functions.time import utc_wall_clock
from marlstone.plans import gold, silver

T1 = "2026-03-01T05:17:08.000001+00:00"
T2 = "2026-03-01T05:19:08.000001+00:00"


def market(**fields):
    return json.dumps({"symbol": "btc", "name": "Bitcoin", **fields})


def prices(*pairs):
    return json.dumps({"prices": list(pairs)})


# -- silver -------------------------------------------------------------------


def test_stg_markets_columns_and_types(bronze):
    full = market(
        market_cap_rank=1, current_price=62000.5, market_cap=1200000000000,
        total_volume=3.5e10, price_change_percentage_24h=-1.25, extra={"x": [1]},
    )
    got = silver.stg_markets(bronze(("bitcoin", T1, full)))
    assert dict(got.dtypes) == {
        "coin_id": "string", "symbol": "string", "name": "string",
        "market_cap_rank": "bigint", "current_price": "double", "market_cap": "double",
        "total_volume": "double", "price_change_24h_pct": "double",
        "ingested_at": "string",
    }
    assert tuple(got.first()) == (
        "bitcoin", "btc", "Bitcoin", 1, 62000.5, 1.2e12, 3.5e10, -1.25, T1,
    )


def test_strict_and_lenient_numbers(bronze):
    raw = bronze(("btc", T1, market(current_price="abc")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.stg_markets(raw).collect()
    assert silver.stg_markets(raw, strict=False).first().current_price is None


def test_strict_and_lenient_documents(bronze):
    raw = bronze(
        ("btc", T1, market(current_price=1)), ("btc", T2, "{bad"), ("eth", T1, "{bad")
    )
    with pytest.raises(Exception, match="MALFORMED"):
        silver.stg_markets(raw).collect()
    lenient = silver.stg_markets(raw, strict=False).collect()
    assert [(r.coin_id, r.ingested_at) for r in lenient] == [("btc", T1)]
    aside = sorted((r.coin_id, r.ingested_at) for r in silver.quarantined(raw).collect())
    assert aside == [("btc", T2), ("eth", T1)]


def test_stg_coin_details(bronze):
    doc = json.dumps(
        {
            "symbol": "btc", "name": "Bitcoin", "hashing_algorithm": "SHA-256",
            "genesis_date": "2009-01-03", "links": {"homepage": ["http://a", ""]},
            "market_data": {
                "current_price": {"usd": 5, "eur": 4}, "market_cap": {"usd": 50},
                "total_volume": {"usd": 7.5}, "price_change_percentage_24h": 0.5,
            },
            "community_data": {"twitter_followers": 12},
        }
    )
    bare = json.dumps({"links": {"homepage": []}, "market_data": {"current_price": {}}})
    got = silver.stg_coin_details(bronze(("bitcoin", T1, doc), ("x", T1, bare)))
    rows = {r.coin_id: tuple(r)[1:-1] for r in got.collect()}
    assert rows["bitcoin"] == (
        "btc", "Bitcoin", "SHA-256", "2009-01-03", "http://a", 5.0, 50.0, 7.5, 0.5, 12,
    )
    assert rows["x"] == (None,) * 10


@pytest.mark.parametrize("text", ["{}", '{"prices": null}', '{"prices": []}'])
def test_no_prices_no_rows(bronze, text):
    assert silver.stg_historical_prices(bronze(("btc", T1, text))).count() == 0


@pytest.mark.parametrize("ordered", [True, False])
def test_price_points_of_the_newest_payload(bronze, ordered):
    raw = bronze(
        ("btc", T1, prices([1, 1.0], [2, 2.0])),
        ("btc", T2, prices([1709427600000, None], [1709424000123, 62000.5])),
        ("eth", T1, prices([1709424000000, 3.0])),
    )
    got = silver.stg_historical_prices(raw, ordered=ordered).select(
        "coin_id", utc_wall_clock(F.col("price_timestamp")), "price_usd", "ingested_at"
    )
    rows = [tuple(r) for r in got.collect()]
    assert (rows if ordered else sorted(rows, key=str)) == [
        ("btc", dt.datetime(2024, 3, 3, 0, 0, 0, 123000), 62000.5, T2),
        ("btc", dt.datetime(2024, 3, 3, 1), None, T2),
        ("eth", dt.datetime(2024, 3, 3), 3.0, T1),
    ]


def test_short_pair(bronze):
    raw = bronze(("btc", T1, prices([1709427600001])))
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        silver.stg_historical_prices(raw).collect()
    assert silver.stg_historical_prices(raw, strict=False).first().price_usd is None


def test_points_come_back_as_they_went_in(bronze):
    series = [[1709424000000 + 60_000 * i, i / 8] for i in range(500)]
    got = silver.stg_historical_prices(bronze(("btc", T1, prices(*series))))
    millis = F.unix_millis("price_timestamp")
    assert [[r[0], r[1]] for r in got.select(millis, "price_usd").collect()] == series


# -- gold ---------------------------------------------------------------------


def staged(spark, *rows):
    """(coin_id, symbol, rank, market_cap, volume, change) as stg_markets."""
    return spark.createDataFrame(
        [(c, s, s.upper(), r, 1.0, m, v, p, T1) for c, s, r, m, v, p in rows],
        "coin_id string, symbol string, name string, market_cap_rank bigint, "
        "current_price double, market_cap double, total_volume double, "
        "price_change_24h_pct double, ingested_at string",
    )


@pytest.mark.parametrize(
    "change, shown, trend",
    [
        (0.001, 0.0, "up"), (-0.001, 0.0, "down"), (0.0, 0.0, "stable"),
        (None, None, "stable"), (1.005, 1.0, "up"), (-0.125, -0.13, "down"),
    ],
)
def test_trend_is_of_the_unrounded_change(spark, change, shown, trend):
    row = gold.market_summary(staged(spark, ("c", "s", 1, 1.0, 1.0, change))).first()
    assert (row.price_change_24h_pct, row.price_trend) == (shown, trend)


def test_trend_of_nan_is_stable(spark):
    stg = staged(spark, ("c", "s", 1, 1.0, 1.0, float("nan")))
    assert gold.market_summary(stg).first().price_trend == "stable"


def test_summary_figures_and_order(spark):
    stg = staged(
        spark,
        ("d", "d", None, None, 2.0, 0.0),
        ("b", "b", 2, 0.0, 2.0, 0.0),
        ("c", "c", 2, 3.0e9, 1.0e9, 0.0),
        ("a", "a", 1, 1.255e12, 2.5e9, 0.0),
    )
    got = gold.market_summary(stg).collect()
    assert [r.symbol for r in got] == ["a", "b", "c", "d"]
    assert [r.volume_to_mcap_ratio for r in got] == [0.002, None, 0.3333, None]
    assert got[0].market_cap_billions == 1255.0
    assert "coin_id" not in got[0] and len(got[0]) == 10
    with_id = gold.market_summary(stg, with_coin_id=True).collect()
    assert [r.coin_id for r in with_id] == ["a", "b", "c", "d"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_price_history_days_are_utc(spark, bronze, in_zone, zone):
    in_zone(zone)
    midnight = 1709424000000
    raw = bronze(
        ("btc", T1, prices([midnight - 1, 1.0], [midnight, 2.0], [midnight + 9, None]))
    )
    got = gold.price_history(silver.stg_historical_prices(raw)).collect()
    assert [tuple(r) for r in got] == [
        ("btc", dt.date(2024, 3, 2), 1.0, 1.0, 1.0, 0.0, 1, T1),
        ("btc", dt.date(2024, 3, 3), 2.0, 2.0, 2.0, 0.0, 2, T1),
    ]


def test_price_history_rounds_after_subtracting(spark, bronze):
    raw = bronze(("c", T1, prices([0, 0.004], [1, 0.016], [2, 0.006])))
    row = gold.price_history(silver.stg_historical_prices(raw)).first()
    assert (row.low_price, row.high_price, row.price_range) == (0.0, 0.02, 0.01)
    assert row.low_price <= row.avg_price <= row.high_price


def watch(spark, *rows):
    return spark.createDataFrame(
        [(u, c, dt.datetime(2026, 1, 1)) for u, c in rows],
        "user_id bigint, coin_id string, added_at timestamp",
    )


def users(spark, *ids):
    return spark.createDataFrame(
        [(i, f"user{i}") for i in ids], "user_id bigint, username string"
    )


def test_watchlist_matches_symbols_exactly(spark):
    summary = gold.market_summary(staged(spark, ("bitcoin", "btc", 1, 1.0, 1.0, 0.5)))
    lists = watch(spark, (1, "btc"), (1, "bitcoin"), (1, "BTC"), (2, "btc"))
    got = gold.watchlist_enriched(lists, users(spark, 1), summary)
    assert got.columns == [
        "user_id", "username", "coin_id", "coin_name", "current_price",
        "market_cap_billions", "price_change_24h_pct", "price_trend", "added_at",
    ]
    # User 2 has no profile.
    assert [(r.user_id, r.coin_id, r.coin_name) for r in got.collect()] == [
        (1, "btc", "BTC")
    ]


def test_watchlist_by_symbol_repeats_shared_symbols_and_by_id_does_not(spark):
    stg = staged(spark, ("one", "x", 1, 1.0, 1.0, 0.0), ("two", "x", 2, 1.0, 1.0, 0.0))
    people = users(spark, 1)
    by_symbol = gold.watchlist_enriched(
        watch(spark, (1, "x")), people, gold.market_summary(stg)
    )
    assert by_symbol.count() == 2
    by_id = gold.watchlist_enriched(
        watch(spark, (1, "two")), people, gold.market_summary(stg, True), on="coin_id"
    )
    assert by_id.count() == 1


def test_watchlist_of_a_hot_coin_is_whole(spark):
    stg = staged(spark, *[(f"c{i}", f"s{i}", i, 1.0, 1.0, 0.0) for i in range(20)])
    lists = spark.range(30_000).select(
        (F.col("id") % 100).alias("user_id"),
        F.when(F.col("id") % 3 == 0, "s0")
        .otherwise(F.concat(F.lit("s"), F.col("id") % 20))
        .alias("coin_id"),
        F.lit(dt.datetime(2026, 1, 1)).alias("added_at"),
    )
    got = gold.watchlist_enriched(
        lists, users(spark, *range(100)), gold.market_summary(stg)
    )
    assert got.count() == 30_000


def test_price_payloads_leave_out_points_without_a_part(spark):
    """Both texts are made of one list: a NULL time has no pair, a NULL value none to keep."""
    from marlstone import bindings as B

    at = "timestamp_ntz'2024-01-01 00:00:01'"
    events = spark.sql(
        f"SELECT * FROM VALUES (1L, 7L, {at}, 1.5D), (2L, 7L, {at}, NULL), (3L, 7L, NULL, 2D),"
        f" (600L, 8L, NULL, 2D), (4L, NULL, {at}, 0.1D) AS t(event_id, user_id, ts, value)"
    )
    responses = B.historical_price_responses(events)
    lists = [f.name for f in responses.schema if f.name.startswith("_")]
    assert not lists and str(responses._jdf.queryExecution().analyzed()).count("collect_list(") == 1
    found = sorted((r.coin_id, r.ingested_at == B.LOADED_AT, r.value) for r in responses.collect())
    assert found == [
        ("0", False, '{"prices":[[1704067201000,-1]]}'),
        ("0", True, '{"prices":[[1704067201000,0.1]]}'),
        ("7-0", False, '{"prices":[[1704067201000,-1],[1704067201000,-1]]}'),
        ("7-0", True, '{"prices":[[1704067201000,1.5]]}'),
        ("8-1", False, '{"prices":[]}'),
        ("8-1", True, '{"prices":[]}'),
    ]
