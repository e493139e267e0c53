import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marlstone.plans import checks, serve

PRICE = '{{"symbol": "{}", "current_price": {}}}'


def at(minute, second=0):
    moment = dt.datetime(2026, 3, 1) + dt.timedelta(minutes=minute, seconds=second)
    return moment.strftime("%Y-%m-%dT%H:%M:%S.%f") + "+00:00"


def series(bronze, symbol, *prices):
    return bronze(
        *[("c", at(i), PRICE.format(symbol, p)) for i, p in enumerate(prices)]
    )


def test_live_prices_are_the_newest_sixty_oldest_first(bronze):
    raw = series(bronze, "btc", *range(61))
    got = [r.live_price for r in serve.live_prices(raw, "BTC").collect()]
    assert got == [float(i) for i in range(1, 61)]


@pytest.mark.parametrize("symbol", ["x' OR '1'='1", "et", "ethx", "", "%"])
def test_live_prices_of_other_symbols(bronze, symbol):
    assert serve.live_prices(series(bronze, "eth", 1, 2), symbol).count() == 0


@pytest.mark.parametrize(
    "payload",
    [
        '{"symbol": "ETH", "current_price": 1}',
        '{"symbol": "\\u0065th", "current_price": 1}',
        '{"current_price": "1", "symbol": "eTh"}',
    ],
)
def test_live_prices_find_a_symbol_however_it_is_written(bronze, payload):
    raw = bronze(("c", at(0), payload), ("d", at(0), '{"symbol": "x", "name": "eth"}'))
    assert [r.live_price for r in serve.live_prices(raw, "eth").collect()] == [1.0]


def test_live_prices_of_a_symbol_beyond_ascii(bronze):
    raw = series(bronze, "ÄTH", 1)
    assert serve.live_prices(raw, "äth").count() == 1


def test_live_prices_since_a_day(spark, bronze):
    raw = bronze(
        ("c", "2026-02-28T23:59:59.000000+00:00", PRICE.format("btc", 1)),
        ("c", "2026-03-01T00:00:00.000000+00:00", PRICE.format("btc", 2)),
    )
    with_day = raw.withColumn("ingest_date", F.substring("ingested_at", 1, 10).cast("date"))
    for frame in (raw, with_day):
        live = serve.live_prices(frame, "btc", since=dt.date(2026, 3, 1))
        assert [r.live_price for r in live.collect()] == [2.0]


@pytest.mark.parametrize(
    "prices, expected",
    [
        ([5], None), ([5, 7, 5], "up"), ([5, 9, 4], "down"), ([5, "null"], "down"),
        (["null", 5], "down"), ([5, 6], "up"),
    ],
)
def test_direction(bronze, prices, expected):
    live = serve.live_prices(series(bronze, "btc", *prices), "btc")
    got = [r.direction for r in serve.price_direction(live).collect()]
    assert got == ([expected] if expected else [])


def test_direction_of_all_symbols_equals_that_of_each(bronze):
    raw = series(bronze, "btc", *range(70)).union(series(bronze, "ETH", 3, 2)).union(
        bronze(("c", at(0), '{"current_price": 1}'), ("c", at(1), '{"current_price": 2}'))
    )
    every = serve.price_direction(serve.live_prices_by_symbol(raw), ["symbol"])
    got = {r.symbol: (r.n_points, r.first_value, r.last_value) for r in every.collect()}
    assert got == {"btc": (60, 10.0, 69.0), "eth": (2, 3.0, 2.0)}


def summary(spark, *rows):
    return spark.createDataFrame(
        [(r, n, s, 1.0, 2.0, 0.5, "up") for r, n, s in rows],
        "market_cap_rank bigint, name string, symbol string, current_price double, "
        "market_cap_billions double, price_change_24h_pct double, price_trend string",
    )


def test_dashboard_headings_and_order(spark):
    got = serve.dashboard_summary(summary(spark, (None, "Z", "z"), (2, "B", "b"), (1, "A", "a")))
    assert got.columns == [
        "Rank", "Coin", "Symbol", "Price (USD)", "Market Cap (B)", "24h Change (%)", "Trend",
    ]
    assert [r.Coin for r in got.collect()] == ["A", "B", "Z"]
    assert list(serve.fetch(got, 3)["Coin"]) == ["A", "B", "Z"]


def test_coin_header(spark):
    got = serve.coin_header(summary(spark, (1, "Bitcoin", "btc")), "BTC").first()
    assert got.title == "Bitcoin (BTC)"


def test_bronze_fields(bronze):
    raw = bronze(("a", at(0), json.dumps({"name": {"x": 1}, "current_price": "2"})))
    assert tuple(serve.bronze_fields(raw).first()) == ("a", None, 2.0)


def test_with_symbol_joins_on_the_id(spark):
    s = spark.createDataFrame([("one", 1.0), ("two", 2.0)], "coin_id string, p double")
    m = spark.createDataFrame([("one", "x"), ("two", "x"), ("six", "y")], "coin_id string, symbol string")
    assert serve.with_symbol(s, m).count() == 2
    assert serve.with_symbol(s, m, "y").count() == 0


def test_quality_report(spark):
    df = spark.createDataFrame(
        [("a", "x", 1.0), ("b", "x", None), ("c", None, 2.0)],
        "coin_id string, symbol string, price double",
    )
    report = checks.quality_report(df, ["coin_id", "price"], ["coin_id", "symbol"])
    assert {r.check_name: (r.n_rows, r.n_failed) for r in report.collect()} == {
        "row_count": (3, 0), "not_null:coin_id": (3, 0), "not_null:price": (3, 1),
        "unique:coin_id": (3, 0), "unique:symbol": (3, 1),
    }
    failed = {r.check_name for r in checks.failed_checks(report).collect()}
    assert failed == {"not_null:price", "unique:symbol"}
    empty = checks.quality_report(df.where("false"), ["coin_id"])
    assert [r.check_name for r in checks.failed_checks(empty).collect()] == ["row_count"]


def test_as_of_includes_the_moment_and_reads_any_offset(bronze):
    raw = bronze(("c", at(0), "{}"), ("c", at(1), "{}"), ("c", at(1, 1), "{}"))
    moment = dt.datetime.fromisoformat("2026-03-01T01:01:00+01:00")
    assert checks.as_of(raw, moment).count() == 2
