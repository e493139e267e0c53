import datetime as dt
import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from marlstone import schemas as S
from marlstone.plans import jobs, serve, symbols
from marlstone.sources.landing import envelope
from marlstone.sources.tables import BRONZE_LAYER, SILVER_LAYER

from test_plans import plan


def doc(symbol, price):
    return json.dumps({"symbol": symbol, "current_price": price})


@pytest.fixture
def append(wh, bronze):
    def to(day, *rows):
        at = f"2026-03-{day:02}T00:00:00.000000+00:00"
        raw = bronze(*[(c, at, p) for c, p in rows])
        wh.append(S.RAW_MARKETS, envelope(raw.drop("ingested_at"), at))

    return to


def test_every_pair_is_found_and_only_new_ones_are_written(wh, append):
    append(1, ("btc", doc("BTC", 1)), ("fake", doc("btc", 2)), ("eth", doc("eth", 3)), ("x", "{}"))
    symbols.refresh_symbols(wh, buckets=8)
    table = symbols.symbol_table(wh)
    before = table._data(table.version())
    append(2, ("btc", doc("btc", 4)), ("eth", doc("renamed", 5)), ("odd", '"text"'))
    symbols.refresh_symbols(wh, buckets=8)
    got = wh.table(SILVER_LAYER, symbols.COIN_SYMBOLS)
    assert sorted(map(tuple, got.collect())) == [
        ("btc", "btc"), ("btc", "fake"), ("eth", "eth"), ("renamed", "eth")
    ]
    after = table._data(table.version())
    assert sum(after[b] != before.get(b) for b in after) == 1
    generation = wh.snapshot().generation
    assert symbols.refresh_symbols(wh) == generation


def test_the_series_is_complete_however_old_the_table_is(wh, append):
    append(1, ("btc", doc("btc", 1)), ("eth", doc("eth", 9)))
    append(3, ("btc", doc("BTC", 3)), ("fake", doc("btc", 4)))
    for refreshed in (False, True, False):
        if refreshed:
            symbols.refresh_symbols(wh)
        want = serve.live_prices(wh.table(BRONZE_LAYER, S.RAW_MARKETS), "btc").collect()
        assert jobs.newest_live_prices(wh, "BTC").collect() == want
        # A coin that the table does not know, on a late day and on a new one.
        append(2 if refreshed else 4, ("new", doc("Btc", 7)))
    want = serve.live_prices(wh.table(BRONZE_LAYER, S.RAW_MARKETS), "btc").collect()
    assert len(want) == 6 and jobs.newest_live_prices(wh, "BTC").collect() == want
    _, whole = symbols.rows_of_symbol(wh, "btc")
    assert whole == [dt.date(2026, 3, 2), dt.date(2026, 3, 4)]
    assert jobs.newest_live_prices(wh, "nobody").count() == 0


def test_a_symbol_becomes_a_filter_on_coins(wh, append, monkeypatch):
    append(1, *[(f"c{i}", doc(f"s{i % 50}", i)) for i in range(100)])
    symbols.refresh_symbols(wh)
    rows, whole = symbols.rows_of_symbol(wh, "S7")
    assert whole == [] and {r.coin_id for r in rows.collect()} == {"c7", "c57"}
    assert "PushedFilters: [In(coin_id, [c57,c7])]" in plan(rows)
    monkeypatch.setattr(symbols, "MOST_COINS", 1)
    assert symbols.rows_of_symbol(wh, "S7")[0].count() == 100


def test_bronze_files_have_bloom_filters_of_the_coins(wh, append):
    append(1, *[(f"c{i}", doc("s", i)) for i in range(100)])
    found = list(Path(f"{wh.root}/bronze/{S.RAW_MARKETS}").glob("*/*.parquet"))
    assert found
    for path in found:
        coin = pq.ParquetFile(path).metadata.row_group(0).column(0)
        assert coin.path_in_schema == "coin_id"
        # The filter stands between the columns and the footer.
        size = path.stat().st_size
        chunks = pq.ParquetFile(path).metadata.row_group(0).total_byte_size
        assert size > chunks + 16_000
