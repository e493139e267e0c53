import datetime as dt
import json
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marlstone import schemas as S
from marlstone.plans import gold, incremental, jobs, silver
from marlstone.sources.keyed import BUCKET, KeyedTable
from marlstone.sources.landing import envelope
from marlstone.sources.tables import BRONZE_LAYER, GOLD_LAYER, SILVER_LAYER, Version
from marlstone.streaming.live import start_live_refresh, stream_bronze

from test_plans import plan


def stamp(day, hour=0):
    return f"2026-03-{day:02}T{hour:02}:00:00.000000+00:00"


def market(price, rank=1):
    return json.dumps({"symbol": f"s{rank}", "name": "n", "market_cap_rank": rank,
                       "current_price": price, "market_cap": 1e9, "total_volume": 1e8})


def prices(*points):
    return json.dumps({"prices": [[1_000_000 * t, p] for t, p in points]})


@pytest.fixture
def append(wh, bronze):
    def to(table, at, *rows):
        raw = bronze(*[(c, at, p) for c, p in rows])
        wh.append(table, envelope(raw.drop("ingested_at"), at))

    return to


def rows(df):
    return sorted(map(str, df.collect()))


def same_as_full(wh, strict=True):
    """Each kept model equals its full rebuild from bronze."""
    raw = lambda t: wh.table(BRONZE_LAYER, t)
    markets = silver.stg_markets(raw(S.RAW_MARKETS), strict)
    points = silver.stg_historical_prices(raw(S.RAW_HISTORICAL_PRICES), strict)
    for layer, table, full in (
        (SILVER_LAYER, S.STG_MARKETS, markets),
        (SILVER_LAYER, S.STG_COIN_DETAILS, silver.stg_coin_details(raw(S.RAW_COIN_DETAILS), strict)),
        (SILVER_LAYER, S.STG_HISTORICAL_PRICES, points),
        (GOLD_LAYER, S.MART_MARKET_SUMMARY, gold.market_summary(markets)),
        (GOLD_LAYER, S.MART_PRICE_HISTORY, gold.price_history(points, strict=strict)),
    ):
        got = wh.table(layer, table)
        assert got.columns == full.columns, table
        assert rows(got) == rows(full), table


def test_three_appends_with_a_replaced_payload_and_late_files(wh, append):
    coins = [f"c{i}" for i in range(20)]
    append(S.RAW_MARKETS, stamp(1), *[(c, market(i, i)) for i, c in enumerate(coins)])
    append(S.RAW_COIN_DETAILS, stamp(1), *[(c, market(i)) for i, c in enumerate(coins)])
    append(S.RAW_HISTORICAL_PRICES, stamp(1), *[(c, prices((1, 1.5), (90_000, i))) for i, c in enumerate(coins)])
    assert incremental.refresh_added(wh, buckets=8) == 1
    same_as_full(wh)

    # A new day, a payload without points, a replaced payload, and a late new coin.
    append(S.RAW_MARKETS, stamp(3), ("c1", market(99)), ("new", market(5)))
    append(S.RAW_MARKETS, stamp(2), ("c1", market(50)), ("late", market(7)))
    append(S.RAW_HISTORICAL_PRICES, stamp(3), ("c2", prices()), ("c3", prices((1, 2.25), (2, 4))))
    assert incremental.refresh_added(wh, buckets=8) == 2
    same_as_full(wh)
    assert "c2" not in [r.coin_id for r in wh.table(GOLD_LAYER, S.MART_PRICE_HISTORY).collect()]

    # An older payload of the coin without points must not come back.
    append(S.RAW_HISTORICAL_PRICES, stamp(2), ("c2", prices((5, 5.0))))
    append(S.RAW_MARKETS, stamp(3), ("c1", market(98)))
    append(S.RAW_COIN_DETAILS, stamp(4), ("c5", market(1)))
    assert incremental.refresh_added(wh, buckets=8) == 3
    same_as_full(wh)

    # Nothing added: nothing written.
    before = wh.versions(SILVER_LAYER, S.STG_MARKETS, "p")
    assert incremental.refresh_added(wh, buckets=8) == 3
    assert wh.versions(SILVER_LAYER, S.STG_MARKETS, "p") == before


def test_random_appends(wh, append):
    dice = random.Random(4)
    for _ in range(3):
        for table in (S.RAW_MARKETS, S.RAW_COIN_DETAILS, S.RAW_HISTORICAL_PRICES):
            at = stamp(dice.randint(1, 4), dice.randint(0, 3))
            pick = [f"c{dice.randint(0, 9)}" for _ in range(dice.randint(1, 6))]
            text = (
                (lambda: prices(*[(dice.randint(0, 10**6), dice.randint(0, 999) / 8) for _ in range(dice.randint(0, 4))]))
                if table == S.RAW_HISTORICAL_PRICES else (lambda: market(dice.randint(1, 99)))
            )
            append(table, at, *[(c, text()) for c in pick])
        incremental.refresh_added(wh, buckets=4)
        same_as_full(wh)


def test_lenient_refresh_keeps_the_last_good_document(wh, append):
    append(S.RAW_MARKETS, stamp(1), ("a", market(1)), ("b", market(2)))
    append(S.RAW_COIN_DETAILS, stamp(1), ("a", "{}"))
    append(S.RAW_HISTORICAL_PRICES, stamp(1), ("a", prices((1, 1.0))))
    incremental.refresh_added(wh, strict=False)
    append(S.RAW_MARKETS, stamp(2), ("a", '{"cut'), ("b", market(3)))
    incremental.refresh_added(wh, strict=False)
    same_as_full(wh, strict=False)


def test_only_added_days_are_read(wh, append):
    for day in range(1, 6):
        append(S.RAW_MARKETS, stamp(day), *[(f"c{i}", market(day * i)) for i in range(5)])
    incremental.refresh_added(wh, kept=[incremental.MARKETS])
    append(S.RAW_MARKETS, stamp(2, 5), ("late", market(1)))
    append(S.RAW_MARKETS, stamp(6), ("c1", market(1)))
    state = KeyedTable(wh, SILVER_LAYER, S.STG_MARKETS)
    files = incremental.bronze_files(wh, S.RAW_MARKETS)
    days = incremental.added_days(files, state.mark())
    assert days == [dt.date(2026, 3, 2), dt.date(2026, 3, 6)]
    read = incremental.added_documents(wh, incremental.MARKETS, days)
    assert "PartitionFilters: [ingest_date" in plan(read)
    found = {f.split("ingest_date=")[1][:10] for f in read.inputFiles()}
    assert found == {"2026-03-02", "2026-03-06"}


def test_a_bucket_is_rewritten_only_if_a_coin_of_it_changed(wh, append):
    append(S.RAW_MARKETS, stamp(1), *[(f"c{i}", market(i, i)) for i in range(60)])
    incremental.refresh_added(wh, kept=[incremental.MARKETS], buckets=16)
    table = KeyedTable(wh, SILVER_LAYER, S.STG_MARKETS)
    before = table._data(table.version())
    assert len(before) > 10
    append(S.RAW_MARKETS, stamp(2), ("c7", market(70, 7)), ("c8", market(8, 8)))
    append(S.RAW_MARKETS, stamp(1, 0), ("c9", market(9, 9)))
    incremental.refresh_added(wh, kept=[incremental.MARKETS], buckets=16)
    after = table._data(table.version())
    of = {r.coin_id: r[BUCKET] for r in table.rows().collect()}
    # c9's row is the published one again: its bucket stays where it was.
    assert {b for b in after if after[b] != before.get(b)} == {of["c7"], of["c8"]}
    assert rows(table.rows_of(["c7"])) == rows(
        wh.table(SILVER_LAYER, S.STG_MARKETS).where("coin_id = 'c7'")
    )
    assert f"{BUCKET}={of['c7']}" in plan(table.rows_of(["c7"]))


def live(spark, wh, **options):
    source = stream_bronze(spark, wh, S.RAW_MARKETS, max_files=1)
    query = start_live_refresh(wh, source, f"{wh.root}/checkpoint-live", buckets=16, **options)
    query.awaitTermination()


def test_a_trigger_with_one_changed_coin_writes_one_bucket(wh, append, spark):
    append(S.RAW_MARKETS, stamp(1), *[(f"c{i}", market(i, i)) for i in range(60)])
    live(spark, wh)
    table = KeyedTable(wh, SILVER_LAYER, S.STG_MARKETS)
    for late in (False, True):
        before, generation = table._data(table.version()), wh.snapshot().generation
        append(S.RAW_MARKETS, stamp(1 if late else 2), ("c7", market(70, 7)))
        live(spark, wh)
        after = table._data(table.version())
        assert sum(after[b] != before.get(b) for b in after) == (0 if late else 1)
        assert wh.snapshot().generation == generation + (not late)
    markets = silver.stg_markets(wh.table(BRONZE_LAYER, S.RAW_MARKETS))
    assert rows(wh.table(SILVER_LAYER, S.STG_MARKETS)) == rows(markets)
    assert rows(wh.table(GOLD_LAYER, S.MART_MARKET_SUMMARY)) == rows(gold.market_summary(markets))
    # Old buckets' data and scratch tables are gone, those still pointed to are there.
    kept = wh.versions(SILVER_LAYER, S.STG_MARKETS, "p")
    used = [table._data(Version(SILVER_LAYER, S.STG_MARKETS, p, ())) for p in kept]
    assert len(kept) == 3
    assert set(wh.versions(SILVER_LAYER, S.STG_MARKETS, "d")) == {d for u in used for d in u.values()}
    assert wh.versions(SILVER_LAYER, "scratch", "s") == []


def test_the_stream_takes_over_from_a_batch_job(wh, append, spark):
    append(S.RAW_MARKETS, stamp(1), ("a", market(1)), ("b", market(2)))
    append(S.RAW_MARKETS, stamp(2), ("b", market(3)))
    jobs.refresh_live(wh)
    seen = []
    commit = wh.commit
    wh.commit = lambda v: (commit(v), seen.append(wh.table(SILVER_LAYER, S.STG_MARKETS).count()))
    live(spark, wh)
    assert seen and set(seen) == {2}


def test_parts_merge_to_the_same_however_points_are_divided(spark):
    dice = random.Random(2)
    points = [
        (f"c{dice.randint(0, 3)}", dt.datetime(2026, 1, dice.randint(1, 3)), p, stamp(1))
        for p in [None, 0.1, 0.7, 1e9 + 0.01, 12.345, 2.5] * 30
    ]
    schema = "coin_id string, price_timestamp timestamp, price_usd double, ingested_at string"
    whole = spark.createDataFrame(points, schema)
    pieces = [gold.history_parts(spark.createDataFrame(points[i::7], schema)) for i in range(7)]
    parts = pieces[0]
    for p in pieces[1:]:
        parts = parts.unionByName(p)
    merged = gold.history_figures(gold.merged_parts(parts))
    full = gold.price_history(whole)
    assert rows(merged.select(*full.columns)) == rows(full)


def test_readers_see_one_generation(wh, append, monkeypatch):
    """A reader in the middle of a commit gets all models before it, or all after."""
    append(S.RAW_MARKETS, stamp(1), ("a", market(1)))
    append(S.RAW_COIN_DETAILS, stamp(1), ("a", market(1)))
    append(S.RAW_HISTORICAL_PRICES, stamp(1), ("a", prices((1, 1.0))))
    assert jobs.refresh_all(wh) == 1
    append(S.RAW_MARKETS, stamp(2), ("a", market(2)))
    append(S.RAW_HISTORICAL_PRICES, stamp(2), ("a", prices((1, 2.0))))

    def read():
        now = wh.snapshot()
        price = now.table(SILVER_LAYER, S.STG_MARKETS).first().current_price
        summary = now.table(GOLD_LAYER, S.MART_MARKET_SUMMARY).first().current_price
        low = now.table(GOLD_LAYER, S.MART_PRICE_HISTORY).first().low_price
        assert price == summary == low == now.generation
        return now.generation

    seen, sql = [], wh.spark.sql

    def watched(text, *a, **b):
        if "OR REPLACE VIEW" not in text:
            return sql(text, *a, **b)
        seen.append(read())
        found = sql(text, *a, **b)
        seen.append(read())
        return found

    old = wh.snapshot()
    monkeypatch.setattr(wh.spark, "sql", watched)
    jobs.refresh_all(wh)
    assert seen[:2] == [1, 2] and set(seen[2:]) == {2} and len(seen) > 8
    # A reader that began before keeps its versions.
    assert old.table(SILVER_LAYER, S.STG_MARKETS).first().current_price == 1



def test_published_tables_are_clustered(wh, spark, append):
    """One coin's filter skips most files by the statistics in their footers."""
    from pathlib import Path

    for table in (S.RAW_MARKETS, S.RAW_COIN_DETAILS):
        append(table, stamp(1), ("c0001", market(1)))
    day = 86_400
    append(S.RAW_HISTORICAL_PRICES, stamp(1), *[
        (f"c{i:04}", prices(*[(h * day / 1000, i + h / 4) for h in range(40)])) for i in range(400)
    ])
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
        "spark.sql.shuffle.partitions": "16",
    }
    kept = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        jobs.refresh_all(wh)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)
    now = wh.snapshot()
    for layer, table in ((SILVER_LAYER, S.STG_HISTORICAL_PRICES), (GOLD_LAYER, S.MART_PRICE_HISTORY)):
        name = now.versions[layer, table].name.split(".")[-1]
        found = sorted(Path(f"{wh.root}/{layer}/{name}").glob("*.parquet"))
        assert len(found) >= 4
        holds = []
        for path in found:
            meta = pq.ParquetFile(path).metadata
            at = [c for c in range(meta.num_columns) if meta.schema.column(c).name == "coin_id"][0]
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            holds.append(any(s.min <= "c0200" <= s.max for s in stats))
        assert 1 <= sum(holds) <= 2, (table, len(holds), sum(holds))
        wanted = now.table(layer, table).where("coin_id = 'c0200'")
        assert "EqualTo(coin_id,c0200)" in plan(wanted)
        assert wanted.count() == 40 if layer == SILVER_LAYER else wanted.count() > 1
