import json
import os

from pyspark.sql import functions as F

from marlstone import schemas as S
from marlstone.plans import gold, silver
from marlstone.sources import landing
from marlstone.sources.tables import BRONZE_LAYER, GOLD_LAYER, SILVER_LAYER
from marlstone.streaming.ingest import start_ingest
from marlstone.streaming.live import start_live_refresh, stream_bronze


def land(folder, name, coins, mtime):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text(json.dumps(coins) if not isinstance(coins, str) else coins)
    os.utime(path, (mtime, mtime))


def coin(name, price, rank=1):
    return {"id": name, "symbol": name, "name": name, "current_price": price,
            "market_cap_rank": rank, "market_cap": 1e9, "total_volume": 1e8}


def ingest(spark, wh, folder, **options):
    responses = landing.stream_responses(spark, str(folder))
    records = landing.market_records(responses)
    query = start_ingest(
        wh, S.RAW_MARKETS, records, f"{wh.root}/checkpoint-ingest", **options
    )
    query.awaitTermination()


def live(spark, wh):
    rows = stream_bronze(spark, wh, S.RAW_MARKETS, max_files=1)
    start_live_refresh(wh, rows, f"{wh.root}/checkpoint-live").awaitTermination()


def test_late_files_and_restarts_give_the_batch_result(spark, wh, tmp_path):
    folder = tmp_path / "landing"
    land(folder, "a.json", [coin("btc", 10), coin("eth", 1, 2)], 1_000_000)
    land(folder, "b.json", [coin("btc", 12)], 2_000_000)
    ingest(spark, wh, folder)
    live(spark, wh)
    assert dict_of(wh) == {"btc": 12.0, "eth": 1.0}

    # An older file arrives late, with a coin not seen before; then both restart.
    land(folder, "late.json", [coin("btc", 11), coin("xrp", 3, None)], 1_500_000)
    ingest(spark, wh, folder)
    live(spark, wh)
    assert dict_of(wh) == {"btc": 12.0, "eth": 1.0, "xrp": 3.0}

    batch = silver.stg_markets(wh.table(BRONZE_LAYER, S.RAW_MARKETS))
    streamed = wh.table(SILVER_LAYER, S.STG_MARKETS)
    assert sorted(streamed.collect()) == sorted(batch.collect())
    summary = wh.table(GOLD_LAYER, S.MART_MARKET_SUMMARY)
    assert sorted(map(str, summary.collect())) == sorted(
        map(str, gold.market_summary(batch).collect())
    )


def dict_of(wh):
    rows = wh.table(SILVER_LAYER, S.STG_MARKETS).collect()
    return {r.coin_id: r.current_price for r in rows}


def test_replayed_landing_adds_nothing(spark, wh, tmp_path):
    folder = tmp_path / "landing"
    land(folder, "a.json", [coin("btc", 10)], 1_000_000)
    ingest(spark, wh, folder)
    responses = landing.stream_responses(spark, str(folder))
    start_ingest(
        wh, S.RAW_MARKETS, landing.market_records(responses), f"{wh.root}/checkpoint-2"
    ).awaitTermination()
    assert wh.table(BRONZE_LAYER, S.RAW_MARKETS).count() == 1


def test_rejected_records_are_handed_over(spark, wh, tmp_path):
    folder = tmp_path / "landing"
    land(folder, "a.json", [coin("btc", 10), {"name": "no id"}], 1_000_000)
    rejected = []
    ingest(
        spark, wh, folder,
        on_rejected=lambda df: rejected.extend(landing.rejected_records(df).collect()),
    )
    assert [json.loads(r.payload)["name"] for r in rejected] == ["no id"]
    assert [r.coin_id for r in wh.table(BRONZE_LAYER, S.RAW_MARKETS).collect()] == ["btc"]


def test_live_state_breaks_ties_as_the_batch_does(spark, wh, bronze):
    stamp = "2026-03-01T00:00:00.000000+00:00"
    raw = bronze(
        ("btc", stamp, json.dumps(coin("btc", 9)), None),
        ("btc", stamp, json.dumps(coin("btc", 1)), "2026"),
        ("btc", stamp, json.dumps(coin("btc", 2)), "2026"),
    )
    dated = raw.withColumn(S.PARTITION_COLUMN, F.lit("2026-03-01").cast("date"))
    for i in range(3):
        wh.append(S.RAW_MARKETS, dated.where(F.col("payload").contains(f": {[9, 1, 2][i]},")))
    live(spark, wh)
    batch = silver.stg_markets(wh.table(BRONZE_LAYER, S.RAW_MARKETS)).collect()
    assert wh.table(SILVER_LAYER, S.STG_MARKETS).collect() == batch
