import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marlstone import schemas as S
from marlstone.plans import jobs, serve
from marlstone.session import shared_dir
from marlstone.sources.landing import envelope
from marlstone.sources.tables import BRONZE_LAYER, GOLD_LAYER, SILVER_LAYER, Warehouse


def batch(bronze, stamp, *rows):
    raw = bronze(*[(c, stamp, p) for c, p in rows])
    return envelope(raw.drop("ingested_at"), stamp)


DAY1 = "2026-03-01T05:00:00.000000+00:00"
DAY2 = "2026-03-02T05:00:00.000000+00:00"


def market(symbol, rank, **fields):
    return json.dumps({"symbol": symbol, "name": symbol, "market_cap_rank": rank, **fields})


def test_append_keeps_everything_in_day_folders(wh, bronze, tmp_path):
    for stamp in (DAY1, DAY2, DAY2):
        wh.append(S.RAW_MARKETS, batch(bronze, stamp, ("btc", "{}"), ("eth", "{}")))
    table = wh.table(BRONZE_LAYER, S.RAW_MARKETS)
    assert table.columns == S.BRONZE.names
    assert table.count() == 6
    folders = sorted(p.name for p in (tmp_path / "wh/bronze/raw_markets").glob("ingest_date=*"))
    assert folders == ["ingest_date=2026-03-01", "ingest_date=2026-03-02"]


def test_backfill_brings_days_together(wh, spark, tmp_path):
    day = F.date_add(F.lit(dt.date(2026, 3, 1)), (F.col("id") % 10).cast("int"))
    rows = spark.range(0, 4_000, 1, 8).select(
        F.col("id").cast("string").alias("coin_id"),
        F.lit(None).cast("string").alias("source_updated_at"),
        F.concat(day.cast("string"), F.lit("T00:00:00.000000+00:00")).alias("ingested_at"),
        F.lit("{}").alias("payload"),
        day.alias("ingest_date"),
    )
    wh.append(S.RAW_MARKETS, rows, backfill=True)
    files = list((tmp_path / "wh/bronze/raw_markets").glob("*/*.parquet"))
    assert len(files) == 10
    assert wh.table(BRONZE_LAYER, S.RAW_MARKETS).distinct().count() == 4_000


def test_creating_a_table_again_leaves_it_alone(wh, bronze):
    wh.append(S.RAW_MARKETS, batch(bronze, DAY1, ("btc", "{}")))
    wh.create_bronze(S.RAW_MARKETS)
    assert wh.table(BRONZE_LAYER, S.RAW_MARKETS).count() == 1


def test_a_new_catalog_takes_in_the_files(wh, bronze, spark):
    wh.append(S.RAW_MARKETS, batch(bronze, DAY1, ("btc", "{}")))
    schemas = {layer: f"{schema}_again" for layer, schema in wh.schemas.items()}
    again = Warehouse(spark, wh.root, schemas)
    again.append(S.RAW_MARKETS, batch(bronze, DAY2, ("eth", "{}")))
    rows = again.table(BRONZE_LAYER, S.RAW_MARKETS).collect()
    assert sorted(r.coin_id for r in rows) == ["btc", "eth"]


def test_append_once_after_nothing_part_or_all_was_committed(wh, bronze):
    rows = [("btc", "{}"), ("eth", '{"a": 1}'), ("eth", '{"a": 2}')]
    whole = batch(bronze, DAY1, *rows)
    wh.append(S.RAW_MARKETS, batch(bronze, DAY1, rows[1]))
    for _ in range(2):
        wh.append_once(S.RAW_MARKETS, whole)
    wh.append_once(S.RAW_MARKETS, whole.where("false"))
    wh.append_once(S.RAW_MARKETS, batch(bronze, DAY2, rows[0]))
    got = wh.table(BRONZE_LAYER, S.RAW_MARKETS)
    assert sorted((r.coin_id, r.payload, r.ingested_at) for r in got.collect()) == sorted(
        [(c, p, DAY1) for c, p in rows] + [("btc", "{}", DAY2)]
    )


def test_publish_replaces_and_running_readers_keep_their_version(wh, spark):
    first = wh.publish(SILVER_LAYER, S.STG_MARKETS, spark.range(3))
    second = wh.publish(SILVER_LAYER, S.STG_MARKETS, spark.range(5))
    assert (first.count(), second.count()) == (3, 5)
    # A model may be computed from its own published rows.
    own = wh.table(SILVER_LAYER, S.STG_MARKETS).where("id < 2")
    assert wh.publish(SILVER_LAYER, S.STG_MARKETS, own).count() == 2


def test_old_versions_are_dropped(wh, spark):
    for n in range(5):
        wh.publish(SILVER_LAYER, S.STG_MARKETS, spark.range(n))
    assert len(wh.versions(SILVER_LAYER, S.STG_MARKETS)) == 3
    assert wh.table(SILVER_LAYER, S.STG_MARKETS).count() == 4


def test_failed_rebuild_leaves_the_published_rows(wh, spark):
    wh.publish(SILVER_LAYER, S.STG_MARKETS, spark.range(3))
    with pytest.raises(Exception, match="broken"):
        wh.publish(
            SILVER_LAYER, S.STG_MARKETS, spark.range(3).select(F.raise_error(F.lit("broken")))
        )
    assert wh.table(SILVER_LAYER, S.STG_MARKETS).count() == 3


@pytest.fixture
def landed(wh, bronze):
    wh.append(S.RAW_MARKETS, batch(bronze, DAY1, ("old", market("old", 9)), ("btc", market("btc", 5))))
    wh.append(S.RAW_MARKETS, batch(bronze, DAY2, ("btc", market("btc", 1, current_price=2.5))))
    wh.append(S.RAW_COIN_DETAILS, batch(bronze, DAY1, ("btc", market("btc", 1))))
    wh.append(S.RAW_HISTORICAL_PRICES, batch(bronze, DAY1, ("btc", '{"prices": [[0, 1.5], [1, 2.5]]}')))
    return wh


@pytest.fixture
def app(spark):
    stamp = dt.datetime(2026, 1, 1)
    return (
        spark.createDataFrame([(1, "btc", stamp)], "user_id bigint, coin_id string, added_at timestamp"),
        spark.createDataFrame([(1, "ann")], "user_id bigint, username string"),
    )


def test_refresh_all_and_the_documented_queries(landed, app, spark):
    jobs.refresh_all(landed, *app)
    gold = landed.schemas[GOLD_LAYER]
    summary = spark.sql(
        f"SELECT market_cap_rank AS Rank, name AS Coin FROM {gold}.mart_market_summary ORDER BY Rank"
    )
    # A coin missing from the newest batch stays.
    assert [tuple(r) for r in summary.collect()] == [(1, "btc"), (9, "old")]
    history = landed.table(GOLD_LAYER, S.MART_PRICE_HISTORY).first()
    assert (history.low_price, history.high_price, history.data_points) == (1.5, 2.5, 2)
    watched = landed.table(GOLD_LAYER, S.MART_WATCHLIST_ENRICHED).first()
    assert (watched.username, watched.coin_name, watched.current_price) == ("ann", "btc", 2.5)
    assert landed.table(SILVER_LAYER, S.STG_COIN_DETAILS).count() == 1
    assert serve.row_count(landed.table(BRONZE_LAYER, S.RAW_MARKETS)).first().row_count == 3


def test_refresh_by_coin_id_and_live(landed, app):
    jobs.refresh_all(landed, *app, watch_on="coin_id")
    assert landed.table(GOLD_LAYER, S.MART_WATCHLIST_ENRICHED).count() == 1
    assert jobs.refresh_live(landed).count() == 2
    assert not landed.exists(SILVER_LAYER, "nothing")


def test_shared_dir_is_under_the_configured_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    got = shared_dir(spark, "x")
    assert got != shared_dir(spark, "x")
    if base:
        assert got.startswith(base.rstrip("/") + "/")
