import datetime as dt

import pytest

from marlstone import schemas as S
from marlstone.plans import checks, incremental, silver
from marlstone.sources import landing
from marlstone.sources.tables import BRONZE_LAYER, SILVER_LAYER
from marlstone.streaming.ingest import start_ingest
from marlstone.streaming.live import start_live_refresh, stream_bronze

from test_streaming import coin, dict_of, land

UTC = dt.timezone.utc


@pytest.fixture
def batch(bronze):
    def make(*rows):
        raw = bronze(*[(c, f"2026-03-{d:02}T00:00:00.000000+00:00", p) for c, d, p in rows])
        return raw.withColumn("ingest_date", raw.ingested_at[0:10].cast("date"))

    return make


def held(wh, *columns):
    found = wh.table(BRONZE_LAYER, S.RAW_MARKETS).select(*(columns or ["coin_id", "payload", "batch_id"]))
    return sorted(map(tuple, found.collect()))


def test_a_retry_replaces_what_an_attempt_left(wh, batch):
    rows = [("btc", 1, '{"a": 1}'), ("eth", 1, "{}"), ("btc", 2, "{}")]
    wh.append_batch(S.RAW_MARKETS, batch(("old", 1, "{}")), "before")
    # Left behind: one day of two, a row twice, and one that is not of the batch.
    wh.append_batch(S.RAW_MARKETS, batch(rows[0], rows[0], ("stray", 1, "{}")), "now")
    for _ in range(2):
        wh.append_batch(S.RAW_MARKETS, batch(*rows), "now")
        assert held(wh) == sorted([("old", "{}", "before")] + [(c, p, "now") for c, _, p in rows])
    assert wh.days(S.RAW_MARKETS) == [dt.date(2026, 3, 2), dt.date(2026, 3, 1)]


def test_no_rows_and_odd_names(wh, batch):
    wh.append_batch(S.RAW_MARKETS, batch(("a", 1, "{}")).where("false"), "empty")
    wh.append_batch(S.RAW_MARKETS, batch(("a", 1, "{}")), "feed/eu=1 'x'")
    wh.append_batch(S.RAW_MARKETS, batch(("a", 1, "{}")), "feed/eu=1 'x'")
    assert held(wh) == [("a", "{}", "feed/eu=1 'x'")]


def test_a_retry_reads_nothing_of_the_table(wh, batch, spark, monkeypatch):
    wh.append_batch(S.RAW_MARKETS, batch(("a", 1, "{}")), "now")
    # With every file of the table broken, reading any would fail.
    from pathlib import Path

    for path in Path(f"{wh.root}/bronze/{S.RAW_MARKETS}").glob("*/*/*.parquet"):
        path.write_bytes(b"not parquet")
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
    wh.append_batch(S.RAW_MARKETS, batch(("a", 1, "{}"), ("b", 1, "{}")), "now")
    assert [r[0] for r in held(wh)] == ["a", "b"]


def test_replay_by_arrival(wh, batch):
    at = lambda day: dt.datetime(2026, 3, day, 12, tzinfo=UTC)
    wh.append_batch(S.RAW_MARKETS, batch(("btc", 2, "{}")), "1", at(2))
    wh.append_batch(S.RAW_MARKETS, batch(("late", 1, "{}")), "2", at(5))
    table = wh.table(BRONZE_LAYER, S.RAW_MARKETS)
    as_of = lambda day, by: sorted(r.coin_id for r in checks.as_of(table, at(day), by).collect())
    assert as_of(3, "ingested_at") == ["btc", "late"]
    assert as_of(3, "arrived_at") == ["btc"]
    assert as_of(5, "arrived_at") == ["btc", "late"]
    assert as_of(1, "arrived_at") == []


def test_a_stream_by_batch_lands_once_and_feeds_the_live_tables(spark, wh, tmp_path):
    folder = tmp_path / "landing"
    for i in range(3):
        land(folder, f"{i}.json", [coin("btc", 10 + i), coin(f"c{i}", i)], 1_000_000 + 90_000 * i)
    for _ in range(2):
        # The second start has lost its checkpoint: the same triggers, the same batches.
        responses = landing.stream_responses(spark, str(folder))
        start_ingest(
            wh, S.RAW_MARKETS, landing.market_records(responses),
            f"{wh.root}/checkpoint-{_}", batches="feed",
        ).awaitTermination()
        assert len(held(wh)) == 6
    start_live_refresh(
        wh, stream_bronze(spark, wh, S.RAW_MARKETS), f"{wh.root}/live"
    ).awaitTermination()
    assert dict_of(wh) == {"btc": 12.0, "c0": 0.0, "c1": 1.0, "c2": 2.0}
    incremental.refresh_added(wh, kept=[incremental.MARKETS])
    raw = wh.table(BRONZE_LAYER, S.RAW_MARKETS)
    assert sorted(wh.table(SILVER_LAYER, S.STG_MARKETS).collect()) == sorted(
        silver.stg_markets(raw).collect()
    )
