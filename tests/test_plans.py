"""What the physical plans must keep doing for the jobs to hold at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marlstone import bindings as B
from marlstone import schemas as S
from marlstone.plans import gold, jobs, serve, silver
from marlstone.sources import landing
from marlstone.sources.tables import BRONZE_LAYER

SF = entry.SMOKE_DIR
STAMP = B.LOADED_AT

# Queries that run jobs or streams when they are built.
EAGER = {
    "landing_markets", "bronze_append", "bronze_append_once", "refresh_live",
    "refresh_all", "live_prices_newest_days", "stream_ingest", "stream_live_refresh", "stream_stg_markets",
    "stream_two_restarts", "one_generation", "published_price_history", "incremental_stg_markets",
    "incremental_price_history", "incremental_historical_prices", "merged_price_history",
    "live_prices_by_coin", "coin_symbols",
    "bronze_append_batch", "landing_by_arrival", "replay_by_arrival",
    "quality_of_write",
}


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def tree(df):
    return plan(df, "simple")


@pytest.fixture
def events(spark):
    return B.table(spark, SF, "events")


@pytest.fixture
def raw_table(wh, events):
    """A bronze table on disk, partitioned by day."""
    wh.append(S.RAW_MARKETS, B.with_day(B.raw_markets(events)))
    return wh.table(BRONZE_LAYER, S.RAW_MARKETS)


def test_newest_documents_keep_one_row_per_task_before_the_shuffle(events):
    text = tree(silver.stg_markets(B.raw_markets(events)))
    assert re.search(r"WindowGroupLimit.*Final\b.*Exchange hash.*WindowGroupLimit.*Partial", text, re.S)
    assert text.count("Exchange") == 1


def test_a_payload_is_parsed_once_and_after_the_choice(events):
    text = tree(silver.stg_coin_details(B.raw_markets(events)))
    first, rest = text.split("_rank", 1)
    assert len(re.findall(r"parseJson\(payload", first)) == 1
    assert "parseJson" not in rest


def test_days_without_newest_rows_are_not_read(raw_table):
    assert "dynamicpruning" not in plan(silver.stg_markets(raw_table))
    text = plan(silver.stg_markets(raw_table, skip_days=True))
    assert "dynamicpruning" in text
    # Finding the days reads the coin's column and nothing of the payload.
    assert "ReadSchema: struct<coin_id:string>\n" in text
    assert "BroadcastHashJoin LeftSemi BuildRight" in text


def test_a_coin_filter_reaches_the_files(raw_table):
    text = plan(silver.stg_markets(raw_table.drop(S.PARTITION_COLUMN)).where("coin_id = '7'"))
    assert "EqualTo(coin_id,7)" in text


def test_live_prices_keep_n_rows_per_task_and_skip_days(raw_table):
    import datetime as dt

    df = serve.live_prices(raw_table, "error", since=dt.date(2024, 1, 20))
    text = plan(df)
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert re.search(r"PartitionFilters: \[.*ingest_date#\d+ >= 2024-01-20", text)
    assert "ReadSchema: struct<ingested_at:string,payload:string>" in text


def test_a_common_symbol_needs_the_newest_days_only(wh, raw_table, monkeypatch):
    series, steps = serve.live_prices, []

    def recorded(raw, symbol, n, **more):
        made = series(raw, symbol, n, **more)
        found = re.search(
            r"PartitionFilters:.*ingest_date#\d+ >= (\S+?)\).*ingest_date#\d+ <= (\S+?)\)",
            plan(made),
        )
        if found:
            steps.append(found.groups())
        return made

    monkeypatch.setattr(serve, "live_prices", recorded)

    def days_read(symbol, n):
        steps.clear()
        rows = jobs.newest_live_prices(wh, symbol, n).collect()
        assert rows == series(raw_table, symbol, n).collect()
        return list(steps)

    days = wh.days(S.RAW_MARKETS)
    assert days == sorted(days, reverse=True) and len(days) == 30
    at = lambda a, b: (str(days[b]), str(days[a]))
    assert days_read("error", 2) == [at(0, 0)]
    # Each step reads the days it adds.
    assert days_read("error", 15) == [at(0, 0), at(1, 3)]
    assert days_read("nobody", 2) == [at(0, 0), at(1, 3), at(4, 15), at(16, 29)]


def test_live_series_of_all_symbols_are_cut_before_the_shuffle(events):
    df = serve.price_direction(
        serve.live_prices_by_symbol(B.raw_markets(events)), ["symbol"]
    )
    text = tree(df)
    assert re.search(r"row_number\(\), 60, Final\b.*Exchange hash.*row_number\(\), 60, Partial", text, re.S)
    assert text.count("Exchange") == 1
    assert len(re.findall(r"from_json\(", text)) == 1


def test_landing_to_bronze_is_one_narrow_stage(spark, tmp_path):
    (tmp_path / "a.json").write_text("[]")
    responses = landing.read_responses(spark, str(tmp_path))
    df = landing.envelope(landing.market_records(responses), STAMP)
    assert "Exchange" not in tree(df.sortWithinPartitions(*S.BRONZE.names[:2]))


def test_history_aggregates_before_the_shuffle_by_hash(spark):
    df = gold.price_history(
        B.lineitem_prices(B.table(spark, SF, "lineitem")), ordered=False
    )
    text = tree(df)
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert text.count("Exchange") == 1


def test_unordered_points_are_neither_sorted_nor_shuffled_again(events):
    points = silver.stg_historical_prices(B.raw_historical_prices(events), ordered=False)
    above = tree(points).split("Generate explode", 1)[0]
    assert "Sort" not in above and "Exchange" not in above
    assert "rangepartitioning" not in tree(points)


def test_points_are_ordered_without_shuffling_them(events):
    text = tree(silver.stg_historical_prices(B.raw_historical_prices(events)))
    points, documents = text.split("Generate explode", 1)
    assert "Exchange" not in points and "Sort [coin_id" in points
    assert "Exchange rangepartitioning(coin_id" in documents


def test_watchlist_joins_follow_the_measured_size(spark):
    df = entry.watchlist_enriched(spark, SF)
    assert df.count() > 0
    assert "BroadcastHashJoin" in tree(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = entry.watchlist_enriched(spark, SF)
        assert tree(other).count("SortMergeJoin") == 2 and "Broadcast" not in tree(other)
        assert sorted(other.collect()) == sorted(df.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_coin_of_the_watchlists_is_split(spark):
    # Sizes of a test run stand in for a cluster's 256 MB and 64 MB.
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    rows = spark.range(40_000)
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500)
    lists = rows.select(
        (F.col("id") % 1_000).alias("user_id"),
        F.concat(F.lit("s"), hot).alias("coin_id"),
        F.current_timestamp().alias("added_at"),
    )
    people = spark.range(1_000).select(
        F.col("id").alias("user_id"), F.col("id").cast("string").alias("username")
    )
    summary = spark.range(500).selectExpr(
        "concat('s', id) AS symbol", "concat('n', id) AS name", "1.0D AS current_price",
        "1.0D AS market_cap_billions", "0.0D AS price_change_24h_pct", "'up' AS price_trend",
    )
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        df = gold.watchlist_enriched(lists, people, summary)
        assert len(df.collect()) == 40_000
        assert "SortMergeJoin(skew=true)" in tree(df)
    finally:
        for key in small:
            spark.conf.unset(key)


def test_dashboard_sorts_once(spark):
    text = tree(entry.dashboard_summary(spark, SF))
    assert text.count("Exchange rangepartitioning") == 1


def test_quality_report_reads_once_and_expands_nothing(spark):
    text = tree(entry.quality_report(spark, SF))
    assert text.count("FileScan") == 1 and "Expand" not in text
    # Patterns and values are counted before they are dealt out.
    above = text.split("Generate inline(array(struct(place")[0]
    assert re.search(r"HashAggregate.*Exchange hashpartitioning\(place.*HashAggregate", above, re.S)


def test_quality_report_needs_no_window_over_the_result(spark):
    assert "Window [" not in tree(entry.quality_report(spark, SF)).split("HashAggregate")[0]


@pytest.mark.parametrize("name", sorted(set(entry.library_queries()) - EAGER))
def test_no_python_and_no_cross_join_in_any_plan(spark, name):
    text = tree(entry.queries()[name](spark, SF))
    for node in ("Python", "Pandas", "Cartesian", "NestedLoop"):
        assert node not in text
