import datetime as dt
import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marlstone.sources import landing, relational

STAMP = "2026-03-01T05:17:08.433794+00:00"


def coins(n):
    return [{"id": f"c{i}", "last_updated": f"u{i}", "symbol": None} for i in range(n)]


def land(folder, name, text, mtime=None):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(text)
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return str(folder)


def test_each_element_becomes_a_row_of_one_batch(spark, tmp_path):
    text = json.dumps(coins(3), indent=1)
    responses = landing.read_responses(spark, land(tmp_path / "m", "a.json", text))
    rows = landing.envelope(landing.market_records(responses), STAMP).collect()
    assert [(r.coin_id, r.source_updated_at, r.ingested_at) for r in rows] == [
        (f"c{i}", f"u{i}", STAMP) for i in range(3)
    ]
    assert [json.loads(r.payload) for r in rows] == coins(3)
    assert {r.ingest_date for r in rows} == {dt.date(2026, 3, 1)}


def test_every_element_is_written(spark, tmp_path):
    folder = land(tmp_path / "m", "a.json", json.dumps(coins(1260)))
    assert landing.market_records(landing.read_responses(spark, folder)).count() == 1260


def test_text_behind_the_array_is_rejected(spark, tmp_path):
    folder = land(tmp_path / "m", "a.json", '[{"id": "a"}, {"id": "b"}] trailing')
    responses = landing.read_responses(spark, folder)
    assert landing.market_records(responses, strict=False).count() == 0
    assert landing.rejected_responses(responses).count() == 1
    with pytest.raises(Exception, match="not a JSON array"):
        landing.market_records(responses).collect()


def test_only_canonical_times_pass(spark):
    times = [STAMP, "2024-01-02T01:00:00.000000+02:00", "2024-01-02T01:00:00Z", None]
    records = spark.createDataFrame(
        [(f"c{i}", None, "{}", t) for i, t in enumerate(times)],
        "coin_id string, source_updated_at string, payload string, at string",
    )
    at = F.col("at")
    good = landing.envelope(records, at, strict=False).collect()
    bad = landing.rejected_records(records, at).collect()
    assert [r.coin_id for r in good] == ["c0"]
    assert sorted(r.coin_id for r in bad) == ["c1", "c2", "c3"]
    with pytest.raises(Exception, match="not canonical UTC"):
        landing.envelope(records.where("coin_id = 'c1'"), at).collect()


def test_arrival_time_is_the_ingestion_time(spark, tmp_path):
    folder = land(tmp_path / "m", "a.json", json.dumps(coins(1)), 1_772_342_228.25)
    records = landing.market_records(landing.read_responses(spark, folder))
    assert landing.envelope(records).first().ingested_at == "2026-03-01T05:17:08.250000+00:00"


def test_lines_as_responses(spark, tmp_path):
    lines = "\n".join(json.dumps(coins(n)) for n in (1, 2))
    folder = land(tmp_path / "m", "bulk.txt", lines)
    responses = landing.read_responses(spark, folder, whole_files=False)
    assert landing.market_records(responses).count() == 3


def test_element_without_id_fails_or_is_set_aside(spark, tmp_path):
    folder = land(tmp_path / "m", "a.json", '[{"id": "a"}, {"x": 1}, null]')
    records = landing.market_records(landing.read_responses(spark, folder))
    with pytest.raises(Exception, match="required column coin_id is NULL"):
        landing.envelope(records, STAMP).collect()
    kept = landing.envelope(records, STAMP, strict=False).collect()
    assert [r.coin_id for r in kept] == ["a"]
    assert landing.rejected_records(records).count() == 2


@pytest.mark.parametrize("text", ['{"status": "error"}', "[{", " "])
def test_response_that_is_no_array(spark, tmp_path, text):
    land(tmp_path / "m", "good.json", json.dumps(coins(2)))
    folder = land(tmp_path / "m", "bad.json", text)
    responses = landing.read_responses(spark, folder)
    with pytest.raises(Exception, match="not a JSON array"):
        landing.market_records(responses).collect()
    assert landing.market_records(responses, strict=False).count() == 2
    assert [r.value for r in landing.rejected_responses(responses).collect()] == [text]


def test_details_and_prices_take_the_id_from_the_folder(spark, tmp_path):
    text = json.dumps({"last_updated": "u", "id": "other"}, indent=1)
    land(tmp_path / "d" / "coin_id=bitcoin", "a.json", text)
    folder = str((tmp_path / "d"))
    land(tmp_path / "d" / "coin_id=1", "a.json", text)
    responses = landing.read_responses(spark, folder, per_coin=True)
    details = landing.envelope(landing.coin_details_records(responses), STAMP)
    assert sorted((r.coin_id, r.source_updated_at, r.payload) for r in details.collect()) == [
        ("1", "u", text), ("bitcoin", "u", text),
    ]
    prices = landing.envelope(landing.historical_prices_records(responses), STAMP)
    assert {r.source_updated_at for r in prices.collect()} == {None}


def test_bulk_lines_name_their_coin(spark, tmp_path):
    """Any id and text comes back; files and folders do not grow with the coins."""
    odd = [("a/b=c", '{"x": "1\\n2"}'), ("7", "two\nlines"), ("7", "two\nlines"), ("", "{}"),
           (None, "é \u2028")]
    many = [(str(k), "{}") for k in range(100, 400)]
    folder = tmp_path / "d"
    rows = spark.createDataFrame(odd + many, "coin_id string, value string").repartition(3)
    landing.write_named_lines(rows, str(folder))
    assert len(list(folder.rglob("*.json"))) <= 3
    assert not [p for p in folder.iterdir() if p.is_dir()]
    read = landing.read_responses(
        spark, str(folder), per_coin=True, whole_files=False, named_lines=True
    )
    found = Counter((r.coin_id, r.value) for r in read.collect())
    # An empty id is NULL, as the name of a folder it would be too.
    assert found == Counter([(c or None, v) for c, v in odd + many])
    assert read.where("received_at IS NULL").count() == 0
    with pytest.raises(ValueError, match="named_lines"):
        landing.read_responses(spark, str(folder), per_coin=True, named_lines=True)


@pytest.mark.parametrize("query", ["landing_coin_details", "landing_historical_prices"])
def test_landed_responses_of_coins_need_no_folder_each(spark, tmp_path, monkeypatch, query):
    import __spark_entry__ as entry

    monkeypatch.setattr(entry, "shared_dir", lambda _, purpose: str(tmp_path / purpose))
    parts = spark.range(60).selectExpr(
        "id AS p_partkey", "'n' AS p_name", "'b' AS p_brand", "'t' AS p_type",
        "1 AS p_size", "2.0D AS p_retailprice",
    )
    parts.coalesce(2).write.parquet(str(tmp_path / "part.parquet"))
    events = spark.range(60).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id",
        "'e' AS event_type", "1.5D AS value", "'{}' AS props",
    )
    events.coalesce(2).write.parquet(str(tmp_path / "events.parquet"))
    rows = entry.queries()[query](spark, str(tmp_path)).collect()
    assert len(rows) == (60 if query == "landing_coin_details" else 120)
    assert not [p for p in (tmp_path / query).iterdir() if p.is_dir()]


def test_malformed_details_are_set_aside_when_not_strict(spark):
    df = spark.createDataFrame([("a", "{bad"), ("b", "{}")], "coin_id string, value string")
    records = landing.coin_details_records(df)
    assert [r.coin_id for r in landing.envelope(records, STAMP, strict=False).collect()] == ["b"]
    assert [r.coin_id for r in landing.rejected_records(records).collect()] == ["a"]


def test_columnar_input_keeps_null_fields(spark):
    df = spark.createDataFrame([(1, None, "x")], "id int, a string, b string")
    row = landing.records_from_columns(df, F.col("id"), F.col("b")).first()
    assert tuple(row) == ("1", "x", '{"id":1,"a":null,"b":"x"}')


def test_batch_time_is_normalised_to_utc(spark):
    records = spark.createDataFrame(
        [("a", None, "{}")], "coin_id string, source_updated_at string, payload string"
    )
    row = landing.envelope(records, "2026-03-01T06:17:08+01:00").first()
    assert row.ingested_at == "2026-03-01T05:17:08.000000+00:00"
    with pytest.raises(ValueError, match="offset"):
        landing.envelope(records, "2026-03-01T06:17:08")


def test_jdbc_options_split_by_user(spark):
    options = relational.jdbc_options(
        "jdbc:postgresql://db/app", "app", "user_profiles", (1, 1_000), 16, user="u"
    )
    assert options == {
        "url": "jdbc:postgresql://db/app", "dbtable": "app.user_profiles",
        "fetchsize": "10000", "user": "u", "partitionColumn": "user_id",
        "lowerBound": "1", "upperBound": "1000", "numPartitions": "16",
    }
    assert "partitionColumn" not in relational.jdbc_options("u", "s", "t", partitions=1)
    with pytest.raises(ValueError, match="bounds"):
        relational.jdbc_options("u", "s", "t")
