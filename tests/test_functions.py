import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.functions import sql
from marlstone.functions.guards import required
from marlstone.functions.json import (
    as_bigint,
    as_double,
    is_malformed,
    json_pairs,
    json_scalar,
    parse_payload,
    top_level,
    top_level_scalar,
    with_scalars,
)
from marlstone.functions.numeric import round_half_up, safe_ratio, stable_avg
from marlstone.functions.time import (
    epoch_millis,
    from_iso,
    from_utc_wall_clock,
    iso_utc,
    utc_date,
    utc_wall_clock,
)

# Text of a document and what `$.f` reads from it.
SCALARS = [
    ("{}", None),
    ('{"f": null}', None),
    ('{"f": {"a": 1}}', None),
    ('{"f": [1]}', None),
    ('{"f": "{x"}', "{x"),
    ('{"f": "[x"}', "[x"),
    ('{"f": "{}"}', "{}"),
    ('{"f": ""}', ""),
    ('{"f": "btc"}', "btc"),
    ('{"f": 7}', "7"),
    ('{"f": true}', "true"),
]


def one(spark, expression, **columns):
    names = ", ".join(f"{v} AS {k}" for k, v in columns.items()) or "1 AS x"
    return spark.sql(f"SELECT {names}").select(expression).first()[0]


@pytest.mark.parametrize("text, expected", SCALARS)
def test_every_way_of_reading_a_scalar_agrees(spark, text, expected):
    df = spark.createDataFrame([(text,)], "payload string")
    doc = df.select("payload", parse_payload("payload").alias("doc"))
    direct = doc.select(json_scalar("doc", "$.f")).first()[0]
    many = with_scalars(doc, "doc", {"f": "$.f"}).first()["f"]
    fields = df.select("payload", top_level("payload", ["f"]).alias("fields"))
    top = fields.select(top_level_scalar("fields", "payload", "f")).first()[0]
    sql.register(spark)
    named = spark.sql(
        "SELECT json_extract_scalar(payload, '$.f') FROM {df}", df=df
    ).first()[0]
    assert [direct, many, top, named] == [expected] * 4


def test_nested_and_indexed_paths(spark):
    df = spark.createDataFrame(
        [('{"a": {"b": {"usd": 1.5}}, "h": ["u", "v"]}',), ('{"h": []}',)], "p string"
    ).select(parse_payload("p").alias("doc"))
    rows = df.select(json_scalar("doc", "$.a.b.usd"), json_scalar("doc", "$.h[0]"))
    assert [tuple(r) for r in rows.collect()] == [("1.5", "u"), (None, None)]


@pytest.mark.parametrize(
    "text, expected", [("7", 7), ("7.0", 7), ('"7"', 7), ("null", None)]
)
def test_bigint(spark, text, expected):
    doc = spark.createDataFrame([(f'{{"f": {text}}}',)], "p string").select(
        parse_payload("p").alias("doc")
    )
    assert doc.select(as_bigint(json_scalar("doc", "$.f"))).first()[0] == expected


@pytest.mark.parametrize("text", ['"abc"', "7.5"])
def test_malformed_number_fails_or_is_null(spark, text):
    doc = spark.createDataFrame([(f'{{"f": {text}}}',)], "p string").select(
        parse_payload("p").alias("doc")
    )
    assert doc.select(as_bigint(json_scalar("doc", "$.f"), False)).first()[0] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        doc.select(as_bigint(json_scalar("doc", "$.f"))).first()


def test_double_reads_text_and_exponents(spark):
    doc = spark.createDataFrame([('{"a": "1.5", "b": 2e3}',)], "p string").select(
        parse_payload("p").alias("doc")
    )
    row = doc.select(
        as_double(json_scalar("doc", "$.a")), as_double(json_scalar("doc", "$.b"))
    ).first()
    assert tuple(row) == (1.5, 2000.0)


def test_malformed_payload(spark):
    df = spark.createDataFrame([("{bad",), ("{}",), (None,), ('{"x": NaN}',)], "p string")
    assert [r[0] for r in df.select(is_malformed("p")).collect()] == [
        True, False, False, True,
    ]
    with pytest.raises(Exception, match="MALFORMED"):
        df.select(parse_payload("p")).collect()
    with pytest.raises(Exception, match="MALFORMED"):
        df.select(top_level("p", ["x"])).collect()


def test_pairs_keep_nulls_and_read_numeric_text(spark):
    doc = spark.createDataFrame(
        [('{"prices": [[1, null], ["2", 3.5], null]}',)], "p string"
    ).select(parse_payload("p").alias("doc"))
    pairs = doc.select(json_pairs("doc", "$.prices")).first()[0]
    assert pairs == [[1.0, None], [2.0, 3.5], None]


@pytest.mark.parametrize(
    "value, places, expected",
    [
        (1.005, 2, 1.0), (2.675, 2, 2.68), (0.125, 2, 0.13), (-0.125, 2, -0.13),
        (0.0049999999999999994, 2, 0.0), (0.49999999999999994, 0, 0.0), (0.5, 0, 1.0),
        (-0.0, 2, 0.0), (1e300, 2, 1e300), (-4.6e18, 4, -4.6e18), (0.00005, 4, 0.0001),
    ],
)
def test_round_half_up(spark, value, places, expected):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(round_half_up(F.col("x"), places)).first()[0] == expected


def test_round_half_up_of_non_numbers(spark):
    df = spark.createDataFrame(
        [(None,), (float("nan"),), (float("inf"),), (-float("inf"),)], "x double"
    )
    got = [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()]
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [math.inf, -math.inf]


def test_ratio_of_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double")
    got = [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [None, None, 0.25]


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.decimals(-100_000, 100_000, places=2) | st.none(), min_size=1, max_size=30
    )
)
def test_stable_avg_is_the_exact_average(spark, values):
    rows = [(None if v is None else float(v),) for v in values]
    given_ = [v for v in values if v is not None]
    expected = float(sum(given_)) / len(given_) if given_ else None
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "x double").repartition(3)
        assert df.agg(stable_avg(F.col("x"))).first()[0] == expected


def test_stable_avg_beyond_its_range(spark):
    large = spark.createDataFrame([(4e15,), (-1.5,), (2e9,)] * 3, "x double")
    assert large.agg(stable_avg(F.col("x"))).first()[0] == (4e15 + 2e9 - 1.5) / 3
    for odd in (1e300, math.nan, math.inf):
        df = spark.createDataFrame([(odd,), (2.0,)], "x double")
        with pytest.raises(Exception):
            df.agg(stable_avg(F.col("x"))).collect()
        assert df.agg(stable_avg(F.col("x"), strict=False)).first()[0] == 2.0


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_time_does_not_depend_on_the_session_zone(spark, in_zone, zone):
    in_zone(zone)
    # A wall clock New York skipped, two instants it shows alike, one before 1970.
    texts = [
        "2024-03-10T02:30:00.500000+00:00",
        "2024-11-03T05:30:00.000000+00:00",
        "2024-11-03T06:30:00.000001+00:00",
        "1969-12-31T23:59:59.000000+00:00",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", from_iso("text").alias("ts")
    )
    wall = utc_wall_clock(F.col("ts"))
    rows = df.select(
        "text",
        iso_utc(F.col("ts")).alias("iso"),
        wall.cast("string").alias("wall"),
        utc_date(F.col("ts")).cast("string").alias("day"),
        (from_utc_wall_clock(wall) == F.col("ts")).alias("back"),
    ).collect()
    for r in rows:
        assert r.iso == r.text
        assert r.wall.replace(" ", "T") == r.text[:26].rstrip("0").rstrip(".") or (
            r.wall.replace(" ", "T") == r.text[:19]
        )
        assert r.day == r.text[:10]
        assert r.back


def test_iso_text_without_fraction(spark):
    df = spark.createDataFrame([("2026-03-01T05:17:08+00:00",)], "t string")
    got = df.select(utc_wall_clock(from_iso("t"))).first()[0]
    assert got == dt.datetime(2026, 3, 1, 5, 17, 8)


def test_epoch_millis_keeps_millis(spark):
    df = spark.createDataFrame([(1709424000123.0,)], "ms double")
    got = df.select(utc_wall_clock(epoch_millis(F.col("ms")))).first()[0]
    assert got == dt.datetime(2024, 3, 3, 0, 0, 0, 123000)


def test_required_column_fails_on_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "coin_id string")
    with pytest.raises(Exception, match="required column coin_id is NULL"):
        df.select(required("coin_id")).collect()
