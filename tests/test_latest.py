import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.operators.latest import keep_newest_days, latest_per_key
from marlstone.operators.topn import top_n_per_key
from marlstone.plans.silver import newest_documents

LATER = "2026-03-01T05:17:08.000001+00:00"
EARLIER = "2026-03-01T05:17:08+00:00"


def kept(df):
    return [r.payload for r in df.collect()]


def test_newer_batch_wins_in_any_order(spark, bronze):
    rows = [("btc", EARLIER, "old"), ("btc", LATER, "new")]
    assert kept(newest_documents(bronze(*rows))) == ["new"]
    assert kept(newest_documents(bronze(*rows[::-1]))) == ["new"]


@pytest.mark.parametrize("partitions", [1, 3, 7])
@pytest.mark.parametrize("step", [1, -1])
def test_ties_are_decided_by_update_time_then_payload(bronze, partitions, step):
    rows = [
        ("btc", LATER, "z", None),
        ("btc", LATER, "b", "2026-01-01"),
        ("btc", LATER, "c", "2026-01-01"),
        ("btc", LATER, "c", "2026-01-01"),
    ][::step]
    df = bronze(*rows).repartition(partitions)
    assert kept(newest_documents(df)) == ["c"]


row = st.tuples(
    st.sampled_from("abc"), st.integers(0, 3), st.none() | st.integers(0, 2)
)


@settings(max_examples=20, deadline=None)
@given(st.lists(row, min_size=1, max_size=20), st.integers(1, 5))
def test_against_brute_force(spark, rows, partitions):
    df = spark.createDataFrame(rows, "k string, t int, u int").repartition(partitions)
    once = latest_per_key(df, ["k"], ["t"])
    best = {}
    for k, t, u in rows:
        best[k] = max(best.get(k, (-1, -1)), (t, -1 if u is None else u))
    got = {r.k: (r.t, -1 if r.u is None else r.u) for r in once.collect()}
    assert got == best
    assert sorted(latest_per_key(once, ["k"], ["t"]).collect()) == sorted(once.collect())


def test_newest_days_keep_every_winner(spark):
    day = dt.date(2024, 1, 1)
    rows = [
        (k, day + dt.timedelta(days=d), i)
        for i, (k, d) in enumerate([("a", 0), ("a", 3), ("b", 1), ("b", 3), ("c", 2)])
    ]
    df = spark.createDataFrame(rows, "k string, day date, i int")
    kept_rows = keep_newest_days(df, ["k"], "day")
    assert sorted(r.i for r in kept_rows.collect()) == [1, 3, 4]
    assert kept_rows.columns == df.columns


def test_top_n_per_key_with_a_hot_key(spark):
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"),
        F.col("id").alias("v"),
    )
    top = top_n_per_key(hot, ["k"], 5, [F.desc("v")])
    got = sorted(r.v for r in top.where("k = 'hot'").collect())
    assert got == [19_998 - 3 * i for i in range(4, -1, -1)]
