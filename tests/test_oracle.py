"""Every query against its SQL oracle on the smallest test tables."""

import pytest
from oracle import connect, differences

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con():
    return connect(entry.SMOKE_DIR)


@pytest.mark.parametrize("name", list(entry.library_queries()))
def test_query_equals_oracle(spark, con, name):
    sql = entry.oracle_sql()[name]
    assert differences(spark, con, entry.queries()[name], sql, entry.SMOKE_DIR) == {}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "market_cap_rank"


@pytest.mark.parametrize("zone", ["America/New_York"])
@pytest.mark.parametrize(
    "name", ["market_summary", "price_history", "stg_historical_prices", "live_prices"]
)
def test_results_do_not_depend_on_the_session_zone(spark, con, in_zone, zone, name):
    in_zone(zone)
    sql = entry.oracle_sql()[name]
    assert differences(spark, con, entry.queries()[name], sql, entry.SMOKE_DIR) == {}
