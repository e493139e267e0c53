import datetime as dt

import pytest
from pyspark.sql import functions as F

from marlstone import schemas as S
from marlstone.plans import checks, jobs
from marlstone.sources.landing import envelope
from marlstone.sources.tables import SILVER_LAYER

SCHEMA = "id long, name string, x double, at timestamp, day date, flag boolean, n decimal(9,2)"
AT = dt.datetime(2026, 10, 25, 0, 30, tzinfo=dt.timezone.utc)
ROWS = [
    (1, "a", 0.0, AT, AT.date(), True, None),
    (1, "a", -0.0, AT + dt.timedelta(hours=1), AT.date(), False, None),
    (2, None, float("nan"), None, None, None, None),
    (None, "", float("nan"), AT, AT.date(), None, None),
    (None, "1", 1e300, AT, AT.date(), True, None),
]


def plainly(df, required, unique):
    """The report by Spark's own counts, a column at a time."""
    n = df.count()
    yield "row_count", n, 0
    for c in required:
        yield f"not_null:{c}", n, df.where(F.col(c).isNull()).count()
    for c in unique:
        filled = df.where(F.col(c).isNotNull()).select(c)
        yield f"unique:{c}", n, filled.count() - filled.distinct().count()


@pytest.mark.parametrize("kept", [5, 0])
def test_reports_equal_plain_counts(spark, wh, kept, in_zone):
    # A zone that shows two of the times as the same local one.
    in_zone("Europe/Berlin")
    df = spark.createDataFrame(ROWS[:kept], SCHEMA).repartition(3)
    required, unique = ["id", "name", "n"], ["id", "name", "x", "at", "day", "flag", "n"]
    want = sorted(plainly(df, required, unique))
    assert sorted(map(tuple, checks.quality_report(df, required, unique).collect())) == want
    version, report = checks.write_checked(wh, SILVER_LAYER, "checked", df, required, unique)
    assert sorted(map(tuple, report.collect())) == want
    assert wh.read(version).count() == kept and not wh.exists(SILVER_LAYER, "checked")
    alone = checks.quality_report(df, [])
    assert [tuple(r) for r in alone.collect()] == [("row_count", kept, 0)]


def test_a_refresh_that_fails_its_checks_is_not_committed(wh, bronze):
    at = "2026-03-01T00:00:00.000000+00:00"
    wh.append(S.RAW_MARKETS, envelope(bronze(("a", at, "{}")).drop("ingested_at"), at))
    assert jobs.refresh_live(wh, checked=True).count() == 1
    held = wh.spark.sql(f"SELECT * FROM {wh.name('bronze', S.RAW_MARKETS)} LIMIT 0")
    real, wh.table = wh.table, lambda layer, table: held if layer == "bronze" else real(layer, table)
    with pytest.raises(ValueError, match="row_count"):
        jobs.refresh_live(wh, checked=True)
    assert real(SILVER_LAYER, S.STG_MARKETS).count() == 1
