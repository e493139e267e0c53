"""Data checks and replay."""

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.time import UTC_SUFFIX
from marlstone.schemas import PARTITION_COLUMN
from marlstone.sources.tables import Version, Warehouse


def quality_report(
    df: DataFrame, required: list[str], unique: list[str] | None = None
) -> DataFrame:
    """Row count, NULLs per required column and duplicates per unique column.

    One pass over the rows. Columns: check_name, n_rows (rows looked at) and
    n_failed (NULLs found, or rows beyond the first of each value).

    A row gives its pattern of NULLs and the value of each unique column, each as one
    narrow row that is counted before the shuffle: a pattern or value that very many
    rows have is sent once by a task.
    """
    unique = unique or []
    looked_at = list(dict.fromkeys([*required, *unique]))
    pattern = F.concat(
        F.lit(""), *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in looked_at]
    )
    seen = [F.struct(F.lit(-1).alias("place"), pattern.alias("value"))]
    seen += [
        F.struct(F.lit(i).alias("place"), _as_text(df, c).alias("value"))
        for i, c in enumerate(unique)
    ]
    counted = (
        df.select(F.inline(F.array(*seen)))
        .groupBy("place", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    of_rows = F.col("place") == -1

    def nulls(c: str):
        at = F.substring("value", looked_at.index(c) + 1, 1) == "1"
        return F.sum(F.when(of_rows & at, F.col("n")))

    totals = [F.sum(F.when(of_rows, F.col("n"))).alias("_rows")]
    totals += [nulls(c).alias(f"_nulls_{i}") for i, c in enumerate(looked_at)]
    totals += [
        F.count(F.when(F.col("place") == i, F.col("value"))).alias(f"_distinct_{i}")
        for i in range(len(unique))
    ]
    filled = counted.agg(*totals).fillna(0)
    return _report(
        filled, required, unique,
        {c: F.col(f"_nulls_{i}") for i, c in enumerate(looked_at)},
        {c: F.col(f"_distinct_{i}") for i, c in enumerate(unique)},
    )


def _as_text(df: DataFrame, name: str):
    """Equal texts for equal values, and only for them; NULL for NULL."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0).cast(kind)).cast("string")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    return value.cast("string")


def _report(
    counts: DataFrame, required: list[str], unique: list[str], nulls: dict, distinct: dict
) -> DataFrame:
    """The report of one row that has `_rows` and the given columns."""
    checks = [("row_count", F.lit(0).cast("bigint"))]
    checks += [(f"not_null:{c}", nulls[c]) for c in required]
    checks += [(f"unique:{c}", F.col("_rows") - nulls[c] - distinct[c]) for c in unique]
    report = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                F.col("_rows").alias("n_rows"),
                failed.cast("bigint").alias("n_failed"),
            )
            for name, failed in checks
        ]
    )
    return counts.select(F.inline(report))


def write_checked(
    wh: Warehouse,
    layer: str,
    table: str,
    rows: DataFrame,
    required: list[str],
    unique: list[str] | None = None,
    cluster_by: list[str] | None = None,
) -> tuple[Version, DataFrame]:
    """A written version of a model and its quality report, which the job can act on
    before it commits the version.

    Rows and NULLs are counted by the job that writes them. Only the unique columns
    are read again, from the written files.
    """
    unique = unique or []
    looked_at = list(dict.fromkeys([*required, *unique]))
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("_rows")]
    counts += [F.count_if(F.col(c).isNull()).alias(f"_nulls_{i}") for i, c in enumerate(looked_at)]
    version = wh.write(layer, table, rows, cluster_by, lambda df: df.observe(seen, *counts))
    found = seen.get
    n = found.get("_rows", 0)
    written = quality_report(wh.read(version).select(*unique), [], unique) if unique else None
    repeated = {r.check_name: r.n_failed for r in written.collect()} if unique else {}
    nulls = {c: found.get(f"_nulls_{i}", 0) for i, c in enumerate(looked_at)}
    rows_of = [("row_count", n, 0)]
    rows_of += [(f"not_null:{c}", n, nulls[c]) for c in required]
    rows_of += [(f"unique:{c}", n, repeated[f"unique:{c}"]) for c in unique]
    report = wh.spark.createDataFrame(
        rows_of, "check_name string, n_rows bigint, n_failed bigint"
    )
    return version, report


def failed_checks(report: DataFrame, min_rows: int = 1) -> DataFrame:
    """The report's failures, with too few rows counting as one."""
    return report.where(
        (F.col("n_failed") > 0)
        | ((F.col("check_name") == "row_count") & (F.col("n_rows") < min_rows))
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, as one small frame."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def as_of(raw: DataFrame, moment: dt.datetime, by: str = "ingested_at") -> DataFrame:
    """The bronze rows that were there at a moment. Bronze is append-only, so
    running a model over them gives the model's result as of then.

    Rows count from their ingestion time on. A batch that was appended late then
    appears in replays of moments before it arrived; with `by="arrived_at"`, on a
    table kept by batch, rows count from their arrival on, as readers have seen them.
    """
    if moment.utcoffset() is None:
        raise ValueError("the moment needs an offset, e.g. +00:00")
    utc = moment.astimezone(dt.timezone.utc)
    text = utc.strftime("%Y-%m-%dT%H:%M:%S.%f") + UTC_SUFFIX
    kept = raw.where(F.col(by) <= F.lit(text))
    if by == "ingested_at" and PARTITION_COLUMN in raw.columns:
        kept = kept.where(F.col(PARTITION_COLUMN) <= F.lit(utc.date()))
    return kept
