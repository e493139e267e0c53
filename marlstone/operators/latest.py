"""Newest row per key."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: list[str],
    newest_by: list[str],
    tie_breakers: list[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest by `newest_by`, then by `tie_breakers`.

    NULLs sort as oldest. Without `tie_breakers` all other columns break ties,
    so that the result does not depend on partitioning or input order.

    The rank filter lets Spark keep one row per key and task before the
    shuffle, so a key holding a third of all rows sends no more than any other.
    """
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys + newest_by]
    order = [F.desc_nulls_last(c) for c in newest_by + tie_breakers]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def keep_newest_days(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Drop the days on which no key has its newest row.

    Exact: every key's newest row lies on the greatest day the key appears on,
    and only days that are nobody's greatest are dropped. With `day` as the
    table's partition column this reads `keys` alone, as a hash aggregate with
    map-side combine, and then skips the other days' files by dynamic partition
    pruning. The broadcast side is a set of distinct calendar days, bounded by
    the calendar and not by the data.
    """
    # The always-true lower bound marks this side as a filter: without one
    # Spark does not consider it for dynamic partition pruning.
    newest_days = (
        df.groupBy(*keys)
        .agg(F.max(day).alias(day))
        .where(F.col(day) >= F.lit("0001-01-01").cast("date"))
        .select(day)
        .distinct()
    )
    return df.join(F.broadcast(newest_days), day, "left_semi").select(*df.columns)
