"""Direction of a time series."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def direction_of(df: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """Compare each key's last value with its first.

    'up' when last >= first, otherwise 'down', also when either is NULL. Keys
    with a single point have no direction and are left out. Equal times are
    ordered by value.
    """
    point = F.struct(F.col(time), F.col(value))
    ends = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min(point).alias("_first"),
        F.max(point).alias("_last"),
    )
    first, last = F.col(f"_first.{value}"), F.col(f"_last.{value}")
    rising = F.coalesce(last >= first, F.lit(False))
    return ends.where("n_points > 1").select(
        *keys,
        "n_points",
        first.alias("first_value"),
        last.alias("last_value"),
        F.when(rising, "up").otherwise("down").alias("direction"),
    )
