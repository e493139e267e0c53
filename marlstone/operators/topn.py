"""Bounded reports: the n greatest rows, overall or per key."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first n rows of an order; Spark keeps n per task and merges those."""
    return df.orderBy(*order).limit(n)


def top_n_per_key(
    df: DataFrame, keys: list[str], n: int, order: list[Column]
) -> DataFrame:
    """The first n rows of each key; n rows per key and task reach the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
