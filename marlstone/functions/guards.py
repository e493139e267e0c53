"""Checks that run inside the job that reads or writes the row."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def required(name: str) -> Column:
    """The column itself; the job fails on the first NULL it meets.

    Parquet nullability is not a check: Spark reads and writes every column as
    nullable. This one costs no pass of its own.
    """
    message = F.lit(f"required column {name} is NULL")
    return F.coalesce(F.col(name), F.raise_error(message)).alias(name)
