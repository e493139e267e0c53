"""Sign of a change as a word."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def trend_of(change: Column) -> Column:
    """'up', 'down' or 'stable'; NULL, NaN and zero are 'stable'."""
    return (
        F.when(F.isnan(change), "stable")
        .when(change > 0, "up")
        .when(change < 0, "down")
        .otherwise("stable")
    )
