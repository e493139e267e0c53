"""The application's own tables in a relational database."""

from pyspark.sql import DataFrame, SparkSession

# The tables and columns the watchlist mart reads.
USER_WATCHLISTS = ("user_watchlists", ["user_id", "coin_id", "added_at"])
USER_PROFILES = ("user_profiles", ["user_id", "username"])


def jdbc_options(
    url: str,
    schema: str,
    table: str,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **credentials: str,
) -> dict[str, str]:
    """Options of a JDBC read; `bounds` of user_id split it into `partitions` reads.

    The bounds only place the splits: rows outside them are read as well. Without
    bounds the whole table goes through one task, which has to be asked for with
    `partitions=1`.
    """
    if bounds is None and partitions != 1:
        raise ValueError("a JDBC read needs bounds, or partitions=1 for a single task")
    options = {
        "url": url,
        "dbtable": f"{schema}.{table}",
        "fetchsize": str(fetch_size),
        **credentials,
    }
    if bounds is not None:
        low, high = bounds
        options |= {
            "partitionColumn": "user_id",
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions or 32),
        }
    return options


def user_id_bounds(
    spark: SparkSession, url: str, schema: str, table: str, **credentials: str
) -> tuple[int, int] | None:
    """Least and greatest user_id, computed by the database; None if empty."""
    query = f"SELECT min(user_id) AS low, max(user_id) AS high FROM {schema}.{table}"
    reader = spark.read.format("jdbc").options(url=url, query=query, **credentials)
    low, high = reader.load().first()
    return None if low is None else (int(low), int(high))


def app_table(
    spark: SparkSession, source: tuple[str, list[str]], options: dict[str, str]
) -> DataFrame:
    """One application table through JDBC, needed columns only."""
    _, columns = source
    return spark.read.format("jdbc").options(**options).load().select(*columns)
