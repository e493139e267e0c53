"""Run a query and its oracle side by side and compare the row multisets."""

from collections import Counter

import duckdb
from pyspark.sql import SparkSession

# The tables of a test data folder.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return con


def differences(
    spark: SparkSession, con: duckdb.DuckDBPyConnection, query, sql: str, sf_dir: str
) -> dict:
    """Rows on one side only, and column names where those differ."""
    got = query(spark, sf_dir).toArrow()
    want = con.sql(sql).to_arrow_table()
    names = sorted(got.column_names)
    if names != sorted(want.column_names):
        return {"columns": (names, sorted(want.column_names))}
    kinds = {
        c: (str(got.schema.field(c).type), str(want.schema.field(c).type))
        for c in names
        if _kind(got.schema.field(c).type) != _kind(want.schema.field(c).type)
    }
    left, right = _rows(got, names), _rows(want, names)
    return {
        k: v
        for k, v in {
            "types": kinds,
            "only_spark": list((left - right).elements())[:3],
            "only_oracle": list((right - left).elements())[:3],
            "counts": None if got.num_rows == want.num_rows else (got.num_rows, want.num_rows),
        }.items()
        if v
    }


def _kind(arrow_type) -> str:
    return str(arrow_type).replace("large_string", "string").replace("string_view", "string")


def _rows(table, names) -> Counter:
    return Counter(zip(*(map(repr, table.column(c).to_pylist()) for c in names)))
