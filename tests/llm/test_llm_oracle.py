"""Registered queries that have SQL, and the registration as a whole."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from marlstone.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.oracles()))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "labels", "benchmark", "conversations"):
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'"
        )
    found = entry.queries()[name](spark, SF)
    columns = sorted(found.columns)
    expected = connection.execute(
        f"SELECT {', '.join(columns)} FROM ({queries.oracles()[name]})"
    ).fetchall()
    rows = [tuple(r) for r in found.select(*columns).collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))


def test_registration():
    names = set(entry.queries())
    numbers = sorted(int(x[2:].split("_")[0]) for x in names if x.startswith("op"))
    assert numbers == list(range(1, len(numbers) + 1))
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
