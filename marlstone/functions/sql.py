"""Names used by ad-hoc SQL on the bronze tables, as inlined SQL functions.

They expand to the same built-in expressions as the DataFrame helpers; repeated
calls on one payload share a single parse.
"""

from pyspark.sql import SparkSession

_FUNCTIONS = [
    """
    CREATE OR REPLACE TEMPORARY FUNCTION json_extract_scalar(document STRING, path STRING)
    RETURNS STRING
    RETURN CASE
        WHEN schema_of_variant(variant_get(parse_json(document), path, 'variant'))
             RLIKE '^(OBJECT|ARRAY)' THEN NULL
        ELSE CAST(variant_get(parse_json(document), path, 'variant') AS STRING)
    END
    """,
    """
    CREATE OR REPLACE TEMPORARY FUNCTION from_iso8601_timestamp(text STRING)
    RETURNS TIMESTAMP
    RETURN to_timestamp(text)
    """,
]


def register(spark: SparkSession) -> None:
    """Make the functions callable from spark.sql in this session."""
    for statement in _FUNCTIONS:
        spark.sql(statement)
