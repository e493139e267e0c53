"""Landed API responses -> bronze envelope.

A landed response is one JSON text: one file each, or one line each for bulk
loads, which name the coin in the line where responses have one. `*_records` turns responses into records, `envelope` turns records into
bronze rows. All of it is a single narrow stage: no shuffle, no driver-side
list. The same functions serve batch and streaming frames.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.guards import required
from marlstone.functions.json import is_malformed, json_scalar
from marlstone.functions.time import CANONICAL_UTC, UTC_SUFFIX, iso_date, iso_utc
from marlstone.schemas import PARTITION_COLUMN

_RESPONSE = "value STRING"
_RESPONSE_OF_COIN = "value STRING, coin_id STRING"


def read_responses(
    spark: SparkSession,
    path: str,
    per_coin: bool = False,
    whole_files: bool = True,
    named_lines: bool = False,
) -> DataFrame:
    """Responses under a landing folder: value, received_at [, coin_id].

    `per_coin` reads coin_id=<id> folders; with `named_lines` lines as
    `write_named_lines` leaves them, of which a file holds those of many coins.
    received_at is the file's modification time: one response is one batch, and
    reading it again gives the same rows.
    """
    reader = spark.read.schema(_RESPONSE_OF_COIN if per_coin else _RESPONSE)
    if named_lines:
        if not per_coin or whole_files:
            raise ValueError("named_lines needs per_coin=True and whole_files=False")
        named = reader.json(path, mode="FAILFAST")
        # No folder can be named by an empty id either: it is read as NULL.
        coin = F.nullif(F.col("coin_id"), F.lit("")).alias("coin_id")
        return _with_arrival(named).select("value", coin, "received_at")
    return _with_arrival(reader.text(path, wholetext=whole_files))


def write_named_lines(responses: DataFrame, path: str) -> None:
    """Bulk load of responses (coin_id, value): a JSON object of the two a line.

    A folder for each coin would be a file and a directory listing for each.
    """
    responses.select("coin_id", "value").write.json(path)


def stream_responses(
    spark: SparkSession,
    path: str,
    per_coin: bool = False,
    whole_files: bool = True,
    max_files: int = 10_000,
) -> DataFrame:
    """As read_responses, following the folder; `max_files` bounds one batch."""
    reader = (
        spark.readStream.schema(_RESPONSE_OF_COIN if per_coin else _RESPONSE)
        .option("maxFilesPerTrigger", max_files)
    )
    return _with_arrival(reader.text(path, wholetext=whole_files))


def market_records(responses: DataFrame, strict: bool = True) -> DataFrame:
    """One record per element of each response array.

    A response that is not an array fails; when not strict it yields nothing
    here and everything in `rejected_responses`.
    """
    elements = _elements(F.col("value"))
    if strict:
        message = F.concat(
            F.lit("market response is not a JSON array: "), F.left("value", F.lit(200))
        )
        elements = F.coalesce(elements, F.raise_error(message))
    listed = responses.select(
        *_carried(responses), F.explode(elements).alias("payload")
    )
    parsed = listed.select(
        *_carried(responses), "payload", F.try_parse_json("payload").alias("_doc")
    )
    return parsed.select(
        json_scalar("_doc", "$.id").alias("coin_id"),
        json_scalar("_doc", "$.last_updated").alias("source_updated_at"),
        "payload",
        *_carried(responses),
    )


def coin_details_records(responses: DataFrame) -> DataFrame:
    """One record per response; the id comes from the request."""
    parsed = responses.select(
        "coin_id",
        *_carried(responses),
        F.col("value").alias("payload"),
        F.try_parse_json("value").alias("_doc"),
    )
    return parsed.select(
        "coin_id",
        json_scalar("_doc", "$.last_updated").alias("source_updated_at"),
        "payload",
        *_carried(responses),
    )


def historical_prices_records(responses: DataFrame) -> DataFrame:
    """One record per response; a price series has no update time."""
    return responses.select(
        "coin_id",
        F.lit(None).cast("string").alias("source_updated_at"),
        F.col("value").alias("payload"),
        *_carried(responses),
    )


def records_from_columns(
    df: DataFrame, coin_id: Column, source_updated_at: Column | None = None
) -> DataFrame:
    """Records from columnar input: the whole row as JSON, NULL fields kept."""
    updated = F.lit(None) if source_updated_at is None else source_updated_at
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.select(
        coin_id.cast("string").alias("coin_id"),
        updated.cast("string").alias("source_updated_at"),
        F.to_json(row, {"ignoreNullFields": "false"}).alias("payload"),
    )


def envelope(
    records: DataFrame,
    batch_time: dt.datetime | str | Column | None = None,
    strict: bool = True,
) -> DataFrame:
    """Bronze rows of records, with ingest_date for the partitioned table.

    `batch_time` is the batch's one ingestion time. Without it each response
    counts as a batch and its arrival time is taken. A NULL in a required
    column fails the job, and so does a time that is not a UTC text of six
    fraction digits: times are compared as texts. When not strict such rows are
    left to `rejected_records`, given the same `batch_time`.
    """
    stamped = records.withColumn("ingested_at", _stamp(records, batch_time))
    if strict:
        message = F.concat(F.lit("ingested_at is not canonical UTC: "), "ingested_at")
        checked = F.when(
            F.col("ingested_at").isNull() | _is_canonical("ingested_at"),
            F.col("ingested_at"),
        ).otherwise(F.raise_error(message))
        stamped = stamped.withColumn("ingested_at", checked)
    else:
        stamped = stamped.where(~_incomplete() & _is_canonical("ingested_at"))
    rows = stamped.select(
        required("coin_id"),
        "source_updated_at",
        required("ingested_at"),
        required("payload"),
    )
    return rows.withColumn(PARTITION_COLUMN, iso_date(F.col("ingested_at")))


def rejected_responses(responses: DataFrame) -> DataFrame:
    """Responses that market_records cannot list."""
    return responses.where(_elements(F.col("value")).isNull())


def rejected_records(
    records: DataFrame, batch_time: dt.datetime | str | Column | None = None
) -> DataFrame:
    """Records without an id or payload, or whose payload is not valid JSON.

    With `batch_time` also those that it gives no canonical UTC time.
    """
    rejected = _incomplete()
    if batch_time is not None:
        rejected |= ~_is_canonical(_stamp(records, batch_time))
    return records.where(rejected)


def _elements(value: Column) -> Column:
    """Elements of a JSON array as JSON texts; NULL for anything else.

    JSON readers stop at the closing bracket. Text behind it shows where the
    whole is put into an array or an object: one of the two is then malformed.
    """
    elements = F.from_json(value, "ARRAY<STRING>")
    as_element = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))
    as_field = F.try_parse_json(F.concat(F.lit('{"v":'), value, F.lit("}")))
    alone = F.size(F.try_variant_get(as_element, "$", "array<variant>")) == 1
    return F.when(alone & as_field.isNotNull(), elements)


def _is_canonical(time: Column | str) -> Column:
    time = F.col(time) if isinstance(time, str) else time
    return F.coalesce(time.rlike(CANONICAL_UTC), F.lit(False))


def _incomplete() -> Column:
    return (
        F.col("coin_id").isNull() | F.col("payload").isNull() | is_malformed("payload")
    )


def _carried(responses: DataFrame) -> list[str]:
    return [c for c in ("received_at",) if c in responses.columns]


def _with_arrival(responses: DataFrame) -> DataFrame:
    return responses.withColumn("received_at", F.col("_metadata.file_modification_time"))


def _stamp(
    records: DataFrame, batch_time: dt.datetime | str | Column | None
) -> Column:
    if batch_time is None:
        if "received_at" in records.columns:
            return iso_utc(F.col("received_at"))
        batch_time = dt.datetime.now(dt.timezone.utc)
    if isinstance(batch_time, Column):
        return batch_time
    if isinstance(batch_time, str):
        batch_time = dt.datetime.fromisoformat(batch_time)
    if batch_time.utcoffset() is None:
        raise ValueError("batch_time needs an offset, e.g. +00:00")
    utc = batch_time.astimezone(dt.timezone.utc)
    return F.lit(utc.strftime("%Y-%m-%dT%H:%M:%S.%f") + UTC_SUFFIX)
