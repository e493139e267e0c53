"""Landing folder -> bronze table, as a stream of small appends."""

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from marlstone.sources.landing import envelope, rejected_responses
from marlstone.sources.tables import Warehouse


def start_ingest(
    wh: Warehouse,
    table: str,
    records: DataFrame,
    checkpoint: str,
    every: str | None = None,
    on_rejected: Callable[[DataFrame], None] | None = None,
    parse: Callable[[DataFrame], DataFrame] | None = None,
    on_rejected_responses: Callable[[DataFrame], None] | None = None,
    batches: str | None = None,
) -> StreamingQuery:
    """Append a stream of records to a bronze table.

    `records` is a streaming frame from the `*_records` functions, or of
    responses that `parse` turns into records. A batch that
    is replayed after a failure carries the same arrival times, so appending
    only what is missing makes every record land exactly once. With `every`
    (e.g. "2 minutes") the stream keeps following the folder; without it, it
    takes what is there and stops.

    A record that fails the required-column gate stops the stream, unless
    `on_rejected` is given: it receives each batch's records, to keep those
    that `rejected_records` finds, and the good ones are appended. A lenient
    `parse` leaves out whole responses; `on_rejected_responses` receives those.
    The batch is read once and kept while it is looked at and appended.

    `batches` names the stream, for a table kept by batch: a trigger's rows are the
    batch of that name and the trigger's number, so that a replay overwrites its
    own partitions and nothing held has to be read. A stream that starts again
    without its checkpoint counts from zero and needs another name.
    """

    def append(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if on_rejected_responses is not None:
                on_rejected_responses(rejected_responses(batch))
            found = batch if parse is None else parse(batch)
            if on_rejected is not None:
                on_rejected(found)
            rows = envelope(found, strict=on_rejected is None)
            if batches is None:
                wh.append_once(table, rows)
            else:
                wh.append_batch(table, rows, f"{batches}-{number:09}")
        finally:
            batch.unpersist()

    wh.create_bronze(table, by_batch=batches is not None)
    return (
        records.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .start()
    )
