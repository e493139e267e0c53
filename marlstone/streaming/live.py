"""Bronze market rows -> live stg_markets and mart_market_summary."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marlstone import schemas as S
from marlstone.functions.json import is_malformed
from marlstone.plans import incremental
from marlstone.sources.keyed import BUCKETS
from marlstone.sources.tables import BRONZE_LAYER, SILVER_LAYER, Warehouse


def stream_bronze(
    spark: SparkSession, wh: Warehouse, table: str, max_files: int = 10_000
) -> DataFrame:
    """A bronze table's files as a stream, those already there first."""
    columns = wh.table(BRONZE_LAYER, table).columns
    return (
        spark.readStream.schema(S.BATCHED if S.BATCH_COLUMN in columns else S.BRONZE)
        .option("maxFilesPerTrigger", max_files)
        .parquet(f"{wh.path(BRONZE_LAYER)}/{table}")
    )


def newest_documents(rows: DataFrame) -> DataFrame:
    """Running newest document per coin; a trigger emits the coins it has rows of.

    The greatest (ingestion time, update time, payload) wins, which is the
    order the batch model ranks by, so a late file with an older ingestion time
    changes nothing. State is one row per coin and needs no watermark.
    """
    order = F.struct("ingested_at", "source_updated_at", "payload")
    return (
        rows.groupBy("coin_id")
        .agg(F.max(order).alias("newest"))
        .select("coin_id", "newest.*")
    )


def start_live_refresh(
    wh: Warehouse,
    rows: DataFrame,
    checkpoint: str,
    every: str | None = None,
    strict: bool = True,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep the two live tables equal to the batch models over all rows so far.

    A trigger reads the new files only and emits the coins in them. Those whose
    newest document is another one than before replace their rows, in the buckets of
    these coins; other buckets are neither read nor written, and where no coin
    changed nothing is committed. A trigger that is run again after a failure finds
    its documents published and does nothing. Tables that a batch job has published
    whole are first taken over as they are in bronze, so that no reader loses coins.
    """

    def publish(emitted: DataFrame, _: int) -> None:
        kept = incremental.MARKETS
        if wh.current(SILVER_LAYER, kept.documents) is not None:
            state = incremental.keyed(wh, kept, SILVER_LAYER, kept.documents)
            if state.version() is None:
                wh.commit(incremental.added_versions(wh, kept, strict, buckets))
        with wh.scratch() as keep:
            # Stored first: each action on it would run the stateful stage again.
            docs = keep(emitted)
            versions = incremental.merge_documents(wh, kept, docs, strict, None, buckets)
        wh.commit(versions)
        incremental.clean(wh, versions)

    if not strict:
        rows = rows.where(~is_malformed("payload"))
    return (
        newest_documents(rows)
        .writeStream.outputMode("update")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .start()
    )
