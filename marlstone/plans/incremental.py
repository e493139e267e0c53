"""Models kept up with bronze: only what was added is read, only what changed is written.

A refresh lists the bronze files and compares them with those that the published
version was made from. Days with new files are read again, whole: the newest document
per coin of those days is compared with the published one. A late file is in a day of
its own time, and its documents lose against newer ones that are published. As equal
ingestion times are on one day, the order among them is decided with all of them read.

Changed documents replace the rows of their coins, in the buckets of these coins; the
price history is kept as mergeable parts per coin, day and payload, of which only the
changed payloads' are made anew. All models are committed as one generation.
"""

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone import schemas as S
from marlstone.functions.json import is_malformed
from marlstone.plans import gold, silver
from marlstone.sources.keyed import BUCKETS, KeyedTable
from marlstone.sources.tables import (
    BRONZE_LAYER,
    GOLD_LAYER,
    SILVER_LAYER,
    Version,
    Warehouse,
)

#: Which document a coin's rows were made from; a change of it is a change of them.
DIGEST = "_digest"


def digest():
    """Of what decides between documents of one coin and ingestion time."""
    return F.sha2(F.to_json(F.struct("source_updated_at", "payload")), 256)


# -- what was added to bronze ----------------------------------------------------


def bronze_files(wh: Warehouse, table: str) -> DataFrame:
    """path and day of a bronze table's files. They are listed, none is opened."""
    found = (
        wh.spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(f"{wh.path(BRONZE_LAYER)}/{table}")
    )
    day = F.regexp_extract("path", f"/{S.PARTITION_COLUMN}=([^/]+)/", 1)
    return found.select("path", F.to_date(day).alias("day"))


def added_days(files: DataFrame, mark: DataFrame | None) -> list[dt.date]:
    """Days with files that the mark does not name; all days without a mark."""
    if mark is not None:
        files = files.join(mark, "path", "left_anti")
    return sorted(r.day for r in files.select("day").distinct().collect())


# -- models and their documents ---------------------------------------------------


@dataclass(frozen=True)
class Kept:
    """A staging model that follows a bronze table, and the marts made of its rows.

    `stage` and each mart turn rows into rows coin by coin. `documents` names the
    table with one row per coin that tells which document is published: the staging
    table itself, or one of its own where a document may have no rows.
    """

    source: str
    documents: str
    models: dict[tuple[str, str], Callable[..., DataFrame]]
    order_by: dict[str, list[str]]
    shown: dict[str, list[str]]


def _with_document(build: Callable[..., DataFrame], docs: DataFrame, strict: bool) -> DataFrame:
    """`build`'s rows, one per document, with the document's digest."""
    return build(docs, strict).join(docs.select("coin_id", digest().alias(DIGEST)), "coin_id")


def _market_rows(docs: DataFrame, strict: bool) -> DataFrame:
    return _with_document(silver.market_columns, docs, strict)


def _detail_rows(docs: DataFrame, strict: bool) -> DataFrame:
    return _with_document(silver.coin_detail_columns, docs, strict)


def _document_rows(docs: DataFrame, strict: bool) -> DataFrame:
    return docs.select("coin_id", "ingested_at", digest().alias(DIGEST))


def _summary_rows(docs: DataFrame, strict: bool) -> DataFrame:
    markets = silver.market_columns(docs, strict)
    return gold.market_summary(markets, with_coin_id=True, ordered=False)


def _history_rows(docs: DataFrame, strict: bool) -> DataFrame:
    return gold.history_figures(gold.history_parts(silver.price_points(docs, strict), strict))


# The summary's columns.
_SUMMARY = [
    "market_cap_rank", "name", "symbol", "current_price", "market_cap_billions",
    "volume_billions", "price_change_24h_pct", "price_trend", "volume_to_mcap_ratio",
    "ingested_at",
]

NEWEST_PRICES = "newest_historical_prices"

MARKETS = Kept(
    S.RAW_MARKETS,
    S.STG_MARKETS,
    {
        (SILVER_LAYER, S.STG_MARKETS): _market_rows,
        (GOLD_LAYER, S.MART_MARKET_SUMMARY): _summary_rows,
    },
    {},
    {S.MART_MARKET_SUMMARY: _SUMMARY},
)
DETAILS = Kept(
    S.RAW_COIN_DETAILS,
    S.STG_COIN_DETAILS,
    {(SILVER_LAYER, S.STG_COIN_DETAILS): _detail_rows},
    {},
    {},
)
PRICES = Kept(
    S.RAW_HISTORICAL_PRICES,
    NEWEST_PRICES,
    {
        (SILVER_LAYER, NEWEST_PRICES): _document_rows,
        (SILVER_LAYER, S.STG_HISTORICAL_PRICES): silver.price_points,
        (GOLD_LAYER, S.MART_PRICE_HISTORY): _history_rows,
    },
    {S.STG_HISTORICAL_PRICES: ["price_timestamp"], S.MART_PRICE_HISTORY: ["price_date"]},
    {},
)
ALL = [MARKETS, DETAILS, PRICES]


def keyed(wh: Warehouse, kept: Kept, layer: str, table: str, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(
        wh, layer, table, kept.shown.get(table), kept.order_by.get(table), buckets=buckets
    )


# -- merging ----------------------------------------------------------------------


def changed_documents(published: DataFrame | None, docs: DataFrame) -> DataFrame:
    """Those of `docs`, one per coin, that take the place of what is published.

    A document of an older ingestion time never does. One of an equal time does where
    it is another one: it was chosen among all documents of that time.
    """
    if published is None:
        return docs
    held = published.select(
        F.col("coin_id").alias("_coin"),
        F.col("ingested_at").alias("_held_at"),
        F.col(DIGEST).alias("_held"),
    )
    newer = F.col("_held_at").isNull() | (F.col("ingested_at") > F.col("_held_at"))
    other = (F.col("ingested_at") == F.col("_held_at")) & (digest() != F.col("_held"))
    return (
        docs.join(held, F.col("coin_id") == F.col("_coin"), "left")
        .where(newer | other)
        .select(*docs.columns)
    )


def merge_documents(
    wh: Warehouse,
    kept: Kept,
    docs: DataFrame,
    strict: bool = True,
    mark: str | None = None,
    buckets: int = BUCKETS,
) -> list[Version]:
    """Versions of the models in which changed documents have replaced their coins' rows.

    Written, not committed. The changed documents are written once and read by each
    model; where none changed, nothing is written but, if given, the mark.
    """
    state = keyed(wh, kept, SILVER_LAYER, kept.documents, buckets)
    first = state.version() is None
    with wh.scratch() as keep:
        changed = keep(changed_documents(state.rows(), docs))
        if not first and changed.isEmpty():
            return [state.marked(mark)] if mark else []

        def replaced(model) -> Version | None:
            (layer, table), build = model
            return keyed(wh, kept, layer, table, buckets).replace(
                build(changed, strict),
                None if first else changed.select("coin_id"),
                mark if table == kept.documents else None,
            )

        return wh.at_once(replaced, list(kept.models.items()))


def added_versions(
    wh: Warehouse, kept: Kept, strict: bool = True, buckets: int = BUCKETS
) -> list[Version]:
    """The models' versions with all that was added to their bronze table since the last."""
    state = keyed(wh, kept, SILVER_LAYER, kept.documents, buckets)
    with wh.scratch() as keep:
        files = keep(bronze_files(wh, kept.source))
        days = added_days(files, state.mark())
        if not days:
            return []
        mark = state.write_mark(files.select("path"))
    docs = added_documents(wh, kept, days, strict, whole=state.version() is None)
    return merge_documents(wh, kept, docs, strict, mark, buckets)


def added_documents(
    wh: Warehouse, kept: Kept, days: list[dt.date], strict: bool = True, whole: bool = False
) -> DataFrame:
    """The newest document per coin of some days; of the whole table without a filter."""
    raw = wh.table(BRONZE_LAYER, kept.source)
    if not whole:
        raw = raw.where(F.col(S.PARTITION_COLUMN).isin(days))
    if not strict:
        raw = raw.where(~is_malformed("payload"))
    return silver.newest_documents(raw)


def refresh_added(
    wh: Warehouse,
    strict: bool = True,
    kept: list[Kept] | None = None,
    buckets: int = BUCKETS,
) -> int:
    """Bring the kept models up to date and commit them as one generation.

    Returns the generation; it stays the same where nothing was added. Readers of
    `Warehouse.snapshot` see either all models before or all after.
    """
    kept = ALL if kept is None else kept
    kept = [k for k in kept if wh.exists(BRONZE_LAYER, k.source)]
    wh.create_layers()
    added = wh.at_once(lambda k: added_versions(wh, k, strict, buckets), kept)
    versions = [v for part in added for v in part]
    generation = wh.commit(versions)
    clean(wh, versions)
    return generation


def clean(wh: Warehouse, versions: list[Version]) -> None:
    for v in versions:
        KeyedTable(wh, v.layer, v.table).clean()
