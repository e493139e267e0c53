"""Which coins a symbol stands for, so that a symbol's rows are found by coin.

Documents hold the symbol, files are sorted by coin and have Bloom filters on it. The
table `coin_symbols` has every pair of symbol and coin that occurs in bronze rows, as
of the files it was made from. Rows in days with newer files are looked at without it,
so what is found is complete however old the table is.
"""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone import schemas as S
from marlstone.functions.json import top_level, top_level_scalar
from marlstone.plans.incremental import added_days, bronze_files, clean
from marlstone.sources.keyed import BUCKETS, KeyedTable
from marlstone.sources.tables import BRONZE_LAYER, SILVER_LAYER, Warehouse

COIN_SYMBOLS = "coin_symbols"

# A symbol of more coins than this is not turned into a filter on them.
MOST_COINS = 1_000


def symbol_table(wh: Warehouse, buckets: int = BUCKETS) -> KeyedTable:
    return KeyedTable(
        wh, SILVER_LAYER, COIN_SYMBOLS, order_by=["coin_id"], key="symbol", buckets=buckets
    )


def pairs(raw_markets: DataFrame) -> DataFrame:
    """The different pairs of symbol, in lower case, and coin; malformed documents have none."""
    fields = top_level("payload", ["symbol"], strict=False).alias("fields")
    read = raw_markets.select("coin_id", "payload", fields)
    symbol = F.lower(top_level_scalar("fields", "payload", "symbol"))
    return read.select(symbol.alias("symbol"), "coin_id").where("symbol IS NOT NULL").distinct()


def refresh_symbols(wh: Warehouse, buckets: int = BUCKETS) -> int:
    """Add the pairs of days with new files; returns the generation.

    Buckets of symbols that have a new coin are written, others stay as they are.
    """
    table = symbol_table(wh, buckets)
    held = table.rows()
    with wh.scratch() as keep:
        files = keep(bronze_files(wh, S.RAW_MARKETS))
        days = added_days(files, table.mark())
        if not days:
            return wh.snapshot().generation
        mark = table.write_mark(files.select("path"))
        raw = wh.table(BRONZE_LAYER, S.RAW_MARKETS)
        if held is None:
            version = table.replace(pairs(raw), mark=mark)
        else:
            found = pairs(raw.where(F.col(S.PARTITION_COLUMN).isin(days)))
            fresh = keep(found.join(held, ["symbol", "coin_id"], "left_anti"))
            keys = fresh.select("symbol").distinct()
            grown = held.join(keys, "symbol", "left_semi").select("symbol", "coin_id")
            version = table.replace(grown.unionByName(fresh), keys, mark)
            version = version or table.marked(mark)
    generation = wh.commit([version])
    clean(wh, [version])
    return generation


def rows_of_symbol(
    wh: Warehouse, symbol: str, files: DataFrame | None = None
) -> tuple[DataFrame, list[dt.date]]:
    """Bronze market rows among which all of a symbol are, and the days read whole.

    `files` may give the listing of the table's files; it is made otherwise.
    """
    raw = wh.table(BRONZE_LAYER, S.RAW_MARKETS)
    table = symbol_table(wh)
    if table.version() is None:
        return raw, wh.days(S.RAW_MARKETS)
    listed = bronze_files(wh, S.RAW_MARKETS) if files is None else files
    newer = added_days(listed, table.mark())
    lowered = wh.spark.range(1).select(F.lower(F.lit(symbol))).first()[0]
    coins = [r.coin_id for r in table.rows_of([lowered]).limit(MOST_COINS + 1).collect()]
    if len(coins) > MOST_COINS:
        return raw, wh.days(S.RAW_MARKETS)
    of_coins = F.col("coin_id").isin(coins) if coins else F.lit(False)
    day = F.col(S.PARTITION_COLUMN)
    if not newer:
        return raw.where(of_coins), []
    return raw.where(~day.isin(newer) & of_coins).unionByName(raw.where(day.isin(newer))), newer
