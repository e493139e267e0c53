"""Layer tables in the session's catalog.

A table is `<layer>.<table>`, stored under `<root>/<layer>/`. Bronze tables are
append-only Parquet, partitioned by ingestion day. A model is published by
writing it as a new versioned table and then replacing the view that carries the
model's name: readers see the old rows or the new ones, never a half-written mix,
and a query that already runs keeps its version.

Several models are committed as one generation: all versions are written first.
The view `generation` in the gold layer then names them, and is the one place that
readers of more than one model have to look at (`Warehouse.snapshot`); the views of
the models follow it.
"""

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marlstone.functions.time import UTC_SUFFIX, iso_date
from marlstone.schemas import ARRIVED_AT, BATCH_COLUMN, BATCHED, BRONZE, PARTITION_COLUMN

# The layers.
BRONZE_LAYER = "bronze"
SILVER_LAYER = "silver"
GOLD_LAYER = "gold"
LAYERS = [BRONZE_LAYER, SILVER_LAYER, GOLD_LAYER]

# Bronze files have a Bloom filter of the coins in each row group: a batch has rows of
# most coins, so that the least and greatest one of a row group tell little. Where a
# coin is in a file, its rows stand together, and small pages keep the others unread.
_BY_COIN = {
    "parquet.bloom.filter.enabled#coin_id": "true",
    "parquet.bloom.filter.expected.ndv#coin_id": "20000",
    "parquet.page.row.count.limit": "500",
}

# The view that names a generation's versions.
GENERATION = "generation"


def _text(value: str) -> str:
    """As an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Version:
    """A written version of a model, and the columns that readers of the model see."""

    layer: str
    table: str
    name: str
    columns: tuple[str, ...]


class Snapshot:
    """The versions of one generation; whatever is committed later, these stay."""

    def __init__(self, spark: SparkSession, generation: int, versions: list[Version]):
        self.spark = spark
        self.generation = generation
        self.versions = {(v.layer, v.table): v for v in versions}

    def table(self, layer: str, table: str) -> DataFrame:
        version = self.versions[layer, table]
        return self.spark.table(version.name).select(*version.columns)


class Warehouse:
    """Bronze, silver and gold under one root folder.

    A layer's name is used verbatim as its schema; `schemas` maps it to another
    where several warehouses share one catalog.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schemas: dict[str, str] | None = None,
        keep_versions: int = 3,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = {layer: layer for layer in LAYERS} | (schemas or {})
        self.keep_versions = keep_versions
        self.properties: dict[str, dict[str, str]] = {}
        self._committing = threading.RLock()

    # -- names ---------------------------------------------------------------

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.schemas[layer]}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def create_layers(self) -> None:
        for layer, schema in self.schemas.items():
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{self.path(layer)}'"
            )

    # -- bronze --------------------------------------------------------------

    def create_bronze(self, table: str, by_batch: bool = False) -> None:
        """Create the table if it is missing; an existing one is left alone.

        One kept `by_batch` has a partition for each batch of a day, see `append_batch`.

        The table is external, as bronze is the record everything else is
        rebuilt from: dropping it keeps the files, and creating it over files
        that are already there, under a new catalog say, takes them in.
        """
        self.create_layers()
        if self.exists(BRONZE_LAYER, table):
            return
        name, path = self.name(BRONZE_LAYER, table), f"{self.path(BRONZE_LAYER)}/{table}"
        schema = BATCHED if by_batch else BRONZE
        parts = [PARTITION_COLUMN, BATCH_COLUMN] if by_batch else [PARTITION_COLUMN]
        # Appending no rows makes sure that the folder exists.
        empty = self.spark.createDataFrame([], schema)
        empty.write.mode("append").partitionBy(*parts).parquet(path)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        options = ", ".join(f"'{k}' = '{v}'" for k, v in _BY_COIN.items())
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"OPTIONS ({options}) PARTITIONED BY ({', '.join(parts)}) LOCATION '{path}'"
        )
        self.spark.catalog.recoverPartitions(name)

    def append(self, table: str, batch: DataFrame, backfill: bool = False) -> None:
        """Append envelope rows as they are: no update, no deduplication.

        Each task sorts what it writes by day and coin, so that row groups hold
        few coins each; nothing is shuffled. That suits a batch of one or few
        days. A `backfill` of many days would leave a file per day and task, so
        its rows are first brought together by day; Spark splits a day into
        tasks by its size.
        """
        self.create_bronze(table)
        rows = batch.select(*BRONZE.names)
        if backfill:
            rows = rows.hint("rebalance", F.col(PARTITION_COLUMN))
        (
            rows.sortWithinPartitions(PARTITION_COLUMN, "coin_id", "ingested_at")
            .write.mode("append")
            .insertInto(self.name(BRONZE_LAYER, table))
        )

    def append_once(
        self, table: str, batch: DataFrame, backfill: bool = False
    ) -> None:
        """Append only the rows that the table does not hold yet.

        A retried batch, whether its first attempt was committed wholly, partly
        or not at all, leaves the table with every row of the batch. The batch's
        first and last ingestion time bound what is looked at: by partition,
        and within it by the Parquet statistics of files, as each file holds
        the ingestion times of one append.
        """
        self.create_bronze(table)
        first, last = batch.agg(F.min("ingested_at"), F.max("ingested_at")).first()
        if first is None:
            return
        held = self.table(BRONZE_LAYER, table).where(
            F.col("ingested_at").between(first, last)
            & F.col(PARTITION_COLUMN).between(
                iso_date(F.lit(first)), iso_date(F.lit(last))
            )
        )
        row = F.xxhash64("source_updated_at", "payload").alias("_row")
        identity = ["coin_id", "ingested_at", "_row"]
        # Distinct, so that copies already held count once in the shuffle too.
        known = held.select("*", row).select(*identity).distinct()
        fresh = batch.select("*", row).join(known, identity, "left_anti")
        self.append(table, fresh, backfill)

    def append_batch(
        self,
        table: str,
        batch: DataFrame,
        batch_id: str,
        arrived_at: dt.datetime | None = None,
        backfill: bool = False,
    ) -> None:
        """Append a batch under its name to a table kept by batch.

        A retry under the same name replaces what an attempt before it has left,
        whether whole, half-written or doubled, and reads nothing of the table: the
        partitions of its days and name are overwritten as one commit. The same batch
        has the same days, as these follow from its rows. Each row gets the time at
        which the batch was appended (now, unless given), beside that of its ingestion.
        """
        self.create_bronze(table, by_batch=True)
        arrived = (arrived_at or dt.datetime.now(dt.timezone.utc)).astimezone(dt.timezone.utc)
        text = arrived.strftime("%Y-%m-%dT%H:%M:%S.%f") + UTC_SUFFIX
        rows = (
            batch.withColumn(ARRIVED_AT, F.lit(text))
            .withColumn(BATCH_COLUMN, F.lit(batch_id))
            .select(*BATCHED.names)
        )
        if backfill:
            rows = rows.hint("rebalance", F.col(PARTITION_COLUMN))
        name = self.name(BRONZE_LAYER, table)
        written = Observation()
        (
            rows.observe(written, F.collect_set(PARTITION_COLUMN).alias("days"))
            .sortWithinPartitions(PARTITION_COLUMN, "coin_id", "ingested_at")
            .write.mode("overwrite")
            .options(partitionOverwriteMode="dynamic", **_BY_COIN)
            .partitionBy(PARTITION_COLUMN, BATCH_COLUMN)
            .parquet(f"{self.path(BRONZE_LAYER)}/{table}")
        )
        # The catalog gets to know partitions that are new; a batch has few days.
        for day in written.get["days"]:
            self.spark.sql(
                f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION "
                f"({PARTITION_COLUMN}=DATE'{day}', {BATCH_COLUMN}={_text(batch_id)})"
            )
        self.spark.catalog.refreshTable(name)

    def days(self, table: str) -> list[dt.date]:
        """Days a bronze table holds, newest first, from the catalog alone."""
        found = self.spark.sql(f"SHOW PARTITIONS {self.name(BRONZE_LAYER, table)}")
        texts = {row.partition.split("/")[0].split("=", 1)[1] for row in found.collect()}
        return sorted(map(dt.date.fromisoformat, texts), reverse=True)

    # -- models --------------------------------------------------------------

    def at_once(self, work: Callable, items: list) -> list:
        """`work` of each item in a thread of its own: Spark gets all their jobs at once."""
        if len(items) < 2:
            return [work(item) for item in items]
        task = inheritable_thread_target(self.spark)(work)
        with ThreadPoolExecutor(max_workers=len(items)) as pool:
            return list(pool.map(task, items))

    def publish(
        self, layer: str, table: str, rows: DataFrame, cluster_by: list[str] | None = None
    ) -> DataFrame:
        """Replace a model's rows and return the published table."""
        self.commit([self.write(layer, table, rows, cluster_by)])
        return self.table(layer, table)

    def write(
        self,
        layer: str,
        table: str,
        rows: DataFrame,
        cluster_by: list[str] | None = None,
        last: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    ) -> Version:
        """Write a new version of a model, which no reader sees before it is committed.

        `cluster_by` puts the rows into ranges of these columns, in files of a size
        that Spark chooses from the data, each sorted: a filter on the first column
        then skips most files by their statistics, and what is read in order needs no
        wide sort. A value with very many rows is divided by the further columns. `last`
        is applied to the rows as they are written, to observe them say.
        """
        self.create_layers()
        version = self.new_name(layer, table, "v")
        if cluster_by:
            rows = rows.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        last(rows).write.format("parquet").mode("errorifexists").saveAsTable(version)
        return Version(layer, table, version, tuple(rows.columns))

    def read(self, version: Version) -> DataFrame:
        return self.spark.table(version.name).select(*version.columns)

    @contextmanager
    def scratch(self) -> Iterator[Callable[[DataFrame], DataFrame]]:
        """A function that stores rows so that they are made once; they go at the end."""
        self.create_layers()
        names = []

        def keep(rows: DataFrame) -> DataFrame:
            name = self.new_name(SILVER_LAYER, "scratch", "s")
            rows.write.format("parquet").saveAsTable(name)
            names.append(name)
            return self.spark.table(name)

        try:
            yield keep
        finally:
            for name in names:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def new_name(self, layer: str, table: str, kind: str) -> str:
        """A name for a version that sorts behind all earlier ones."""
        stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
        return f"{self.name(layer, table)}__{kind}{stamp}_{uuid.uuid4().hex[:8]}"

    def commit(self, versions: list[Version]) -> int:
        """Make the written versions the current ones, as a new generation.

        One statement replaces the list of versions; from then on `snapshot` returns
        the new ones, all of them. Commits of one Warehouse wait for each other; jobs
        that write the same models from several drivers have to be kept apart.
        """
        if not versions:
            return self.snapshot().generation
        with self._committing:
            before = self.snapshot()
            now = before.versions | {(v.layer, v.table): v for v in versions}
            generation = before.generation + 1
            self._name_generation(generation, list(now.values()))
            for v in versions:
                columns = ", ".join(f"`{c}`" for c in v.columns)
                self.spark.sql(
                    f"CREATE OR REPLACE VIEW {self.name(v.layer, v.table)} "
                    f"AS SELECT {columns} FROM {v.name}"
                )
            for v in versions:
                self._drop_old_versions(v.layer, v.table)
        return generation

    def snapshot(self) -> Snapshot:
        """All models as of the newest generation; 0 before the first commit."""
        name = self.name(GOLD_LAYER, GENERATION)
        if not self.spark.catalog.tableExists(name):
            return Snapshot(self.spark, 0, [])
        rows = self.spark.table(name).collect()
        return Snapshot(
            self.spark,
            rows[0].generation,
            [Version(r.layer, r.model, r.version, tuple(r.columns)) for r in rows],
        )

    def current(self, layer: str, table: str) -> Version | None:
        return self.snapshot().versions.get((layer, table))

    def _name_generation(self, generation: int, versions: list[Version]) -> None:
        rows = ", ".join(
            f"({generation}L, {_text(v.layer)}, {_text(v.table)}, {_text(v.name)}, "
            f"array({', '.join(map(_text, v.columns))}))"
            for v in versions
        )
        self.create_layers()
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(GOLD_LAYER, GENERATION)} AS "
            f"SELECT * FROM VALUES {rows} AS t(generation, layer, model, version, columns)"
        )

    def versions(self, layer: str, table: str, kind: str = "v") -> list[str]:
        """Names of a model's kept versions, oldest first."""
        schema = self.schemas[layer]
        found = self.spark.sql(f"SHOW TABLES IN {schema} LIKE '{table}__{kind}*'")
        return sorted(f"{schema}.{row.tableName}" for row in found.collect())

    def _drop_old_versions(self, layer: str, table: str) -> None:
        """Keep the newest versions, and whatever the newest generation names."""
        named = {v.name for v in self.snapshot().versions.values()}
        for version in self.versions(layer, table)[: -self.keep_versions]:
            if version not in named:
                self.spark.sql(f"DROP TABLE IF EXISTS {version}")
