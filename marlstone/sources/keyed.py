"""Models kept in hash buckets of their key, of which a refresh rewrites only some.

The rows of a bucket are files of a data table, `<model>__d<stamp>`, that some refresh
wrote. A version, `<model>__p<stamp>`, is a partitioned table without files of its
own: its partitions are the buckets, each at the folder that was written last for it. A
refresh writes the buckets of changed keys as a new data table and makes a new version
that points to them and, for all other buckets, to where they were. Versions are
committed and read like those of any other model.
"""

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.sources.tables import Version, Warehouse

BUCKETS = 32
BUCKET = "_bucket"

# Properties of a version.
_DATA, _MARK = "marlstone.data", "marlstone.mark"


class KeyedTable:
    """A model whose rows are replaced key by key.

    Rows within a bucket are sorted by key and `order_by`, and a large bucket is
    divided into files by its size, so that a key with very many rows is one task's
    work no more than others. `shown` are the columns that readers of the model see;
    others are kept for the refresh. The number of buckets is set by the first write.
    """

    def __init__(
        self,
        wh: Warehouse,
        layer: str,
        table: str,
        shown: list[str] | None = None,
        order_by: list[str] | None = None,
        key: str = "coin_id",
        buckets: int = BUCKETS,
    ):
        self.wh, self.layer, self.table = wh, layer, table
        self.shown, self.order_by, self.key = shown, order_by or [], key
        self._buckets = buckets

    # -- reading -------------------------------------------------------------

    def version(self) -> Version | None:
        """The committed version; None if the model was never written by key."""
        now = self.wh.current(self.layer, self.table)
        return now if now and f"{self.table}__p" in now.name else None

    def rows(self) -> DataFrame | None:
        """All columns, hidden ones and the bucket too."""
        now = self.version()
        return now and self.wh.spark.table(now.name)

    def rows_of(self, keys: list[str]) -> DataFrame:
        """What readers see of some keys; other buckets are not read."""
        now = self.version()
        wanted = self.wh.spark.createDataFrame([(k,) for k in keys], f"{self.key} string")
        found = wanted.select(self._bucket_of(self._number(now))).distinct().collect()
        return (
            self.wh.spark.table(now.name)
            .where(F.col(BUCKET).isin([r[0] for r in found]))
            .where(F.col(self.key).isin(keys))
            .select(*now.columns)
        )

    def mark(self) -> DataFrame | None:
        """What the refresh that wrote the version has read, as it told `replace`."""
        now = self.version()
        name = now and self._property(now, _MARK)
        return self.wh.spark.table(name) if name else None

    def write_mark(self, rows: DataFrame) -> str:
        """A mark's name, for `replace`."""
        name = self.wh.new_name(self.layer, self.table, "m")
        rows.write.format("parquet").saveAsTable(name)
        return name

    # -- writing -------------------------------------------------------------

    def replace(
        self, rows: DataFrame, keys: DataFrame | None = None, mark: str | None = None
    ) -> Version | None:
        """A new version in which the rows of `keys` (default: all that are there) are `rows`.

        None if no key is concerned. A key of `keys` without rows loses those it
        had. `keys` has one row a key and is read twice; `rows` is read once. Nothing
        is seen before the version is committed.
        """
        now = self.version()
        number = self._number(now)
        rows = rows.withColumn(BUCKET, self._bucket_of(number))
        if now is None or keys is None:
            return self._write(rows, {}, number, mark)
        keys = keys.select(self.key, self._bucket_of(number))
        touched = sorted(r[0] for r in keys.select(BUCKET).distinct().collect())
        if not touched:
            return None
        kept = (
            self.wh.spark.table(now.name)
            .where(F.col(BUCKET).isin(touched))
            .join(keys.select(F.col(self.key).alias("_gone")),
                  F.col(self.key).eqNullSafe(F.col("_gone")), "left_anti")
        )
        elsewhere = {b: d for b, d in self._data(now).items() if b not in touched}
        return self._write(
            kept.select(*rows.columns).unionByName(rows), elsewhere, number,
            mark if mark is not None else self._property(now, _MARK),
        )

    def marked(self, mark: str) -> Version | None:
        """The committed rows as a new version that carries another mark."""
        now = self.version()
        return now and self._point(now, self._data(now), self._number(now), mark)

    def _write(
        self, rows: DataFrame, elsewhere: dict[int, str], number: int, mark: str | None
    ) -> Version:
        wh = self.wh
        wh.create_layers()
        data = wh.new_name(self.layer, self.table, "d")
        (
            rows.hint("rebalance", F.col(BUCKET))
            .sortWithinPartitions(BUCKET, self.key, *self.order_by)
            .write.partitionBy(BUCKET).mode("errorifexists").saveAsTable(data)
        )
        found = wh.spark.sql(f"SHOW PARTITIONS {data}").collect()
        written = {int(r.partition.split("=", 1)[1]): data for r in found}
        shown = self.shown or [c for c in rows.columns if c != BUCKET and not c.startswith("_")]
        version = Version(self.layer, self.table, data, tuple(shown))
        return self._point(version, elsewhere | written, number, mark)

    def _point(
        self, like: Version, data: dict[int, str], number: int, mark: str | None
    ) -> Version:
        """A version over the given buckets, with the columns of `like`."""
        wh = self.wh
        name = wh.new_name(self.layer, self.table, "p")
        folder = wh.path(self.layer)
        schema = wh.spark.table(like.name).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        properties = {_DATA: json.dumps(data), _MARK: mark or "", "marlstone.buckets": str(number)}
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        wh.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({BUCKET}) "
            f"LOCATION '{folder}/{name.split('.')[-1]}' TBLPROPERTIES ({listed})"
        )
        places = " ".join(
            f"PARTITION ({BUCKET}={b}) LOCATION '{folder}/{d.split('.')[-1]}/{BUCKET}={b}'"
            for b, d in sorted(data.items())
        )
        if places:
            wh.spark.sql(f"ALTER TABLE {name} ADD {places}")
        wh.properties[name] = properties
        return Version(self.layer, self.table, name, like.columns)

    def clean(self) -> None:
        """Drop versions beyond the newest ones, and data and marks that no kept one names."""
        wh = self.wh
        kept = wh.versions(self.layer, self.table, "p")
        now = self.version()
        for name in kept[: -wh.keep_versions]:
            if now is None or name != now.name:
                wh.spark.sql(f"DROP TABLE IF EXISTS {name}")
                wh.properties.pop(name, None)
        used = set()
        for name in wh.versions(self.layer, self.table, "p"):
            version = Version(self.layer, self.table, name, ())
            used |= {self._property(version, _MARK), *self._data(version).values()}
        for kind in ("d", "m"):
            for name in wh.versions(self.layer, self.table, kind):
                if name not in used:
                    wh.spark.sql(f"DROP TABLE IF EXISTS {name}")

    # -- properties ----------------------------------------------------------

    def _bucket_of(self, number: int):
        return F.pmod(F.xxhash64(self.key), F.lit(number)).cast("int").alias(BUCKET)

    def _number(self, now: Version | None) -> int:
        return int(self._property(now, "marlstone.buckets")) if now else self._buckets

    def _data(self, version: Version) -> dict[int, str]:
        return {int(b): d for b, d in json.loads(self._property(version, _DATA)).items()}

    def _property(self, version: Version, key: str) -> str:
        """A version never changes, so its properties are asked for once."""
        known = self.wh.properties
        if version.name not in known:
            found = self.wh.spark.sql(f"SHOW TBLPROPERTIES {version.name}").collect()
            known[version.name] = {r.key: r.value for r in found}
        return known[version.name][key]
