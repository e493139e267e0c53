"""Session settings the jobs are written for, and the shared scratch folder."""

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Strict casts and subscripts: malformed values fail instead of turning NULL.
    "spark.sql.ansi.enabled": "true",
    # AQE picks broadcast or sort-merge from measured sizes, splits skewed join
    # partitions and coalesces small ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Streaming state (one row per coin) lives in RocksDB, outside the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app: str = "marlstone", master: str | None = None, **extra: str
) -> SparkSession:
    """Session with the settings above; `extra` takes dotted keys via a dict splat."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the one the cluster names in spark.checkpoint.dir.

    Only where that setting is absent and the master is local a temporary folder
    of this machine stands in; executors on other machines would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(
                f"spark.checkpoint.dir must name a shared folder on master {master!r}"
            )
        base = tempfile.mkdtemp(prefix="marlstone-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
