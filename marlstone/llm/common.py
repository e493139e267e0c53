"""What the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from marlstone.session import shared_dir


BATCH_BYTES = 4 << 20
"""Rows that a task and its Python worker hand over at once, unless the session says."""

_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Texts go to Python workers in batches of few bytes, however long they are.

    A batch is there several times at once, in the JVM, as Arrow and as pandas, for
    each task and worker; ten thousand texts would be tens of MB each time.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again.

    Cuts the lineage at files that outlive any executor.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    if (here := _stored_here.get()) is not None:
        here.append(path)
    return spark.read.schema(df.schema).parquet(path)


_stored_here: ContextVar[list[str] | None] = ContextVar("stored_here", default=None)
"""Folders that the innermost `settled` is to remove."""


def settled(make: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """What `make` returns, stored; what it has stored on the way is removed then.

    Nothing that is read later may depend on those folders but the result itself.
    """
    own: list[str] = []
    token = _stored_here.set(own)
    try:
        result = stored(make(), purpose)
    finally:
        _stored_here.reset(token)
    kept = own.pop()
    if (outer := _stored_here.get()) is not None:
        outer.append(kept)
    spark = result.sparkSession
    for folder in own:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return result


@contextmanager
def staying() -> Iterator[None]:
    """What is stored within stays, for frames that are handed on to be read later."""
    token = _stored_here.set(None)
    try:
        yield
    finally:
        _stored_here.reset(token)


def in_remainder(column: str, modulus: int, remainder: int):
    """crc32 of the value's text, modulo `modulus`, is `remainder`; NULL counts as ''."""
    key = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % modulus == remainder


# -- columns --------------------------------------------------------------------


def free_names(df: DataFrame, *names: str) -> list[str]:
    """`names`, with underscores added until `df` has no such column."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def id_type(df: DataFrame, column: str = "doc_id") -> str:
    """Integers are carried as long, ids of any other type as their text."""
    return "long" if isinstance(df.schema[column].dataType, IntegralType) else "string"


def carried_id(df: DataFrame, column: str = "doc_id") -> list[Column]:
    """doc_id without NULLs, which pandas would turn integers to floats for, and no_id."""
    kind = id_type(df, column)
    return [
        F.coalesce(F.col(column).cast(kind), F.lit(0).cast(kind)).alias("doc_id"),
        F.col(column).isNull().alias("no_id"),
    ]


# -- Bloom filters -------------------------------------------------------------

MAX_BITS = 1 << 27
"""No filter has more bits (16 MB), however many keys it holds."""


def bits_for(keys: int, rate: float) -> int:
    """A power of two, large enough for `keys` at a false positive rate, at most MAX_BITS."""
    wanted = max(64.0, -keys * np.log(max(rate, 1e-9)) / np.log(2) ** 2)
    return min(MAX_BITS, 1 << int(np.ceil(np.log2(wanted))))


def hashes_for(keys: int, bits: int, most: int) -> int:
    """As many as let the fewest other keys through, at most `most`."""
    return int(min(most, max(1, round(bits / max(keys, 1) * np.log(2)))))


def positions(low: np.ndarray, high: np.ndarray, bits: int, hashes: int) -> np.ndarray:
    """Bit positions by double hashing; low, high: uint64. A row for each hash."""
    k = np.arange(hashes, dtype=np.uint64)[:, None]
    with np.errstate(over="ignore"):
        return (low + k * (high | np.uint64(1))) & np.uint64(bits - 1)


def mixed_pair(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers for double hashing from one 64-bit hash."""
    with np.errstate(over="ignore"):
        high = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return hashes, high ^ (high >> np.uint64(32))


def passes(words: np.ndarray, low: np.ndarray, high: np.ndarray, hashes: int) -> np.ndarray:
    """Which keys pass; each further hash looks only at those that passed so far."""
    last = np.uint64(words.size * 64 - 1)
    found = np.zeros(low.size, dtype=bool)
    left = np.arange(low.size)
    step = high | np.uint64(1)
    for k in range(hashes):
        if not left.size:
            break
        with np.errstate(over="ignore"):
            at = (low + np.uint64(k) * step) & last
        set_ = (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        left, low, step = left[set_], low[set_], step[set_]
    found[left] = True
    return found


def bloom_words(
    hashed: DataFrame, bits: int, hashes: int, single: str | None = None
) -> np.ndarray:
    """The filter of a frame with 64-bit columns `low` and `high`.

    With `single`, both are made of that column by `mixed_pair`, in the same Python
    worker: two Python steps in a row take two workers for each task, and Spark keeps
    all that a stage has ever needed. Tasks send set words only and Spark combines
    them; the driver gets at most `bits` / 64 rows whatever the number of keys.
    """
    columns = ["low", "high"] if single is None else [single]

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = np.zeros(bits // 64, dtype=np.uint64)
        for frame in frames:
            keys = [frame[c].to_numpy().astype("int64").view("uint64") for c in columns]
            low, high = keys if single is None else mixed_pair(*keys)
            at = positions(low, high, bits, hashes).ravel()
            np.bitwise_or.at(
                words, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
            )
        (used,) = np.nonzero(words)
        yield pd.DataFrame({"word": used, "bits": words[used].view("int64")})

    rows = (
        hashed.select(*columns)
        .mapInPandas(partial, "word long, bits long")
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toPandas()
    )
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[rows["word"].to_numpy(dtype="int64")] = (
        rows["bits"].to_numpy(dtype="int64").view("uint64")
    )
    return words


def environment_for_workers() -> None:
    """Tokenizers stay on the one core a task has."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
