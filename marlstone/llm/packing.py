"""Packing of documents into sequences by the sum-of-squares rule.

A document's ids are cut into pieces of at most the sequence length. Pieces are
dealt to shards by hash, and each shard places its pieces one by one: into the
open sequence, or a new one, that leaves the sum of squared counts of open
sequences per gap smallest. This keeps gaps of all sizes at hand, so that whatever
comes finds one that it fills. Long pieces go first, from the longest down, short
ones follow in hash order.

A shard has a bounded number of pieces and the number of shards grows with the
input, so no task sees more than its share; each shard leaves a few sequences
partly empty, a constant small share of all.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import table
from marlstone.llm.word_cache import WORD_END_PATTERN, Encoder

CAPACITY = 4096
END_ID = 1
SHARD_DOCUMENTS = 16_384
"""Documents for each shard, on average."""

LONG_SHARE = 4
"""Pieces above 1 / LONG_SHARE of a sequence go first."""

PIECE_SCHEMA = (
    "doc_id long, no_id boolean, piece int, start long, length long, ids_crc32 long"
)


class Gaps:
    """Open sequences by gap. `place` is the sum-of-squares rule."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.sequences = 0

    def place(self, size: int) -> tuple[int, int]:
        """Sequence number and offset. Of equal costs the smallest gap wins."""
        n, top = self.counts, self.capacity
        # A gap g becomes g - size; filled sequences (gap 0) no longer count.
        change = 2 * (n[: top - size + 1] - n[size:]) + 2
        change[0] = 1 - 2 * n[size]
        change[n[size:] == 0] = np.iinfo(np.int64).max
        new = 2 * n[top - size] + 1 if size < top else 0
        best = int(change.argmin())
        if change[best] <= new:
            gap = best + size
            sequence = self.open[gap].pop()
            n[gap] -= 1
        else:
            gap, sequence = top, self.sequences
            self.sequences += 1
        if gap > size:
            self.open[gap - size].append(sequence)
            n[gap - size] += 1
        return sequence, top - gap


def placed(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece. The order given decides ties."""
    sequence = np.zeros(sizes.size, dtype=np.int64)
    offset = np.zeros(sizes.size, dtype=np.int64)
    gaps = Gaps(capacity)
    (long,) = np.nonzero(sizes * LONG_SHARE > capacity)
    (short,) = np.nonzero(sizes * LONG_SHARE <= capacity)
    long = long[np.argsort(-sizes[long], kind="stable")]
    for i in np.concatenate([long, short]):
        sequence[i], offset[i] = gaps.place(int(sizes[i]))
    return sequence, offset


def pieces_of(
    documents: DataFrame,
    encoder: Callable[[], Encoder],
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    shards: int = 1,
) -> DataFrame:
    """The pieces of each document, with a shard dealt by hash.

    Equal rows of a task differ in their count, so that they go to different shards.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, seen = encoder(), Counter()
        for frame in frames:
            rows = []
            texts = encode.ids(frame["text"])
            for doc_id, no_id, ids in zip(frame["doc_id"], frame["no_id"], texts):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    crc = zlib.crc32(part)
                    row = (doc_id, no_id, k, at // 4, len(part) // 4, crc)
                    seen[row] += 1
                    shard = zlib.crc32(repr((row, seen[row])).encode()) % shards
                    rows.append((*row, shard))
            yield pd.DataFrame(rows, columns=columns)

    columns = ["doc_id", "no_id", "piece", "start", "length", "ids_crc32", "shard"]
    # pandas would turn ids into floats where some are NULL.
    return documents.select(
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"),
        F.col("doc_id").isNull().alias("no_id"),
        "text",
    ).mapInPandas(cut, f"{PIECE_SCHEMA}, shard int")


def pack(
    documents: DataFrame,
    encoder: Callable[[], Encoder],
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    shard_documents: int = SHARD_DOCUMENTS,
) -> DataFrame:
    """One row per piece of `documents` (doc_id, text) with its place.

    NULL and empty texts give one piece, the end id alone. Repeated rows are
    packed each; an empty table gives an empty result; other columns are ignored.
    """
    shards = max(1, -(-documents.count() // shard_documents))
    pieces = pieces_of(
        documents, encoder, capacity=capacity, end_id=end_id, shards=shards
    )

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        # The same places whatever the order in which rows arrive.
        order = ["ids_crc32", "doc_id", "no_id", "piece", "start", "length"]
        frame = frame.sort_values(order, ignore_index=True)
        sequence, offset = placed(frame["length"].to_numpy(), capacity)
        frame["sequence_id"] = sequence + frame["shard"].astype("int64") * (1 << 32)
        frame["offset"] = offset
        return frame.drop(columns="shard")

    packed = pieces.groupBy("shard").applyInPandas(
        place, f"{PIECE_SCHEMA}, sequence_id long, offset long"
    )
    return packed.withColumn(
        "doc_id", F.when(~F.col("no_id"), F.col("doc_id"))
    ).drop("no_id")


def word_end_encoder() -> Encoder:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return Encoder(path, WORD_END_PATTERN, lowers=True)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), word_end_encoder)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: the pieces of all documents and their places."""
    return pack(docs, word_end_encoder)
