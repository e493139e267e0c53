"""Token counts of whole texts; huge ones by overlapping chunks.

A huge text is cut into chunks that overlap their neighbours. Each chunk is encoded
with offsets, by whichever task gets it. In an overlap both neighbours have token
boundaries; one that both have, at a place where the vocabulary's pattern must cut
whatever surrounds it, is where the chunks are spliced: tokens of the left chunk
behind it and of the right chunk before it do not count. A seam without such a
place is tried again with a wider overlap, in the end with the text as one chunk.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import stored, table
from marlstone.llm.word_cache import BYTE_LEVEL_PATTERN, Encoder

HUGE_CHARS = 32_768
"""Longer texts are cut into chunks of this many characters."""

OVERLAP_CHARS = 256
"""On either side of a seam, at first."""

CHUNKS_A_TASK = 64
"""Of HUGE_CHARS or fewer characters; small ones are as good as free."""

WIDEN = 8
LIMIT = 512

#: Ends of words before white space: byte-level patterns never match across them,
#: nor does what they match depend on the other side.
STABLE = re.compile(r"(?<=[^\s\x1c-\x1f\x85\xa0])(?=[ \t\n\r])")

CHUNK_SCHEMA = "uid long, chunk long, last boolean, first long, text string"
MARK_SCHEMA = "uid long, seam long, place long, side int, dropped long, tokens long"


def chunks(texts: DataFrame, chunk_chars: int, overlap: int) -> DataFrame:
    """Overlapping chunks of `texts` (uid, text). `first` is where a chunk starts."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = max(chunk_chars, overlap)
        for frame in frames:
            for uid, text in zip(frame["uid"], frame["text"]):
                seams = range(0, max(len(text), 1), size)
                rows = []
                for k, seam in enumerate(seams):
                    first = max(0, seam - overlap)
                    last = seam + size >= len(text)
                    rows.append(
                        (uid, k, last, first, text[first : seam + size + overlap])
                    )
                    if last or len(rows) == 32:
                        yield pd.DataFrame(
                            rows, columns=["uid", "chunk", "last", "first", "text"]
                        )
                        rows = []

    made = texts.select("uid", "text").mapInPandas(cut, CHUNK_SCHEMA)
    # By the work, not by the bytes, which would be too few for many tasks.
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    tasks = -(-chars // (CHUNKS_A_TASK * HUGE_CHARS)) or 1
    return made.repartition(tasks, "uid", "chunk")


def marks(cut: DataFrame, encoder: Callable[[], Encoder], overlap: int) -> DataFrame:
    """Where each chunk could be spliced, and how many tokens that drops.

    A row with seam -1 has the chunk's number of tokens.
    """

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        library = encoder().library
        for frame in frames:
            rows = []
            for uid, k, last, first, text in frame.itertuples(index=False):
                made = library.encode(text, add_special_tokens=False)
                starts = np.array([a for a, _ in made.offsets], dtype=np.int64)
                cuts = np.unique([*starts, len(text)]) + first
                rows.append((uid, -1, -1, -1, 0, starts.size))
                seam = first + (overlap if k else 0)
                places = np.array([m.start() for m in STABLE.finditer(text)], dtype=np.int64)
                # A boundary of this encoding as well as a place where all must cut.
                places = np.intersect1d(places + first, cuts)
                if k:
                    for p in places[places <= seam + overlap]:
                        before = int(np.searchsorted(starts, p - first))
                        rows.append((uid, k, int(p), 1, before, 0))
                if not last:
                    after = first + len(text) - overlap
                    for p in places[places >= after - overlap]:
                        behind = starts.size - int(np.searchsorted(starts, p - first))
                        rows.append((uid, k + 1, int(p), 0, behind, 0))
            yield pd.DataFrame(
                rows, columns=["uid", "seam", "place", "side", "dropped", "tokens"]
            )

    return cut.mapInPandas(encode, MARK_SCHEMA)


def _spliced(found: DataFrame) -> DataFrame:
    """(uid, tokens, open): tokens of all chunks less what the splices drop.

    `open` counts the seams that have no common place.
    """
    whole = (
        found.where("seam < 0")
        .groupBy("uid")
        .agg(F.sum("tokens").alias("tokens"), (F.count("*") - 1).alias("seams"))
    )
    common = (
        found.where("seam >= 0")
        .groupBy("uid", "seam", "place")
        .agg(F.count("*").alias("sides"), F.sum("dropped").alias("dropped"))
        .where("sides = 2")
    )
    chosen = (
        common.groupBy("uid", "seam")
        .agg(F.min(F.struct("dropped", "place")).alias("best"))
        .groupBy("uid")
        .agg(F.sum("best.dropped").alias("dropped"), F.count("*").alias("spliced"))
    )
    return whole.join(chosen, "uid", "left").select(
        "uid",
        (F.col("tokens") - F.coalesce("dropped", F.lit(0))).alias("tokens"),
        (F.col("seams") - F.coalesce("spliced", F.lit(0))).alias("open"),
    )


def count_huge(
    texts: DataFrame, encoder: Callable[[], Encoder], chunk_chars: int, overlap: int
) -> DataFrame:
    """(uid, n_tokens) of `texts` (uid, text), in chunks of `chunk_chars` or more."""
    left, done = texts, None
    while True:
        # Stored before both branches of `_spliced` read them, so chunks are encoded once.
        marked = stored(
            marks(chunks(left, chunk_chars, overlap), encoder, overlap), "token_marks"
        )
        found = stored(_spliced(marked), "token_splices")
        fits = found.where("open = 0").select("uid", F.col("tokens").alias("n_tokens"))
        done = fits if done is None else done.unionByName(fits)
        failed = found.where("open > 0").select("uid")
        if failed.isEmpty():
            return done
        left = stored(left.join(failed, "uid", "left_semi"), "token_again")
        overlap *= WIDEN


def count_tokens(
    documents: DataFrame,
    encoder: Callable[[], Encoder],
    *,
    limit: int = LIMIT,
    chunk_chars: int = HUGE_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit for each row of `documents`.

    NULL and empty texts have none. Repeated rows are counted each, NULL ids stay,
    an empty table gives an empty result, and other columns are ignored.
    """
    rows = documents.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("n_bytes", F.octet_length("text").cast("long"))
    is_huge = F.length("text") > chunk_chars

    @F.pandas_udf("long")
    def count(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder()
        for texts in series:
            yield pd.Series([len(ids) // 4 for ids in encode.ids(texts)], dtype="int64")

    usual = rows.where(~is_huge).select(
        "doc_id", "n_bytes", count("text").alias("n_tokens")
    )
    huge = stored(
        rows.where(is_huge).withColumn("uid", F.monotonically_increasing_id()),
        "token_huge",
    )
    counted = huge.select("uid", "doc_id", "n_bytes").join(
        count_huge(huge.select("uid", "text"), encoder, chunk_chars, overlap), "uid"
    )
    return usual.unionByName(counted.drop("uid")).withColumn(
        "over_limit", F.col("n_tokens") > limit
    )


def byte_level_encoder() -> Encoder:
    import public_tokenizers

    return Encoder(public_tokenizers.path("byte_bpe_50k.json"), BYTE_LEVEL_PATTERN)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), byte_level_encoder)
