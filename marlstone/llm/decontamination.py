"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words at fixed places after a position; the places a mask
leaves out may differ, so that a replaced word does not hide a copied passage.
Seeds of benchmark items and of documents are joined, hits vote for a pair of
document part and item shifted against each other, and around each such pair the
words are compared, replaced words allowed.

Documents meet the join only where a Bloom filter of the benchmark's seeds lets
them pass. The filter has a bounded size; a larger benchmark lets more pass, and
the join sorts them out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import (
    bits_for,
    bloom_words,
    carried_id,
    free_names,
    id_type,
    mixed_pair,
    passes,
    stored,
    table,
)
from marlstone.llm.shingles import WordHashes, runs

#: Places of a mask's words. Of any words that `is_leak` accepts in an item of at
#: least MASKS_FROM words, however many were replaced, the first two have a seed left.
MASKS = [
    (0, 1, 3, 4, 5),
    (0, 1, 5, 7, 8),
    (0, 1, 2, 3),
    (0, 1, 3, 4),
]
MASKS_FROM = 7
SHORT_MASKS = {5: (2,), 6: (3,)}
"""Of items with fewer words than MASKS_FROM, by the number of words."""

SPAN = 13
"""More words than a mask spans; hits nearer than twice this are in one part."""

LEAST_ITEM_WORDS = 5
"""Shorter items show no leak."""

LEAST_MATCHED = 12
"""Equal words that make a leak, or LEAST_SHARE of a shorter item."""

LEAST_SHARE = 0.75
"""Equal words in the overlap."""

MISMATCH = -2
"""Against +1 for an equal word: where an overlap ends."""

CONTEXT = 96
"""Words kept on either side of a hit for comparing."""

WORDS_AT_ONCE = 100_000
FILTER_RATE = 1e-6
FILTER_HASHES = 20


def masks_of(n_words: int) -> tuple[int, ...]:
    """Which of MASKS an item of so many words is searched by."""
    return (0, 1) if n_words >= MASKS_FROM else SHORT_MASKS.get(n_words, ())


def seeds(words: np.ndarray, masks: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray]]:
    """(mask, hashes by position) for each of the numbers of MASKS in `masks`."""
    for n in masks:
        yield n, runs(words, MASKS[n])


def _items(benchmark: DataFrame) -> DataFrame:
    """item (a hash of its words), item_id, words; each different pair once."""

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for frame in frames:
            words = [hashes.of(t).tobytes() for t in frame.pop("text")]
            frame["item"] = [xxhash.xxh3_64(w).intdigest() - (1 << 63) for w in words]
            frame["words"] = words
            yield frame

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    made = rows.mapInPandas(split, "item_id string, item long, words binary")
    return made.where(F.length("words") >= 8 * LEAST_ITEM_WORDS).distinct()


def _item_seeds(items: DataFrame) -> DataFrame:
    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for item, raw in zip(frame["item"], frame["words"]):
                words = np.frombuffer(raw, dtype=np.uint64)
                for mask, found in seeds(words, masks_of(words.size)):
                    for at, h in enumerate(found.view("int64")):
                        rows.append((item, mask, h, at))
            yield pd.DataFrame(rows, columns=["item", "mask", "hash", "item_at"])

    return (
        items.select("item", "words")
        .distinct()
        .mapInPandas(make, "item long, mask int, hash long, item_at int")
    )


PART_SCHEMA = (
    "no_id boolean, h1 long, h2 long, part binary, first int,"
    " words binary, hits array<struct<mask:int, hash:bigint, at:int>>"
)


def _parts(documents: DataFrame, seed_rows: DataFrame) -> DataFrame:
    """Parts of documents around seeds that pass the benchmark's filter."""
    used = tuple(
        sorted(r["mask"] for r in seed_rows.select("mask").distinct().collect())
    )
    bits = bits_for(seed_rows.count(), FILTER_RATE)
    filled = bloom_words(seed_rows, bits, FILTER_HASHES, single="hash")

    def hits_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
        """(place, mask, hash) of the passing seeds of each text, all at once."""
        words = np.concatenate(texts)
        ends = np.cumsum([t.size for t in texts])
        hits: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for mask, found in seeds(words, used):
            width = words.size - found.size
            (at,) = np.nonzero(passes(filled, *mixed_pair(found), FILTER_HASHES))
            text = np.searchsorted(ends, at, side="right")
            inside = at + width < ends[text]
            at, text = at[inside], text[inside]
            places = at - (ends - [t.size for t in texts])[text]
            own = found[at].view("int64")
            for t, place, h in zip(text.tolist(), places.tolist(), own.tolist()):
                hits[t].append((place, mask, h))
        return hits

    def cut(words: np.ndarray, hits: list) -> Iterator[tuple[int, np.ndarray, list]]:
        hits.sort()
        start = 0
        for i in range(1, len(hits) + 1):
            if i == len(hits) or hits[i][0] - hits[i - 1][0] > 2 * SPAN:
                first = max(0, hits[start][0] - CONTEXT)
                last = hits[i - 1][0] + SPAN + CONTEXT
                own = [
                    {"mask": m, "hash": h, "at": at - first} for at, m, h in hits[start:i]
                ]
                yield first, words[first:last], own
                start = i

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        columns = ["doc_id", "no_id", "h1", "h2"]
        for frame in frames:
            rows, keys, texts, size = [], [], [], 0
            every = list(zip(*(frame[c] for c in columns)))
            for n, text in enumerate(frame["text"]):
                words = hashes.of(text)
                if words.size:
                    keys.append(every[n])
                    texts.append(words)
                    size += words.size
                if texts and (size >= WORDS_AT_ONCE or n + 1 == len(frame)):
                    for key, own, hits in zip(keys, texts, hits_of(texts)):
                        for first, part_words, part_hits in cut(own, hits):
                            raw = part_words.tobytes()
                            named = repr((key, first)).encode() + raw
                            part = xxhash.xxh3_128_digest(named)
                            rows.append((*key, part, first, raw, part_hits))
                    keys, texts, size = [], [], 0
            yield pd.DataFrame(rows, columns=[*columns, "part", "first", "words", "hits"])

    return documents.select(
        *carried_id(documents),
        F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit(1), "text").alias("h2"),
        "text",
    ).mapInPandas(run, f"doc_id {id_type(documents)}, {PART_SCHEMA}")


def overlap(left: np.ndarray, right: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Best stretch of right[i] against left[i + shift]: start and end in left, equal words."""
    a, b = max(0, -shift), min(right.size, left.size - shift)
    if b <= a:
        return 0, 0, 0
    equal = right[a:b] == left[a + shift : b + shift]
    total = np.r_[0, np.cumsum(np.where(equal, 1, MISMATCH))]
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.argmin(total[: end + 1]))
    return start + a + shift, end + a + shift, int(equal[start:end].sum())


def is_leak(matched: int, length: int, item_words: int) -> bool:
    needed = min(LEAST_MATCHED, int(np.ceil(LEAST_SHARE * item_words)))
    return matched >= max(needed, 1) and matched >= LEAST_SHARE * length


def _verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        kept, rows = [], []
        for i, (raw, item_raw, shift) in enumerate(
            zip(frame["words"], frame["item_words"], frame["shift"])
        ):
            item = np.frombuffer(item_raw, dtype=np.uint64)
            words = np.frombuffer(raw, dtype=np.uint64)
            start, end, matched = overlap(words, item, int(shift))
            if is_leak(matched, end - start, item.size):
                kept.append(i)
                rows.append((start, end, matched))
        found = frame.iloc[kept][["doc_id", "no_id", "h1", "h2", "item", "first"]]
        found = found.reset_index(drop=True)
        made = pd.DataFrame(rows, columns=["start", "end", "matched"], dtype="int64")
        found["start"] = made["start"] + found["first"]
        found["end"] = made["end"] + found["first"]
        found["matched"] = made["matched"]
        yield found.drop(columns="first")


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Overlaps of `documents` (doc_id, text) with `benchmark` (item_id, text).

    One row per document and item: doc_id, h1, h2 (hashes of the text), item_id
    (as text), start_word, end_word, matched (equal words) of the overlap with
    most equal words, the first of several. Rows without words have no overlap,
    repeated rows give one, NULL ids are kept, ids that are no integers are text.
    Other columns are ignored.
    """
    items = stored(_items(benchmark), "leak_items")
    seed_rows = stored(_item_seeds(items), "leak_seeds")
    parts = stored(_parts(documents, seed_rows), "leak_parts")
    hits = parts.select("part", F.explode("hits").alias("hit")).select("part", "hit.*")
    pairs = (
        hits.join(seed_rows, ["mask", "hash"])
        .select("part", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    found = (
        pairs.join(parts.drop("hits").dropDuplicates(["part"]), "part")
        .join(
            items.select("item", F.col("words").alias("item_words")).distinct(), "item"
        )
        .select(
            "doc_id", "no_id", "h1", "h2", "item", "first", "shift", "words", "item_words"
        )
        .mapInPandas(
            _verify,
            f"doc_id {id_type(documents)}, no_id boolean, h1 long, h2 long, item long,"
            " start long, end long, matched long",
        )
    )
    best = found.groupBy("doc_id", "no_id", "h1", "h2", "item").agg(
        F.max(F.struct("matched", -F.col("start"), -F.col("end"))).alias("best")
    )
    return best.join(items.select("item", "item_id"), "item").select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"),
        "h1",
        "h2",
        "item_id",
        (-F.col("best.col2")).alias("start_word"),
        (-F.col("best.col3")).alias("end_word"),
        F.col("best.matched").alias("matched"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = table(spark, sf_dir, "benchmark")
    found = leaks(table(spark, sf_dir, "documents"), benchmark)
    kind = id_type(benchmark, "item_id")
    return found.drop("h1", "h2").withColumn("item_id", F.col("item_id").cast(kind))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: documents without a leaked benchmark item stay, unchanged.

    NULL and empty texts stay, as do repeated rows, NULL ids and columns of any name.
    """
    own_id, f1, f2 = free_names(docs, "id", "f1", "f2")
    found = leaks(docs, table(spark, sf_dir, "benchmark"))
    found = stored(found.select("doc_id", "h1", "h2").distinct(), "leaking").select(
        F.col("doc_id").alias(own_id), F.col("h1").alias(f1), F.col("h2").alias(f2)
    )
    matches = (
        F.col("doc_id").cast(id_type(docs)).eqNullSafe(F.col(own_id))
        & (F.xxhash64("text") == F.col(f1))
        & (F.xxhash64(F.lit(1), "text") == F.col(f2))
    )
    return docs.join(found, matches, "left_anti")
