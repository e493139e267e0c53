"""Removal of repeated byte strings, by suffix arrays of shards.

A string of LENGTH bytes that starts at two places is repeated; every byte that a
repeated string covers goes. The suffix array of a shard, with the prefixes that
neighbours share, shows all its repeated strings; `induced_sorting` makes it.

Which suffixes must meet in a shard is settled first. Each window of LENGTH bytes
has an anchor, the run of ANCHOR bytes in it with the least hash. Equal windows have
equal anchors, and neighbouring windows mostly the same one, so a text falls into
fragments of windows with one anchor. Fragments are counted by their hash: a window
of a fragment that occurs twice is repeated, and a window of a fragment whose anchor
occurs nowhere else is not. Only fragments that share their anchor with a different
fragment, those at the ends of repeated passages, have to be sorted, dealt to shards
by anchor, each different fragment once.

An anchor at the end of a passage that many texts share has as many different
fragments. Such a group is divided before: a window has at least half of its other
bytes before its anchor or behind it, so its windows are of two kinds, and those of a
kind are equal only if the anchor extended on that side is. This is repeated with
what still has to be sorted until each group is bounded.
"""

from __future__ import annotations

import hashlib
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
    hashes_for,
    id_type,
    mixed_pair,
    passes,
    settled,
    staying,
    stored,
    table,
)
from marlstone.llm.induced_sorting import Scratch, suffixes
from marlstone.llm.shingles import WORDS, mixed

LENGTH = 400
ANCHOR = 256
"""Longer anchors: fewer fragments to sort, more to count."""

PASSAGE_WORDS = 50
"""The pipeline removes repeated passages of more words than this, or of LENGTH bytes."""
PASSAGE_LENGTH = 100
"""PASSAGE_WORDS + 1 words have 2 * PASSAGE_WORDS + 1 bytes at least."""
PASSAGE_ANCHOR = 32

SHARD_BYTES = 1_000_000
"""Fragments in a shard, on average."""

GROUP_BYTES = 500_000
"""Fragments of one anchor are divided if they have more."""

FILTER_RATE = 0.01
FILTER_HASHES = 7
BLOCK_WINDOWS = 1 << 22

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        powers = np.full(n, base, dtype=np.uint64)
        powers[:1] = 1
        return np.multiply.accumulate(powers)


class Fragments:
    """Cuts texts into fragments; keeps tables as long as the longest block so far."""

    def __init__(self, length: int = LENGTH, anchor: int = ANCHOR) -> None:
        self.length, self.anchor = length, anchor
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def _hashes(self, raw: np.ndarray) -> np.ndarray:
        """Of the anchor bytes at each place."""
        if self.up.size <= raw.size:
            self.up = _powers(_FACTOR, raw.size + 1)
            self.down = _powers(_INVERSE, raw.size + 1)
        n = raw.size - self.anchor + 1
        with np.errstate(over="ignore"):
            total = np.zeros(raw.size + 1, dtype=np.uint64)
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: raw.size], out=total[1:])
            return mixed((total[self.anchor :] - total[: -self.anchor]) * self.down[:n])

    def of(self, raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """First window, number of windows and anchor hash of each fragment, by block."""
        windows = raw.size - self.length + 1
        for begin in range(0, max(windows, 0), BLOCK_WINDOWS):
            n = min(BLOCK_WINDOWS, windows - begin)
            hashes = self._hashes(raw[begin : begin + n + self.length - 1])
            # The place breaks ties, to the left.
            marked = hashes & ~np.uint64(0xFFFFFF) | np.arange(hashes.size, dtype=np.uint64)
            width = self.length - self.anchor + 1
            rows = -(-hashes.size // width)
            padded = np.full(rows * width, np.iinfo(np.uint64).max)
            padded[: hashes.size] = marked
            grid = padded.reshape(rows, width)
            ahead = np.minimum.accumulate(grid, axis=1).ravel()
            behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
            least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
            first = np.flatnonzero(least[1:] != least[:-1]) + 1
            first = np.concatenate(([0], first))
            count = np.diff(first, append=n)
            anchor = hashes[(least[first] & np.uint64(0xFFFFFF)).astype(np.int64)]
            yield first + begin, count, anchor

    def place(self, raw: np.ndarray) -> int:
        """Where the anchor of a fragment's content is."""
        hashes = self._hashes(raw)[: self.length - self.anchor + 1]
        return int(np.argmin(hashes & ~np.uint64(0xFFFFFF)))


FRAGMENT_COLUMNS = ["anchor", "name"]
"""Hashes of the anchor and of the whole fragment, together 128 bits."""


class Anchors:
    """A Bloom filter of the anchors that occur twice or more in all texts.

    Equal windows have equal anchors at the same place, so a fragment whose anchor
    occurs once holds no repeated window. What passes by chance is counted as well.
    """

    def __init__(self, documents: DataFrame, length: int, anchor: int) -> None:
        def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            cutter = Fragments(length, anchor)
            for frame in frames:
                parts = [
                    own
                    for raw in frame["raw"]
                    for _, _, own in cutter.of(np.frombuffer(raw, dtype=np.uint8))
                ]
                if parts:
                    own, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pd.DataFrame({"anchor": own.view(np.int64), "n": n})

        counted = (
            _bytes_and_hashes(documents, length)
            .select("raw")
            .mapInPandas(count, "anchor long, n long")
            .groupBy("anchor")
            .agg(F.sum("n").alias("n"))
            .where("n > 1")
        )
        several = stored(counted.select("anchor"), "suffix_anchors")
        keys = several.count()
        bits = bits_for(keys, FILTER_RATE)
        self.hashes = hashes_for(keys, bits, FILTER_HASHES)
        self.words = bloom_words(several, bits, self.hashes, single="anchor")


def _named(
    raw: bytes, cutter: Fragments, words: np.ndarray, hashes: int
) -> tuple[np.ndarray, ...]:
    """first, count, anchor, name of a text's fragments whose anchors pass."""
    parts = list(cutter.of(np.frombuffer(raw, dtype=np.uint8)))
    if not parts:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty, empty
    first, count, anchor = (np.concatenate(x) for x in zip(*parts))
    kept = passes(words, *mixed_pair(anchor), hashes)
    first, count, anchor = first[kept], count[kept], anchor[kept]
    digest, ends = xxhash.xxh3_64_intdigest, first + count + cutter.length - 1
    name = [digest(raw[a:b]) for a, b in zip(first.tolist(), ends.tolist())]
    return first, count, anchor.view(np.int64), np.array(name, np.uint64).view(np.int64)


def _bytes_and_hashes(documents: DataFrame, length: int) -> DataFrame:
    return documents.select(
        F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit(1), "text").alias("h2"),
        F.coalesce("text", F.lit("")).cast("binary").alias("raw"),
    ).where(F.length("raw") >= length)


def _fragments(
    documents: DataFrame, length: int, anchor: int, several: Anchors
) -> DataFrame:
    """(h1, h2, first, count, anchor, name) for each fragment with one of the anchors."""
    words, hashes = several.words, several.hashes

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = Fragments(length, anchor)
        for frame in frames:
            for at in range(0, len(frame), 256):
                part = frame.iloc[at : at + 256]
                found = [_named(raw, cutter, words, hashes) for raw in part["raw"]]
                sizes = [x[0].size for x in found]
                columns = [np.concatenate(x) for x in zip(*found)]
                made = pd.DataFrame(
                    dict(zip(["first", "count", *FRAGMENT_COLUMNS], columns))
                )
                made["h1"] = np.repeat(part["h1"].to_numpy(), sizes)
                made["h2"] = np.repeat(part["h2"].to_numpy(), sizes)
                yield made

    return _bytes_and_hashes(documents, length).mapInPandas(
        cut,
        "first int, count int, anchor long, name long, h1 long, h2 long",
    )


def _contents(
    documents: DataFrame, wanted: DataFrame, length: int, anchor: int, several: Anchors
) -> DataFrame:
    """(anchor, name, content) of fragments in `wanted`, and of a few more.

    Each is cut from texts whose h1 is its `source`; others are passed over.
    """
    own_words, own_hashes = several.words, several.hashes
    sources = wanted.select(
        F.col("source").alias("low"), F.xxhash64("source").alias("high")
    ).distinct()
    texts = bloom_words(
        sources, bits_for(sources.count(), FILTER_RATE), FILTER_HASHES
    )
    bits = bits_for(wanted.count(), FILTER_RATE)
    hashed = wanted.select(F.col("anchor").alias("low"), F.col("name").alias("high"))
    words = bloom_words(hashed, bits, FILTER_HASHES)

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter, seen = Fragments(length, anchor), set()
        for frame in frames:
            low, high = (frame[c].to_numpy().view("uint64") for c in ("h1", "high"))
            rows = []
            for raw in frame["raw"][passes(texts, low, high, FILTER_HASHES)]:
                first, count, own, name = _named(raw, cutter, own_words, own_hashes)
                low, high = own.view("uint64"), name.view("uint64")
                found = passes(words, low, high, FILTER_HASHES)
                for i in np.nonzero(found)[0]:
                    key = (int(own[i]), int(name[i]))
                    if key not in seen:
                        seen.add(key)
                        a = int(first[i])
                        rows.append((*key, raw[a : a + int(count[i]) + length - 1]))
                if len(rows) >= 4096:
                    yield pd.DataFrame(rows, columns=[*FRAGMENT_COLUMNS, "content"])
                    rows = []
            yield pd.DataFrame(rows, columns=[*FRAGMENT_COLUMNS, "content"])

    return (
        _bytes_and_hashes(documents, length)
        .select("raw", "h1", F.xxhash64("h1").alias("high"))
        .mapInPandas(pick, "anchor long, name long, content binary")
        .dropDuplicates(FRAGMENT_COLUMNS)
    )


def repeated_in(contents: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each content, which of its windows of `length` bytes occur twice in all."""
    sizes = np.array([len(c) for c in contents])
    text = np.ones(int(sizes.sum()) + len(contents) + 1, dtype=np.int32)
    text[-1] = 0
    starts = np.cumsum(np.r_[0, sizes + 1])[:-1]
    inside = np.zeros(text.size, dtype=bool)
    for at, content in zip(starts, contents):
        text[at : at + len(content)] = np.frombuffer(content, dtype=np.uint8)
        text[at : at + len(content)] += 2
        inside[at : at + max(len(content) - length + 1, 0)] = True
    with Scratch() as scratch:
        order, shared = suffixes(text, 258, length, scratch)
    # Windows are within a content, so longer common prefixes only join windows.
    alike = inside[order] & (shared >= length)
    repeated = np.zeros(text.size, dtype=bool)
    repeated[order[alike]] = True
    repeated[order[np.nonzero(alike)[0] - 1]] = True
    return [
        repeated[at : at + max(n - length + 1, 0)] for at, n in zip(starts, sizes)
    ]


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of True."""
    edges = np.diff(np.r_[0, flags.astype(np.int8), 0])
    return np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0] - 1


def _parts(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """`frame` by key, whole groups together up to GROUP_BYTES; a larger one alone."""
    sizes = frame["content"].str.len().groupby(frame["key"]).sum()
    part, number, held = {}, 0, 0
    for key, size in sizes.items():
        if held and held + size > GROUP_BYTES:
            number, held = number + 1, 0
        part[key] = number
        held += size
    for _, own in frame.groupby(frame["key"].map(part)):
        yield own


def _sort_shard(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """Equal windows have one key, so a shard is sorted in parts, one after the other."""
    rows = []
    for part in _parts(frame):
        part = part.sort_values([*FRAGMENT_COLUMNS, "first"], ignore_index=True)
        names = zip(*(part[c] for c in [*FRAGMENT_COLUMNS, "n", "first"]))
        for (anchor, name, n, first), flags in zip(
            names, repeated_in(list(part["content"]), length)
        ):
            if n == 1:
                for a, b in zip(*stretches(flags)):
                    rows.append((anchor, name, first + a, first + b))
    return pd.DataFrame(rows, columns=[*FRAGMENT_COLUMNS, "begin", "end"])


def _halves(pieces: DataFrame, length: int, anchor: int, core: int, step: int) -> DataFrame:
    """`pieces` cut in two by the side of the core that has `step` bytes in each window.

    key: hash of the core extended by them. piece: hash of all bytes. place: of the
    core in the content, -1 before the first cut, when it is the anchor.
    """

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter, digest = Fragments(length, anchor), xxhash.xxh3_64_intdigest
        for frame in frames:
            rows = []
            columns = ["anchor", "name", "n", "first", "place", "content"]
            for a, name, n, first, place, raw in zip(*(frame[c] for c in columns)):
                if place < 0:
                    place = cutter.place(np.frombuffer(raw, dtype=np.uint8))
                windows = len(raw) - length + 1
                m = min(windows, max(0, place - step + 1))
                for begin, end, at in ((0, m, place - step), (m, windows, place - m)):
                    if begin < end:
                        own = raw[begin : end + length - 1]
                        key = digest(own[at : at + core + step]) - (1 << 63)
                        piece = digest(own) - (1 << 63)
                        rows.append((a, name, n, first + begin, at, key, piece, own))
            yield pd.DataFrame(
                rows,
                columns=["anchor", "name", "n", "first", "place", "key", "piece", "content"],
            )

    return pieces.mapInPandas(
        cut,
        "anchor long, name long, n long, first int, place int, key long, piece long,"
        " content binary",
    )


def divided(
    pieces: DataFrame, length: int, anchor: int
) -> tuple[list[DataFrame], list[DataFrame]]:
    """Of groups that are too large: what is found by counting, and what is to be sorted.

    Found are (anchor, name, begin, end) as in `_sort_shard`; to be sorted are frames
    (anchor, name, n, first, key, content) of no more than GROUP_BYTES for each key.
    """
    found, bounded, core = [], [], anchor
    pieces = pieces.withColumn("place", F.lit(-1))
    while core < length:
        step = -(-(length - core) // 2)
        cut = stored(_halves(pieces, length, anchor, core, step), "suffix_halves")
        core += step
        each = stored(
            cut.groupBy("key", "piece").agg(
                F.sum("n").alias("total"),
                F.max(F.length("content")).alias("size"),
                F.min(F.struct("anchor", "name", "first")).alias("source"),
            ),
            "suffix_pieces",
        )
        ends = (F.col("first") + F.length("content") - length).alias("end")
        found.append(
            cut.where("n = 1")
            .join(each.where("total > 1").select("key", "piece"), ["key", "piece"])
            .select(*FRAGMENT_COLUMNS, F.col("first").alias("begin"), ends)
        )
        groups = stored(
            each.groupBy("key")
            .agg(
                F.count("*").alias("variants"),
                F.min("total").alias("least"),
                F.sum("size").alias("bytes"),
            )
            .where("variants > 1 AND least = 1")
            .select("key", "bytes"),
            "suffix_groups",
        )
        small = each.join(groups.where(F.col("bytes") <= GROUP_BYTES), "key", "left_semi")
        source = [F.col(f"source.{c}").alias(c) for c in ("anchor", "name", "first")]
        # One of equal pieces is sorted; found are only those that have no equal.
        bounded.append(
            cut.join(small.select("key", "piece", "total", *source), ["key", "piece", "anchor", "name", "first"])
            .select("anchor", "name", F.col("total").alias("n"), "first", "key", "content")
        )
        hot = groups.where(F.col("bytes") > GROUP_BYTES)
        if hot.isEmpty():
            break
        pieces = cut.join(hot, "key", "left_semi").drop("key", "piece")
    return found, bounded


def repeats(
    documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR
) -> DataFrame:
    """(h1, h2, begin, end): where repeated strings start, first and last place.

    A row for each stretch within a fragment, by the hashes of the text.
    """
    several = Anchors(documents, length, anchor)
    fragments = stored(
        _fragments(documents, length, anchor, several), "suffix_fragments"
    )
    found = settled(
        lambda: _found(fragments, documents, length, anchor, several), "suffix_found"
    )
    return (
        fragments.select("h1", "h2", "first", *FRAGMENT_COLUMNS)
        .join(found, FRAGMENT_COLUMNS)
        .select(
            "h1",
            "h2",
            (F.col("first") + F.col("begin")).alias("begin"),
            (F.col("first") + F.col("end")).alias("end"),
        )
        .distinct()
    )


def _found(
    fragments: DataFrame,
    documents: DataFrame,
    length: int,
    anchor: int,
    several: Anchors,
) -> DataFrame:
    """Fragments with the first and last place, within them, of repeated strings."""
    different = stored(
        fragments.groupBy(*FRAGMENT_COLUMNS).agg(
            F.count("*").alias("n"),
            F.first("count").alias("count"),
            F.min("h1").alias("source"),
        ),
        "suffix_different",
    )
    unsettled = (
        different.groupBy("anchor")
        .agg(F.count("*").alias("variants"), F.min("n").alias("least"))
        .where("variants > 1 AND least = 1")
        .select("anchor")
    )
    to_sort = stored(different.join(unsettled, "anchor", "left_semi"), "suffix_to_sort")
    groups = to_sort.groupBy("anchor").agg(F.sum(F.col("count") + length).alias("bytes"))
    hot = stored(groups.where(F.col("bytes") > GROUP_BYTES).select("anchor"), "suffix_hot")
    found = different.where("n > 1").select(
        *FRAGMENT_COLUMNS, F.lit(0).alias("begin"), (F.col("count") - 1).alias("end")
    )
    total = to_sort.agg(F.sum(F.col("count") + length)).first()[0] or 0
    if total:
        pieces = (
            to_sort.select(*FRAGMENT_COLUMNS, "n")
            .join(_contents(documents, to_sort, length, anchor, several), FRAGMENT_COLUMNS)
            .select(
                *FRAGMENT_COLUMNS,
                "n",
                F.lit(0).alias("first"),
                F.col("anchor").alias("key"),
                "content",
            )
        )
        if not hot.isEmpty():
            pieces = stored(pieces, "suffix_contents")
            large = pieces.join(hot, "anchor", "left_semi").drop("key")
            pieces = pieces.join(hot, "anchor", "left_anti")
            with staying():
                counted, bounded = divided(large, length, anchor)
            for frame in counted:
                found = found.unionByName(frame)
            for frame in bounded:
                pieces = pieces.unionByName(frame)
        shards = -(-total // SHARD_BYTES)
        sorted_ = (
            pieces.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
            # By the work: Spark would put shards together by their few bytes.
            .repartition(shards, "shard")
            .groupBy("shard")
            .applyInPandas(
                lambda frame: _sort_shard(frame, length),
                "anchor long, name long, begin int, end int",
            )
        )
        found = found.unionByName(sorted_)
    return found


def removed_bytes(size: int, found, length: int = LENGTH) -> np.ndarray:
    """Flags of the bytes that strings starting at `found` (begin, end) cover."""
    edges = np.zeros(size + 1, dtype=np.int64)
    for r in found:
        edges[r["begin"]] += 1
        edges[r["end"] + length] -= 1
    return np.cumsum(edges)[:size] > 0


def with_repeats(
    documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR
) -> tuple[DataFrame, DataFrame, str]:
    """Rows without any repeated string, rows with a column of them, and its name.

    Texts that may have some are told by a Bloom filter and joined to them; the
    first frame lacks only rows that may. Rows that pass by chance have a NULL.
    """
    spans, r1, r2, h1, h2, maybe = free_names(
        documents, "repeats", "r1", "r2", "h1", "h2", "may"
    )
    found = settled(
        lambda: repeats(documents, length, anchor)
        .groupBy("h1", "h2")
        .agg(F.collect_list(F.struct("begin", "end")).alias("spans")),
        "suffix_repeats",
    ).toDF(r1, r2, spans)
    bits = bits_for(found.count(), FILTER_RATE)
    hashed = found.select(F.col(r1).alias("low"), F.col(r2).alias("high"))
    words = bloom_words(hashed, bits, FILTER_HASHES)

    @F.pandas_udf("boolean")
    def may(h1: pd.Series, h2: pd.Series) -> pd.Series:
        low, high = (x.to_numpy().view("uint64") for x in (h1, h2))
        return pd.Series(passes(words, low, high, FILTER_HASHES))

    marked = documents.withColumns(
        {h1: F.xxhash64("text"), h2: F.xxhash64(F.lit(1), "text")}
    ).withColumn(maybe, may(h1, h2))
    plain = marked.where(~F.col(maybe)).drop(h1, h2, maybe)
    matches = (F.col(h1) == F.col(r1)) & (F.col(h2) == F.col(r2))
    others = marked.where(F.col(maybe)).join(found, matches, "left")
    return plain, others.drop(h1, h2, maybe, r1, r2), spans


def remove_repeats(
    documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for each row of `documents`.

    Bytes are those of the UTF-8 text, none for NULL. n_spans counts maximal runs
    of removed bytes; kept_sha256 is of the bytes that remain. Copies of a text of
    `length` bytes or more lose all of it, the first as well. NULL ids and repeated
    rows stay, ids that are no integers are text; other columns are ignored.
    """
    rows = documents.select("doc_id", "text")
    plain, others, spans = with_repeats(rows, length, anchor)
    raw = F.coalesce("text", F.lit("")).cast("binary")

    def strip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for content, found in zip(frame.pop("raw"), frame.pop("repeats")):
                gone = removed_bytes(len(content), found if found is not None else (), length)
                kept = np.frombuffer(content, dtype=np.uint8)[~gone].tobytes()
                made.append(
                    (int(gone.sum()), len(stretches(gone)[0]), hashlib.sha256(kept).hexdigest())
                )
            frame[["n_removed", "n_spans", "kept_sha256"]] = pd.DataFrame(
                made, columns=["n_removed", "n_spans", "kept_sha256"], index=frame.index
            )
            yield frame

    stripped = (
        others.select(
            *carried_id(documents),
            F.length(raw).cast("long").alias("n_bytes"),
            raw.alias("raw"),
            F.col(spans).alias("repeats"),
        )
        .mapInPandas(
            strip,
            f"doc_id {id_type(documents)}, no_id boolean, n_bytes long, n_removed long, n_spans long,"
            " kept_sha256 string",
        )
        .withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id")))
        .drop("no_id")
    )
    untouched = plain.select(
        F.col("doc_id").cast(id_type(documents)).alias("doc_id"),
        F.length(raw).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.sha2(raw, 256).alias("kept_sha256"),
    )
    return untouched.unionByName(stripped)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def words_within(text: str, begin: int, end: int) -> int:
    """Whole words of `text` in text[begin:end]."""
    n = len(WORDS.findall(text[begin:end]))
    cut = [at for at in (begin, end) if 0 < at < len(text) and WORDS.fullmatch(text[at - 1 : at + 1])]
    return max(0, n - len(cut))


def without_repeats(
    documents: DataFrame,
    length: int = LENGTH,
    anchor: int = ANCHOR,
    over_words: int | None = None,
) -> DataFrame:
    """`documents` with repeated strings taken out of text, n_chars to match.

    A character goes if one of its bytes does. Rows left without text go; rows
    whose text was empty or NULL before stay; columns of other names, NULL ids and
    repeated rows stay as they are. With `over_words`, a run of removed
    bytes that is shorter than LENGTH stays if it has no more whole words.
    """
    plain, others, spans = with_repeats(documents, length, anchor)
    (stripped_text,) = free_names(others, "stripped")

    @F.pandas_udf("string")
    def strip(texts: pd.Series, found: pd.Series) -> pd.Series:
        made = []
        for text, spans in zip(texts, found):
            if text and spans is not None and len(spans):
                raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
                gone = removed_bytes(raw.size, spans, length)
                leads = raw & 0xC0 != 0x80
                char = np.cumsum(leads) - 1
                if over_words is not None:
                    for a, b in zip(*stretches(gone)):
                        within = words_within(text, int(char[a]), int(char[b]) + 1)
                        if b - a + 1 < LENGTH and within <= over_words:
                            gone[a : b + 1] = False
                lost = np.zeros(int(char[-1]) + 1, dtype=bool)
                lost[char[gone]] = True
                text = raw[~lost[char]].tobytes().decode()
            made.append(text)
        return pd.Series(made, dtype="object")

    changed = F.size(F.coalesce(spans, F.array())) > 0
    stripped = (
        others.withColumn(stripped_text, strip("text", F.col(spans)))
        .where(~changed | (F.length(stripped_text) > 0))
        .withColumn("text", F.col(stripped_text))
    )
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        counted = F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
        stripped = stripped.withColumn("n_chars", counted.cast(kind))
    return plain.unionByName(stripped.drop(spans, stripped_text))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: repeated passages go from all texts, and texts of nothing else."""
    return without_repeats(docs, PASSAGE_LENGTH, PASSAGE_ANCHOR, PASSAGE_WORDS)
