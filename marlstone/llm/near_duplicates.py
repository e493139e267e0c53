"""Jaccard self-join of texts on word shingles, by a MinHash LSH forest.

Texts with the same set of shingles form one class of copies, counted before
anything else. Each class has a signature: for every tree of the forest DEPTH
MinHash values, a path in that tree's prefix trie. Classes with the same prefix in
some tree are candidates.

Prefixes are shortened from full depth to the largest depth at which a pair at the
threshold, the hardest to find, meets with the target recall. More similar pairs
meet more often, so the target holds whatever else is in the corpus. Candidates are gathered to clusters, and all pairs of a cluster are
verified exactly, in blocks of bounded size that give back counts for each class
and never pairs.
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
    passes,
    settled,
    stored,
    table,
)
from marlstone.llm.components import components
from marlstone.llm.shingles import WordHashes, shingles

SHINGLE_WORDS = 5
THRESHOLD = (4, 5)
"""Least similarity, as numerator and denominator."""

TREES = 20
DEPTH = 8
TARGET_RECALL = 0.9995
BLOCK_CLASSES = 512
BLOCK_SHINGLES = 2_000_000
FILTER_RATE = 0.01

_SEEDS = np.random.default_rng(20).integers(
    1, 1 << 32, (2, TREES * DEPTH), dtype=np.uint32
)
_SEEDS[1] |= 1


def signature(found: np.ndarray) -> bytes:
    """TREES * DEPTH MinHash values of 16 bits each; `found` is not empty."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(TREES * DEPTH, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, x.size, 2048):
        part = x[start : start + 2048] ^ _SEEDS[0][:, None]
        part *= _SEEDS[1][:, None]
        part ^= part >> np.uint32(15)
        np.minimum(least, part.min(1), out=least)
    # The least values are small; mix them before most bits are cut off.
    least *= np.uint32(0x9E3779B1)
    return (least >> np.uint32(16)).astype("<u2").tobytes()


def set_key(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def recall(similarity: float, depth: int) -> float:
    """Chance that a pair has a common prefix of this depth in some tree."""
    return 1 - (1 - similarity**depth) ** TREES


def _with_text_hashes(documents: DataFrame) -> DataFrame:
    return documents.select(
        "doc_id",
        "text",
        F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit(1), "text").alias("h2"),
    )


def signed(documents: DataFrame) -> DataFrame:
    """doc_id, h1, h2, and key, n and sig of the set of shingles (NULL: no words)."""

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for frame in frames:
            rows = []
            for text in frame.pop("text"):
                found = shingles(hashes.of(text), SHINGLE_WORDS)
                if found.size:
                    rows.append((set_key(found), found.size, signature(found)))
                else:
                    rows.append((None, 0, None))
            frame[["key", "n", "sig"]] = pd.DataFrame(
                rows, columns=["key", "n", "sig"], index=frame.index
            )
            yield frame

    flagged = _with_text_hashes(documents).select(
        *carried_id(documents), "h1", "h2", "text"
    )
    schema = f"doc_id {id_type(documents)}, no_id boolean, h1 long, h2 long, key binary, n int, sig binary"
    made = flagged.mapInPandas(sign, schema)
    return made.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop(
        "no_id"
    )


def _prefixes(classes: DataFrame, depth: int) -> DataFrame:
    """(key, bucket) for each tree: the bucket of the class's prefix."""
    each = [
        F.xxhash64(F.lit(t), F.substring("sig", 2 * DEPTH * t + 1, 2 * depth))
        for t in range(TREES)
    ]
    return classes.select("key", F.explode(F.array(*each)).alias("bucket"))


def _meetings(classes: DataFrame, depth: int) -> DataFrame:
    """(a, b, trees): a class, the least of a bucket it is in, in how many trees."""
    prefixes = _prefixes(classes, depth)
    full = (
        prefixes.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("key").alias("b"))
        .where("n > 1")
        .drop("n")
    )
    return (
        prefixes.join(full, "bucket")
        .where("key <> b")
        .groupBy(F.col("key").alias("a"), "b")
        .agg(F.count("*").alias("trees"))
    )


def threshold_depth() -> int:
    """The largest depth with the target recall for pairs at the threshold."""
    least = THRESHOLD[0] / THRESHOLD[1]
    for depth in range(DEPTH, 1, -1):
        if recall(least, depth) >= TARGET_RECALL:
            return depth
    return 1


def sufficient_depth(meetings_by_trees: dict[int, int]) -> int:
    """The largest depth with the target recall on average, from pairs that meet at
    full depth. For looking at a corpus: many nearly equal pairs hide what is lost at
    the threshold, so candidates are gathered at `threshold_depth`.

    A pair that meets in `trees` trees has a similarity of about
    (trees / TREES) ** (1 / DEPTH), and stands for 1 / recall pairs like it. Pairs
    that meet once are mostly below the threshold; those that look closer to it
    than possible count as at the threshold, the hardest to find.
    """
    least = THRESHOLD[0] / THRESHOLD[1]
    pairs = [
        (max(least, (t / TREES) ** (1 / DEPTH)), n)
        for t, n in meetings_by_trees.items()
        if t > 1
    ] or [(least, 1)]
    pairs = [(s, n / recall(s, DEPTH)) for s, n in pairs]
    for depth in range(DEPTH, 1, -1):
        found = sum(n * recall(s, depth) for s, n in pairs)
        if found >= TARGET_RECALL * sum(n for _, n in pairs):
            return depth
    return 1


def candidate_clusters(classes: DataFrame) -> DataFrame:
    """(key, cluster) of classes that share a prefix with another, directly or not."""
    meetings = _meetings(classes, threshold_depth())
    found = components(meetings.select("a", "b"))
    return found.select(F.col("node").alias("key"), F.col("root").alias("cluster"))


def _shingles_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h1, h2, shingles) of texts in `wanted` (h1, h2), and of a few more."""
    bits = bits_for(wanted.count(), FILTER_RATE)
    hashed = wanted.select(F.col("h1").alias("low"), F.col("h2").alias("high"))
    words = bloom_words(hashed, bits, 7)

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, seen = WordHashes(), set()
        for frame in frames:
            h1, h2 = frame["h1"].to_numpy(), frame["h2"].to_numpy()
            texts = frame["text"].to_numpy()
            rows = []
            found = passes(words, h1.view("uint64"), h2.view("uint64"), 7)
            for i in np.nonzero(found)[0]:
                name = (int(h1[i]), int(h2[i]))
                if name not in seen:
                    seen.add(name)
                    made = shingles(hashes.of(texts[i]), SHINGLE_WORDS)
                    rows.append((*name, made.tobytes()))
            yield pd.DataFrame(rows, columns=["h1", "h2", "shingles"])

    return (
        _with_text_hashes(documents)
        .select("h1", "h2", "text")
        .mapInPandas(pick, "h1 long, h2 long, shingles binary")
        .dropDuplicates(["h1", "h2"])
    )


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Matrix of the numbers of shingles that a left and a right class share."""
    both = left + right
    every = np.concatenate(both)
    owner = np.repeat(np.arange(len(both)), [x.size for x in both])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    fresh = np.r_[True, every[1:] != every[:-1]]
    group = np.cumsum(fresh) - 1
    shared = np.bincount(group)[group] > 1
    owner, group = owner[shared], group[shared]
    _, group = np.unique(group, return_inverse=True)
    counts = np.zeros((len(left), len(right)), dtype=np.float32)
    n = len(both)
    for start in range(0, int(group.max()) + 1 if group.size else 0, 4096):
        a, b = np.searchsorted(group, (start, start + 4096))
        grid = np.zeros((n, 4096), dtype=np.float32)
        grid[owner[a:b], group[a:b] - start] = 1
        counts += grid[: len(left)] @ grid[len(left) :].T
    return counts.astype(np.int64)


def _linked(
    left: list[np.ndarray], right: list[np.ndarray], same: bool
) -> np.ndarray:
    common = _common(left, right)
    sizes = np.array([x.size for x in left])[:, None] + np.array(
        [x.size for x in right]
    )
    top, bottom = THRESHOLD
    linked = common * bottom >= top * (sizes - common)
    if same:
        np.fill_diagonal(linked, False)
    return linked


def _roots(linked: np.ndarray) -> np.ndarray:
    """Least row number reachable, of a symmetric relation."""
    root = np.arange(len(linked))
    while True:
        reach = np.where(linked, root[None, :], len(linked)).min(1)
        better = np.minimum(root, reach)
        better = better[better]
        if (better == root).all():
            return root
        root = better


def _verify_block(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    _, one, other = key
    frame = frame.sort_values("key", ignore_index=True)
    sets = [np.frombuffer(x, dtype=np.uint64) for x in frame["shingles"]]
    copies = frame["copies"].to_numpy()
    n = len(sets)
    if one == other:
        linked = _linked(sets, sets, True)
    else:
        (a,) = np.nonzero(frame["block"].to_numpy() == one)
        (b,) = np.nonzero(frame["block"].to_numpy() == other)
        linked = np.zeros((n, n), dtype=bool)
        if a.size and b.size:
            part = _linked([sets[i] for i in a], [sets[i] for i in b], False)
            linked[np.ix_(a, b)] = part
            linked[np.ix_(b, a)] = part.T
    (kept,) = np.nonzero(linked.any(1))
    root = _roots(linked)
    return pd.DataFrame(
        {
            "key": frame["key"][kept],
            "links": (linked @ copies)[kept],
            "root": frame["key"].to_numpy()[root[kept]],
        }
    )


def verified(documents: DataFrame, classes: DataFrame, clusters: DataFrame) -> DataFrame:
    """(key, links, root) by block: documents linked to a class, a class linked to it."""
    members = stored(
        clusters.join(classes.select("key", "h1", "h2", "copies", "n"), "key"),
        "forest_members",
    )
    sizes = members.groupBy("cluster").agg(
        F.count("*").alias("members"), F.sum("n").alias("total")
    )
    blocks = F.greatest(
        F.ceil(F.col("members") / BLOCK_CLASSES), F.ceil(F.col("total") / BLOCK_SHINGLES)
    ).cast("int")
    with_sets = (
        members.join(sizes.select("cluster", blocks.alias("blocks")), "cluster")
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .join(_shingles_of(documents, members.select("h1", "h2")), ["h1", "h2"])
        .select("cluster", "key", "copies", "block", "blocks", "shingles")
    )
    dealt = with_sets.withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        "cluster",
        F.least("block", "with").alias("one"),
        F.greatest("block", "with").alias("other"),
        "key",
        "copies",
        "block",
        "shingles",
    )
    return dealt.groupBy("cluster", "one", "other").applyInPandas(
        _verify_block, "key binary, links long, root binary"
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, h1, h2, class_key, class_id, n_links, copies for each row of `documents`.

    class_id is the least doc_id among rows that links connect; n_links counts
    the other rows whose set of shingles has a similarity of THRESHOLD or more,
    copies those with the same set, the row itself among them. A text of fewer
    than SHINGLE_WORDS words is one shingle. A row without words (NULL, empty)
    links to none, and its class is its own doc_id. Repeated rows are copies;
    NULL ids take part, but name no class; ids that are no integers are text. h1 and h2 are hashes of the text;
    class_key tells classes apart, NULL for rows without words.
    """
    rows = stored(signed(documents), "forest_signed")
    classes = stored(
        rows.where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("first_id"),
            F.min(F.struct("h1", "h2", "n", "sig")).alias("text"),
        )
        .select("key", "copies", "first_id", "text.*"),
        "forest_classes",
    )
    links = stored(
        verified(documents, classes, candidate_clusters(classes)), "forest_links"
    )
    roots = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    linked = (
        classes.select("key", "copies", "first_id")
        .join(links.groupBy("key").agg(F.sum("links").alias("links")), "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    ids = linked.groupBy("root").agg(F.min("first_id").alias("class_id"))
    known = linked.join(ids, "root").select(
        "key",
        F.col("root").alias("class_key"),
        "class_id",
        "copies",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    return rows.join(known, "key", "left").select(
        "doc_id",
        "h1",
        "h2",
        "class_key",
        F.when(F.col("key").isNull(), F.col("doc_id"))
        .otherwise(F.col("class_id"))
        .alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "copies")


def one_of_each(documents: DataFrame) -> DataFrame:
    """`documents` with one row of each class: the least doc_id, then text hash.

    A NULL id comes last. Rows without words are no class; of such rows with equal
    id and text one stays.
    """
    found = settled(lambda: near_duplicates(documents), "forest_found")
    own_id, f1, f2, h1, h2 = free_names(documents, "id", "f1", "f2", "h1", "h2")
    name = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "h1", "h2")
    kept = (
        found.where("class_key IS NOT NULL")
        .groupBy("class_key")
        .agg(F.min(name).alias("name"))
        .select("name.*")
        .unionByName(found.where("class_key IS NULL").select(name.alias("name")).select("name.*"))
        .select(F.col("doc_id").alias(own_id), F.col("h1").alias(f1), F.col("h2").alias(f2))
    )
    hashed = documents.withColumns(
        {h1: F.xxhash64("text"), h2: F.xxhash64(F.lit(1), "text")}
    )
    matches = (
        F.col("doc_id").cast(id_type(documents)).eqNullSafe(F.col(own_id))
        & (F.col(h1) == F.col(f1))
        & (F.col(h2) == F.col(f2))
    )
    named = hashed.join(kept, matches, "left_semi")
    return named.dropDuplicates(["doc_id", h1, h2]).drop(h1, h2)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: one document of each class stays, unchanged.

    Columns of any name stay as they are; for NULLs, empty texts and repeated rows
    see `one_of_each`.
    """
    return one_of_each(docs)
