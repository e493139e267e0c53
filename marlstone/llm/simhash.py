"""Near duplicates by SimHash: fingerprints at most two bits apart, and their groups.

Search follows the generalised pigeonhole principle. The 64 bits are put into parts
of correlated bits. If the thresholds t of the parts, each -1 or more, have
sum(t + 1) = DISTANCE + 1, two fingerprints within DISTANCE agree in some part to
within its t: else they would differ in at least sum(t + 1) bits. A part with t = -1
is not looked at. Every fingerprint has thresholds of its own: dynamic programming
takes those of least cost, from the numbers of candidates that are estimated for it in
each part and the numbers of keys it would have to look up there. Where every choice
is dear, as amid many alike fingerprints, it looks up all values within DISTANCE of the
whole fingerprint, so that no fingerprint costs more than that, however skewed the
bits are.

Each fingerprint is listed under its value in each part. Looked up keys meet the
listed fingerprints in a bucket, where the bits that differ are counted exactly. A
bucket returns a spanning forest of its links, so that a group of n alike
fingerprints gives fewer than n edges a bucket; groups are their components.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import stored, table
from marlstone.llm.components import components

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 2
PIECE_BYTES = 1 << 20
HELD = 1 << 16

# Bits of a histogram block; what a key looked up costs, in candidates compared.
BLOCK_BITS = 11
KEY_COST = 200.0

# Listed fingerprints that meet in one bucket at most; larger ones are divided.
BUCKET = 50_000
BROADCAST_ROWS = 200_000
COMPARED = 1 << 22


# -- fingerprints --------------------------------------------------------------


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """Words in lists of bounded size; a list starts with the two before it."""
    white = re.compile(rb"[\x20\x09-\x0D]")
    at, last = 0, []
    while at < len(text):
        end = white.search(text, at + PIECE_BYTES)
        end = end.start() if end else len(text)
        words = last + text[at:end].split()
        yield words
        last = words[-(SHINGLE - 1) :]
        at = end


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the numbers have each bit, bit 0 first."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None) -> int:
    """SimHash of a text's word shingles, as a signed number; 0 without a word."""
    counts, n, short = np.zeros(BITS, dtype=np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    # Only A-Z change when bytes are lower-cased, and only ASCII space splits them.
    for words in _pieces((text or "").encode("utf-8", "replace").lower()):
        if len(words) < SHINGLE:
            short = words
            continue
        runs = zip(*(words[i:] for i in range(SHINGLE)))
        hashes = np.array([digest(b" ".join(run), SEED) for run in runs], dtype=np.uint64)
        for start in range(0, hashes.size, HELD):
            counts += _set_bits(hashes[start : start + HELD])
        n += hashes.size
    if not n and short:
        counts, n = _set_bits(np.array([digest(b" ".join(short), SEED)], dtype=np.uint64)), 1
    value = int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp of whole texts; NULL and empty texts have fp 0."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return docs.select("doc_id", of("text").alias("fp"))


# -- parts and thresholds ------------------------------------------------------


def _co_occurrence(fps: DataFrame) -> np.ndarray:
    """How many fingerprints have both of two bits; one row a pair from each task."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BITS, BITS))
        for frame in frames:
            values = frame["fp"].to_numpy(dtype=np.int64).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
        a, b = np.triu_indices(BITS)
        yield pd.DataFrame({"a": a, "b": b, "n": total[a, b].astype(np.int64)})

    rows = (
        fps.select("fp").mapInPandas(partial, "a int, b int, n long")
        .groupBy("a", "b").agg(F.sum("n").alias("n")).toPandas()
    )
    both = np.zeros((BITS, BITS))
    both[rows["a"], rows["b"]] = both[rows["b"], rows["a"]] = rows["n"]
    return both


def grouped_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in parts of nearly equal size, correlated ones together.

    A part starts with the bit that is most correlated to all that are left, and takes
    the one most correlated to those it has until it is full.
    """
    share = np.diag(both) / max(n, 1)
    covariance = both / max(n, 1) - np.outer(share, share)
    spread = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
    related = np.abs(covariance / np.outer(spread, spread))
    np.fill_diagonal(related, 0.0)
    left, out = list(range(BITS)), []
    for i in range(parts):
        size = len(left) // (parts - i)
        part = [max(left, key=lambda b: related[b, left].sum())]
        left.remove(part[0])
        while len(part) < size:
            part.append(max(left, key=lambda b: related[b, part].sum()))
            left.remove(part[-1])
        out.append(sorted(part))
    return out


def taken(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The numbers that the given bits of uint64 values make, the first one lowest."""
    out = np.zeros(values.shape, dtype=np.uint64)
    for i, b in enumerate(bits):
        out |= ((values >> np.uint64(b)) & np.uint64(1)) << np.uint64(i)
    return out


@dataclass
class Plan:
    """The parts, and for blocks of their bits how many fingerprints are how near.

    near[part][block][d][v]: the share of fingerprints whose value in the block is
    exactly d bits from v. Blocks count as independent when they are put together.
    """

    n: int
    parts: list[list[int]]
    near: list[list[np.ndarray]]

    def blocks(self, part: int) -> list[list[int]]:
        return blocks_of(self.parts[part])

    def shares(self, values: np.ndarray, part: int) -> np.ndarray:
        """Share of fingerprints within 0, 1, ... DISTANCE of each value in the part."""
        exact = np.zeros((DISTANCE + 1, values.size))
        exact[0] = 1.0
        for bits, near in zip(self.blocks(part), self.near[part], strict=True):
            own = near[:, taken(values, bits).astype(np.int64)]
            exact = np.stack(
                [sum(exact[d - k] * own[k] for k in range(d + 1)) for d in range(DISTANCE + 1)]
            )
        return exact.cumsum(axis=0)

    def costs(self, values: np.ndarray) -> np.ndarray:
        """Cost of the thresholds -1 to DISTANCE for each part and value."""
        out = np.zeros((len(self.parts), DISTANCE + 2, values.size))
        for i, bits in enumerate(self.parts):
            candidates = self.n * self.shares(values, i)
            keys = 0
            for t in range(DISTANCE + 1):
                keys += sum(1 for _ in combinations(bits, t))
                out[i, t + 1] = KEY_COST * keys + candidates[t]
        return out

    def thresholds(self, values: np.ndarray) -> np.ndarray:
        """The cheapest thresholds, a row for each part; all -1 where none is cheap.

        Dynamic programming over the parts: what is the least cost of the parts so
        far if their t + 1 add up to s?
        """
        costs = self.costs(values)
        goal = DISTANCE + 1
        best = np.full((goal + 1, values.size), np.inf)
        best[0] = 0.0
        chosen = []
        for own in costs:
            options = np.full((goal + 1, goal + 1, values.size), np.inf)
            for s in range(goal + 1):
                for k in range(s + 1):
                    options[s, k] = best[s - k] + own[k]
            pick = options.argmin(axis=1)
            best = np.take_along_axis(options, pick[:, None], axis=1)[:, 0]
            chosen.append(pick)
        out = np.zeros((len(self.parts), values.size), dtype=np.int64)
        s = np.full(values.size, goal)
        for i in range(len(self.parts) - 1, -1, -1):
            out[i] = chosen[i][s, np.arange(values.size)]
            s -= out[i]
        out -= 1
        everything = KEY_COST * len(within(list(range(BITS)), DISTANCE))
        out[:, best[goal] > everything] = -1
        return out


def blocks_of(bits: list[int]) -> list[list[int]]:
    return [bits[i : i + BLOCK_BITS] for i in range(0, len(bits), BLOCK_BITS)]


def within(bits: list[int], t: int) -> np.ndarray:
    """All ways to change at most t of the bits, as numbers to xor with."""
    return np.array(
        [sum(1 << b for b in some) for k in range(t + 1) for some in combinations(bits, k)],
        dtype=np.uint64,
    )


def made_plan(fps: DataFrame, parts: int | None = None) -> Plan:
    """A plan from all different fingerprints (fp).

    By default as many parts as leave each about as many values as there are
    fingerprints. The driver gets 64 * 65 / 2 counts of pairs and a histogram of at
    most 64 / BLOCK_BITS + parts blocks of 2 ** BLOCK_BITS values, however many
    fingerprints there are.
    """
    n = fps.count()
    if parts is None:
        parts = min(6, max(2, BITS // max(8, int(np.ceil(np.log2(n + 1))))))
    groups = grouped_bits(_co_occurrence(fps), n, parts)
    blocks = [b for g in groups for b in blocks_of(g)]

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [np.zeros(1 << len(b), dtype=np.int64) for b in blocks]
        for frame in frames:
            values = frame["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            for own, bits in zip(counts, blocks, strict=True):
                own += np.bincount(taken(values, bits).astype(np.int64), minlength=own.size)
        for i, own in enumerate(counts):
            (seen,) = np.nonzero(own)
            yield pd.DataFrame({"block": i, "value": seen, "n": own[seen]})

    rows = (
        fps.select("fp").mapInPandas(partial, "block int, value long, n long")
        .groupBy("block", "value").agg(F.sum("n").alias("n")).toPandas()
    )
    near = []
    for i, bits in enumerate(blocks):
        own = rows[rows["block"] == i]
        share = np.zeros(1 << len(bits))
        share[own["value"].to_numpy(dtype=np.int64)] = own["n"].to_numpy() / max(n, 1)
        places, at = list(range(len(bits))), np.arange(share.size)
        near.append(
            np.stack(
                [
                    sum(
                        (share[at ^ sum(1 << p for p in some)] for some in combinations(places, d)),
                        np.zeros(share.size),
                    )
                    for d in range(DISTANCE + 1)
                ]
            )
        )
    it = iter(near)
    return Plan(n, groups, [[next(it) for _ in blocks_of(g)] for g in groups])


# -- buckets -------------------------------------------------------------------

LISTED, ASKING = 1, 2
"""What a fingerprint does in a bucket; the sum is both."""

KEY = ["part", "value"]


def entries(fps: DataFrame, plan: Plan) -> DataFrame:
    """part, value, role, fp: under which keys a fingerprint is listed, which it looks up.

    The part after the last is the whole fingerprint.
    """

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            for start in range(0, values.size, 2_000):
                yield from rows(values[start : start + 2_000])

    def rows(values: np.ndarray) -> Iterator[pd.DataFrame]:
        thresholds = plan.thresholds(values)
        for part, bits in enumerate(plan.parts):
            yield frame(part, taken(values, bits), LISTED + ASKING * (thresholds[part] >= 0), values)
            for t in range(1, DISTANCE + 1):
                asked = values[thresholds[part] == t]
                yield from looked_up(part, bits, asked, within(list(range(len(bits))), t)[1:])
        whole = (thresholds < 0).all(axis=0)
        every = list(range(BITS))
        part = len(plan.parts)
        yield frame(part, values, np.full(values.size, LISTED), values)
        yield from looked_up(part, every, values[whole], within(every, DISTANCE)[1:])

    def looked_up(part, bits, asked, changes) -> Iterator[pd.DataFrame]:
        if asked.size:
            keys = (taken(asked, bits)[:, None] ^ changes).ravel()
            yield frame(part, keys, np.full(keys.size, ASKING), np.repeat(asked, changes.size))

    def frame(part, keys, roles, values) -> pd.DataFrame:
        return pd.DataFrame(
            {"part": np.full(keys.size, part), "value": keys.view(np.int64),
             "role": roles, "fp": values.view(np.int64)}
        )

    return fps.select("fp").mapInPandas(made, "part int, value long, role int, fp long")


def _divided(found: DataFrame, bucket: int) -> DataFrame:
    """`found` with the number `shard` of the bucket's division.

    The listed fingerprints of a large bucket are dealt out by hash; every key
    looked up there meets each shard. There is one large bucket for every `bucket`
    listed fingerprints at most; their table is broadcast up to BROADCAST_ROWS.
    """
    listed = F.col("role") != ASKING
    large = stored(
        found.where(listed).groupBy(*KEY).count().where(F.col("count") > bucket)
        .select(*KEY, F.ceil(F.col("count") / bucket).cast("int").alias("shards")),
        "simhash",
    )
    n = large.count()
    if not n:
        return found.select(*KEY, F.lit(0).alias("shard"), "role", "fp")
    joined = found.join(F.broadcast(large) if n <= BROADCAST_ROWS else large, KEY, "left")
    shards = F.coalesce("shards", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), shards).cast("int")
    shard = F.explode(
        F.when(F.col("role") == LISTED, F.array(own)).otherwise(
            F.sequence(F.lit(0), shards - 1)
        )
    )
    dealt = joined.withColumn("own", own).withColumn("shard", shard)
    elsewhere = listed & (F.col("shard") != F.col("own"))
    return dealt.select(
        *KEY, "shard", F.when(elsewhere, ASKING).otherwise(F.col("role")).alias("role"), "fp"
    )


class Bucket:
    """Listed fingerprints of one bucket and the links found so far, as a forest."""

    def __init__(self) -> None:
        self.listed: list[np.ndarray] = []
        self.asking: list[np.ndarray] = []
        self.members: np.ndarray | None = None
        self.parent: list[int] = []
        self.edges: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def take(self, roles: np.ndarray, values: np.ndarray) -> None:
        """Rows of the bucket; listed ones come before those that only ask."""
        inside = roles != ASKING
        self.listed.append(values[inside])
        self.asking.append(values[roles == LISTED + ASKING])
        if not inside.all():
            self.settle()
            self.compare(values[~inside], own=False)

    def settle(self) -> None:
        """All listed ones are there: compare those of them that ask."""
        if self.members is None:
            self.members = np.concatenate(self.listed)
            self.parent = list(range(self.members.size))
            self.compare(np.concatenate(self.asking), own=True)

    def compare(self, asked: np.ndarray, own: bool) -> None:
        members = self.members
        if not members.size:
            return
        step = max(1, COMPARED // members.size)
        places = {v: i for i, v in enumerate(members.tolist())} if own else {}
        for start in range(0, asked.size, step):
            some = asked[start : start + step]
            rows, columns = np.nonzero(
                np.bitwise_count(some[:, None] ^ members[None, :]) <= DISTANCE
            )
            if own:
                for i, j in zip(rows.tolist(), columns.tolist(), strict=True):
                    self.join(places[int(some[i])], j)
                continue
            # Those it meets are near it, not each other; each is linked to it.
            ends = np.searchsorted(rows, np.arange(some.size + 1))
            for i in np.nonzero(np.diff(ends))[0].tolist():
                known: set[int] = set()
                for j in columns[ends[i] : ends[i + 1]].tolist():
                    root = self.root(j)
                    if root in known:
                        continue
                    known.add(root)
                    self.edges.append((int(some[i]), int(members[j])))
                first = min(known)
                for root in known:
                    self.parent[root] = first

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.edges.append((int(self.members[i]), int(self.members[j])))

    def taken_edges(self) -> list[tuple[int, int]]:
        out, self.edges = self.edges, []
        return out


def _links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges of the buckets, which stand one after the other in sorted rows."""
    open_key, bucket = None, Bucket()
    for frame in frames:
        if not len(frame):
            continue
        keys = frame[[*KEY, "shard"]].to_numpy()
        roles = frame["role"].to_numpy()
        values = frame["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        new = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
        starts = np.append(np.nonzero(new)[0], len(frame))
        # One row alone meets nothing; the first may go on, the last may be gone on.
        wanted = np.diff(starts) > 1
        wanted[[0, -1]] = True
        out = []
        for g in np.nonzero(wanted)[0]:
            part = slice(starts[g], starts[g + 1])
            if (key := tuple(keys[starts[g]])) != open_key:
                bucket.settle() if bucket.listed else None
                out += bucket.taken_edges()
                open_key, bucket = key, Bucket()
            bucket.take(roles[part], values[part])
        out += bucket.taken_edges()
        yield _edge_frame(out)
    if bucket.listed:
        bucket.settle()
        yield _edge_frame(bucket.taken_edges())


def _edge_frame(edges: list[tuple[int, int]]) -> pd.DataFrame:
    values = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": values[:, 0], "b": values[:, 1]})


def links(fps: DataFrame, plan: Plan, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between different fingerprints that connect all within DISTANCE."""
    found = stored(entries(fps, plan), "simhash")
    order = [*KEY, "shard", F.col("role") == ASKING]
    return (
        _divided(found, bucket)
        .repartition(*KEY, "shard")
        .sortWithinPartitions(*order)
        .mapInPandas(_links, "a long, b long")
    )


# -- groups --------------------------------------------------------------------


def _hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicate_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of `docs` (doc_id, text).

    component_id is the least doc_id that links of at most DISTANCE bits reach.
    Equal fingerprints are linked, also those of NULL, empty and wordless texts, which
    are all zero. A repeated row stays a row. A NULL doc_id keeps its place and is
    never the least unless its group has no other. No rows give none.
    """
    signed = stored(fingerprints(docs), "simhash")
    classes = stored(signed.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash")
    found = components(links(classes, made_plan(classes)))
    rooted = classes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    grouped = rooted.join(smallest, "root").select(F.col("fp").alias("of"), "component_id")
    return signed.join(grouped, F.col("fp") == F.col("of")).select(
        "doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op13_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near duplicates of every document."""
    return near_duplicate_groups(table(spark, sf_dir, "documents"))
