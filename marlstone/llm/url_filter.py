"""URL rules by Bloom filter cascades.

A cascade answers "is this key listed?" exactly for every key of a known
universe. Its first level is a Bloom filter of the listed keys; the second holds
the universe's keys that pass the first without being listed; the third the
listed keys that pass the second, and so on until a level has no false positive
left. Classifying pages is then a map without a join, and what travels to the
tasks are a few bit arrays of bounded size.

The universe is every key that a page's url can match: each suffix of its host
at a label, with each prefix of its path whose length some listed key has.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import bits_for, bloom_words, passes, stored, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: host and path written together, verdict
RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]

#: Sites that are blocked where no rule fits; a site has its subdomains as well.
BLOCKED_SITES = [
    f"{name}.example.{top}"
    for name in ("casino-win", "cheap-pills", "spam-farm")
    for top in ("com", "net", "org")
]

FIRST_RATE = 0.001
LATER_RATE = 0.5
MAX_LEVELS = 200


def host_and_path(url) -> tuple:
    """Columns host and path of a url; '' for both where it is NULL or has no ://."""
    found = lambda group: F.coalesce(
        F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit("")
    )
    return F.translate(found(1), UPPER, LOWER), found(2)


def split_key(key: str) -> tuple[str, str]:
    host, slash, rest = key.partition("/")
    return host, slash + rest


def matching_keys(host: str, path: str, lengths: Sequence[int]) -> list[str]:
    """Keys that could be listed for this url, the longest first."""
    labels = host.split(".") if host else []
    suffixes = [".".join(labels[i:]) for i in range(len(labels))]
    keys = [s + path[:n] for n in lengths if n <= len(path) for s in suffixes if s]
    return sorted(keys, key=lambda k: (-len(k), -len(split_key(k)[0])))


def hashed(keys: Sequence[str], salt: int) -> tuple[np.ndarray, np.ndarray]:
    pairs = [xxhash.xxh3_128(k.encode("utf-8", "replace"), salt).digest() for k in keys]
    both = np.frombuffer(b"".join(pairs), dtype="<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


@dataclass
class Level:
    words: np.ndarray
    hashes: int
    salt: int

    def passes(self, keys: Sequence[str]) -> np.ndarray:
        return passes(self.words, *hashed(keys, self.salt), self.hashes)


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def contains(self, keys: Sequence[str]) -> np.ndarray:
        """Exact for keys of the universe it was built over."""
        listed = np.zeros(len(keys), dtype=bool)
        at = np.arange(len(keys))
        for depth, level in enumerate(self.levels):
            if not at.size:
                break
            kept = at[level.passes([keys[i] for i in at])]
            listed[at] = depth % 2 == 1  # those that do not pass
            listed[kept] = depth % 2 == 0
            at = kept
        return listed


def _level(keys: DataFrame, salt: int, rate: float) -> Level:
    bits = bits_for(keys.count(), rate)
    hashes = max(1, round(-np.log2(rate)))

    def hash_keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            low, high = hashed(list(frame["key"]), salt)
            yield pd.DataFrame({"low": low.view("int64"), "high": high.view("int64")})

    return Level(
        bloom_words(keys.mapInPandas(hash_keys, "low long, high long"), bits, hashes),
        hashes,
        salt,
    )


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys = list(frame["key"])
            if keys:
                passed = [k for k, p in zip(keys, level.passes(keys)) if p]
                yield pd.DataFrame({"key": passed}, dtype="object")

    return keys.select("key").mapInPandas(run, "key string")


def build_cascade(listed: DataFrame, urls: DataFrame, lengths: Sequence[int]) -> Cascade:
    """A cascade for `listed` (column key) over the keys of `urls` (host, path)."""
    listed = listed.select("key").where(F.col("key").isNotNull()).distinct()
    listed = stored(listed, "cascade_listed")
    if listed.isEmpty():
        return Cascade()
    levels = [_level(listed, 0, FIRST_RATE)]

    def first_pass(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys = {
                k
                for host, path in zip(frame["host"], frame["path"])
                for k in matching_keys(host, path, lengths)
            }
            keys = list(keys)
            if keys:
                found = levels[0].passes(keys)
                passed = [k for k, f in zip(keys, found) if f]
                yield pd.DataFrame({"key": passed}, dtype="object")

    unlisted = (
        urls.select("host", "path")
        .mapInPandas(first_pass, "key string")
        .distinct()
        .join(listed, "key", "left_anti")
    )
    # inside: keys the next level has to hold; outside: keys it has to tell from them
    inside, outside = stored(unlisted, "cascade_level"), listed
    while not inside.isEmpty():
        if len(levels) >= MAX_LEVELS:
            raise RuntimeError("the cascade does not converge")
        levels.append(_level(inside, len(levels), LATER_RATE))
        passed = stored(_passing(outside, levels[-1]), "cascade_level")
        inside, outside = passed, inside
    return Cascade(levels)


def path_lengths(listed: DataFrame) -> list[int]:
    """The different lengths of listed paths: few, whatever the number of keys."""
    path = F.regexp_extract("key", r"(?s)^[^/]*(.*)$", 1)
    rows = listed.select(F.length(path).alias("n")).distinct().collect()
    return sorted(r["n"] for r in rows if r["n"] is not None)


def keys_frame(spark: SparkSession, keys: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in keys], "key string")


def judge_urls(
    pages: DataFrame,
    allow: DataFrame,
    block: DataFrame,
    blocked_sites: DataFrame,
    *,
    url: str = "url",
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """`keep`, host, path, rule and verdict for every row of `pages`.

    `allow`, `block` and `blocked_sites` hold listed keys in a column key. The
    longest key of `allow` and `block` that fits is the rule (equal lengths: the
    longer host; listed under both: block). Where no rule fits, rule is NULL and
    the verdict is block for `blocked_sites` and allow for all others. Urls that
    are NULL or have no :// fit nothing and are allowed. Repeated rows are
    judged each; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url))
    urls = pages.select(*keep, host.alias("host"), path.alias("path"))
    listed = allow.select("key").union(block.select("key"))
    lengths = path_lengths(listed)
    site_lengths = path_lengths(blocked_sites)
    allowed = build_cascade(allow, urls, lengths)
    blocked = build_cascade(block, urls, lengths)
    sites = build_cascade(blocked_sites, urls, site_lengths)

    def verdicts(host: str, path: str) -> tuple[str | None, str]:
        keys = matching_keys(host, path, lengths)
        if keys:
            stops, goes = blocked.contains(keys), allowed.contains(keys)
            for key, stop, go in zip(keys, stops, goes):
                if stop or go:
                    return key, "block" if stop else "allow"
        keys = matching_keys(host, path, site_lengths)
        return None, "block" if keys and sites.contains(keys).any() else "allow"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            known: dict[tuple[str, str], tuple] = {}
            found = []
            for pair in zip(frame["host"], frame["path"]):
                if pair not in known:
                    known[pair] = verdicts(*pair)
                found.append(known[pair])
            yield frame.assign(
                rule=[r for r, _ in found], verdict=[v for _, v in found]
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema)
    return urls.mapInPandas(run, f"{kept}, rule string, verdict string")


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_verdict = {
        v: keys_frame(spark, [k for k, verdict in RULES if verdict == v])
        for v in ("allow", "block")
    }
    return judge_urls(
        table(spark, sf_dir, "pages"),
        by_verdict["allow"],
        by_verdict["block"],
        keys_frame(spark, BLOCKED_SITES),
    )


def oracle() -> str:
    """The same result by plain conditions; rules and sites as the constants above."""
    fits = (
        "(host = r.rule_host OR ends_with(host, '.' || r.rule_host))"
        " AND starts_with(path, r.rule_path)"
    )
    values = ", ".join(
        "('{}', '{}', '{}')".format(*split_key(k), v) for k, v in RULES
    )
    sites = " OR ".join(
        f"host = '{s}' OR ends_with(host, '.{s}')" for s in BLOCKED_SITES
    )
    return f"""
    WITH u AS (
      SELECT page_id,
             translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
                       '{UPPER}', '{LOWER}') AS host,
             coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
      FROM pages),
    r(rule_host, rule_path, verdict) AS (VALUES {values}),
    m AS (
      SELECT page_id, host, path,
             (SELECT arg_max(r.rule_host || r.rule_path,
                             length(r.rule_host || r.rule_path))
              FROM r WHERE {fits}) AS rule
      FROM u)
    SELECT page_id, host, path, rule,
           CASE WHEN rule IS NOT NULL
                THEN (SELECT max(verdict) FROM r WHERE r.rule_host || r.rule_path = rule)
                WHEN {sites} THEN 'block' ELSE 'allow' END AS verdict
    FROM m"""
