"""Words of texts as 64-bit hashes, shared by the operators on word runs."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORDS = re.compile(r"\w+")
CACHED_WORDS = 500_000


class WordHashes:
    """Hashes of the lower-cased words (runs of letters, digits and _) of a text.

    Remembers a bounded number of words.
    """

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.uint64)
        words = WORDS.findall(text.lower())
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace"))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(words: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """For each place, the hash of the words at `offsets` from it.

    As many places as fit; none if the text is too short.
    """
    n = words.size - max(offsets)
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, len(offsets), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in offsets:
            total *= np.uint64(0x9E3779B97F4A7C15)
            total += words[at : at + n]
    return mixed(total)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Different runs of `size` words, sorted. A shorter text is one run as a whole."""
    if not words.size:
        return words
    return np.unique(runs(words, tuple(range(min(size, words.size)))))
