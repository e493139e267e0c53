"""Suffix order and common prefixes of one shard by external induced sorting.

Suffixes that start a rise after a fall (seeds) are sorted first: their substrings
up to the next seed are sorted and named, and the text of names is sorted by the
same means. From the order of seeds all other suffixes are induced in two sweeps,
falling ones upwards and rising ones downwards. A sweep is driven by a priority
queue: whatever it takes out puts the suffix one place further left back in, keyed
by its first letter, and with it the length of the prefix that it shares with the
suffix queued before it under that letter.

The queue keeps sorted runs, in files once they are large, and is read and filled
in blocks, in numpy. What entries of a block put back may belong in the same block;
it is added and the block sorted anew until it holds all it receives. Where that
takes too long, or prefixes are kept, a block ends before the first such entry.
"""

from __future__ import annotations

import tempfile
from dataclasses import dataclass

import numpy as np

BLOCK = 1 << 16
LEAST_BLOCK = 128
MAX_ROUNDS = 24
"""In which a block receives from itself."""
MAX_RUNS = 6
RESIDENT_ENTRIES = 1 << 20
"""Longer runs go to a file."""


class Scratch:
    """Files of one task, gone when it ends, however it ends."""

    def __init__(self) -> None:
        self.folder = tempfile.TemporaryDirectory(prefix="suffixes-")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.folder.cleanup()

    def keep(self, data: np.ndarray) -> np.ndarray:
        if data.size <= RESIDENT_ENTRIES:
            return data
        with tempfile.TemporaryFile(dir=self.folder.name) as file:
            data.tofile(file)
            file.flush()
            mapped = np.memmap(file, dtype=data.dtype, mode="r", shape=data.shape)
            return mapped.view(np.ndarray)


@dataclass
class Run:
    keys: np.ndarray
    places: np.ndarray
    shared: np.ndarray
    at: int = 0


class Queue:
    """(key, place, shared prefix) by key, equal keys in the order they came in."""

    def __init__(self, scratch: Scratch):
        self.scratch = scratch
        self.runs: list[Run] = []

    def push(self, keys: np.ndarray, places: np.ndarray, shared: np.ndarray) -> None:
        if keys.size:
            order = np.argsort(keys, kind="stable")
            self.runs.append(Run(keys[order], places[order], shared[order]))
            if len(self.runs) > MAX_RUNS:
                self._merge()

    def _merge(self) -> None:
        """Younger runs that are together no longer than the next older one join it."""
        while len(self.runs) > 1:
            last, before = self.runs[-1], self.runs[-2]
            small = len(self.runs) > MAX_RUNS // 2
            if not small and last.keys.size - last.at < before.keys.size - before.at:
                return
            keys = np.concatenate([before.keys[before.at :], last.keys[last.at :]])
            order = np.argsort(keys, kind="stable")
            self.runs[-2:] = [
                Run(
                    self.scratch.keep(keys[order]),
                    self.scratch.keep(
                        np.concatenate(
                            [before.places[before.at :], last.places[last.at :]]
                        )[order]
                    ),
                    self.scratch.keep(
                        np.concatenate(
                            [before.shared[before.at :], last.shared[last.at :]]
                        )[order]
                    ),
                )
            ]

    def head(self, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All entries of the lowest keys, `block` of them or those of one key."""
        self.runs = [r for r in self.runs if r.at < r.keys.size]
        if not self.runs:
            return (np.empty(0, np.int64),) * 3
        first = np.concatenate([r.keys[r.at : r.at + block] for r in self.runs])
        if first.size > block:
            bound = np.partition(first, block - 1)[block - 1]
            lowest = first.min()
            # Entries of the bound may go on behind what was looked at.
            bound = bound if bound == lowest else bound - 1
        else:
            bound = first.max()
        ends = [int(np.searchsorted(r.keys, bound, "right")) for r in self.runs]
        parts = [(r, r.at, e) for r, e in zip(self.runs, ends) if e > r.at]
        keys = np.concatenate([r.keys[a:e] for r, a, e in parts])
        order = np.argsort(keys, kind="stable")
        return (
            keys[order],
            np.concatenate([r.places[a:e] for r, a, e in parts])[order],
            np.concatenate([r.shared[a:e] for r, a, e in parts])[order],
        )

    def drop(self, below: int) -> None:
        """Forget entries with keys below."""
        for r in self.runs:
            r.at = max(r.at, int(np.searchsorted(r.keys, below, "left")))


def _range_minima(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """min(values[start:end]) for each pair, start < end."""
    length = end - start
    level = np.frexp(length)[1] - 1
    found = np.empty(length.size, dtype=values.dtype)
    table, width = values, 1
    for k in range(int(level.max()) + 1 if level.size else 0):
        (at,) = np.nonzero(level == k)
        found[at] = np.minimum(table[start[at]], table[end[at] - width])
        if table.size > width:
            table = np.minimum(table[:-width], table[width:])
        width *= 2
    return found


def in_fours(text: np.ndarray) -> np.ndarray:
    """The four letters from each place on, 16 bits each, zeros behind the end."""
    padded = np.r_[text, 0, 0, 0].astype(np.uint64)
    found = padded[: text.size].copy()
    for k in (1, 2, 3):
        found |= padded[k : k + text.size] << np.uint64(16 * k)
    return found


def common_prefix(fours: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, at most `cap`.

    They differ, and the text ends with its only 0, so none is compared beyond it.
    """
    found = np.full(a.size, cap, dtype=np.int64)
    at = np.arange(a.size)
    for length in range(0, cap, 4):
        differs = fours[a + length] ^ fours[b + length]
        more = differs == 0
        ended, differs = at[~more], differs[~more]
        found[ended] = length
        for bits in (16, 32, 48):
            found[ended] += differs & np.uint64((1 << bits) - 1) == 0
        at, a, b = at[more], a[more], b[more]
        if not at.size:
            break
    return np.minimum(found, cap)


def _equal_before(text: np.ndarray) -> np.ndarray:
    """How many letters directly before each place are the same as its own."""
    at = np.arange(text.size)
    fresh = np.r_[True, text[1:] != text[:-1]]
    return at - np.maximum.accumulate(np.where(fresh, at, 0))


def _with_received(
    text: np.ndarray,
    wanted: np.ndarray,
    equal_before: np.ndarray,
    keys: np.ndarray,
    places: np.ndarray,
) -> tuple[np.ndarray, np.ndarray] | None:
    """A block and what it receives from itself, in order; None if that is too much.

    Under a key come first the entries that were there, then those received from
    lower keys in the order of their senders, then what these send to their own key,
    one letter further left in a run of it each time. The order of senders is right
    for one more link of every chain each time the block is sorted.
    """
    last = int(keys[-1])
    rows: list[tuple[np.ndarray, ...]] = []
    new, to, senders, total = places, keys, np.arange(-keys.size, 0), 0
    while True:
        run = np.where(wanted[new], equal_before[new], 0)
        ends = np.cumsum(run + 1)
        if len(rows) == MAX_ROUNDS or total + int(ends[-1]) > 4 * BLOCK:
            return None
        step = np.arange(ends[-1]) - np.repeat(ends - run - 1, run + 1)
        rows.append(
            (
                np.repeat(to, run + 1),
                np.repeat(new, run + 1) - step,
                step,
                np.repeat(senders, run + 1),
            )
        )
        left = new - run - 1
        (at,) = np.nonzero((left >= 0) & wanted[np.maximum(left, 0)])
        to = 2 * text[left[at]].astype(np.int64)
        inside = to <= last
        at, to = at[inside], to[inside]
        if not at.size:
            break
        senders, new = total + ends[at] - 1, left[at]
        total += int(ends[-1])
    keys, places, step, senders = (np.concatenate(x) for x in zip(*rows))
    there = senders < 0
    rank = np.empty(keys.size, dtype=np.int64)
    order = np.lexsort((step, keys))
    while True:
        rank[order] = np.arange(keys.size)
        tie = np.where(there, senders, rank[np.maximum(senders, 0)])
        now = np.lexsort((tie, step, keys))
        if np.array_equal(now, order):
            return keys[order], places[order]
        order = now


def induce(
    text: np.ndarray,
    letters: int,
    wanted: np.ndarray,
    seeds: np.ndarray,
    seed_shared: np.ndarray | None,
    cap: int,
    scratch: Scratch,
) -> tuple[np.ndarray, np.ndarray]:
    """Order of `seeds` and of all suffixes of the `wanted` type that they induce.

    Goes upwards by letter; under a letter induced suffixes come before seeds. The
    second result is the prefix shared with the suffix before; without
    `seed_shared` it is not kept.
    """
    queue = Queue(scratch)
    sharing = seed_shared is not None
    shared = seed_shared if sharing else np.zeros(seeds.size, dtype=np.int16)
    queue.push(2 * text[seeds].astype(np.int64) + 1, seeds, shared)
    since = np.full(letters if sharing else 0, cap, dtype=np.int16)
    queued = np.zeros(letters if sharing else 0, dtype=bool)
    order, prefixes = [], []
    before_key, before_place = -1, -1
    block = BLOCK
    fours = in_fours(text) if sharing else None
    equal_before = None if sharing else _equal_before(text)
    while True:
        keys, places, shared = queue.head(block)
        if not keys.size:
            break
        end = int(keys[-1])
        if not sharing and (whole := _with_received(text, wanted, equal_before, keys, places)):
            keys, places = whole
            left = places - 1
            (from_,) = np.nonzero((left >= 0) & wanted[np.maximum(left, 0)])
            to = 2 * text[left[from_]].astype(np.int64)
            beyond = to > end
            queue.drop(end + 1)
            queue.push(to[beyond], left[from_[beyond]], np.zeros(int(beyond.sum()), np.int16))
            order.append(places)
            block = min(BLOCK, 2 * block)
            continue
        left = places - 1
        sends = (left >= 0) & wanted[np.maximum(left, 0)]
        to = np.where(sends, 2 * text[np.maximum(left, 0)].astype(np.int64), -1)
        # What is put back must not belong before an entry taken out with it.
        caught = to[sends & (to <= keys[-1])]
        if caught.size:
            limit = max(int(caught.min()), int(keys[0]) + 1)
            n = int(np.searchsorted(keys, limit, "left"))
            keys, places, shared = keys[:n], places[:n], shared[:n]
            left, sends, to = left[:n], sends[:n], to[:n]
        # Twice as many next time as could be used this time.
        block = min(BLOCK, max(LEAST_BLOCK, 2 * keys.size))
        queue.drop(int(keys[-1]) + 1)
        order.append(places)
        (from_,) = np.nonzero(sends)
        to = to[from_]
        if sharing:
            shared = np.array(shared, dtype=np.int16)
            previous = np.r_[before_key, keys[:-1]]
            fresh = previous != keys
            # Under one letter the last induced suffix meets the first seed.
            meet = np.nonzero(fresh & (previous >> 1 == keys >> 1) & (keys & 1 == 1))[0]
            prior = np.r_[before_place, places[:-1]]
            shared[fresh] = 0
            if meet.size:
                shared[meet] = common_prefix(fours, places[meet], prior[meet], cap)
            prefixes.append(shared)
            letter = to >> 1
            by = np.argsort(letter, kind="stable")
            letter, at = letter[by], from_[by]
            first = np.r_[True, letter[1:] != letter[:-1]] if at.size else np.empty(0, bool)
            start = np.where(first, 0, np.r_[0, at[:-1] + 1][: at.size])
            least = _range_minima(shared, start, at + 1)
            least = np.where(first, np.minimum(least, since[letter]), least)
            gained = np.minimum(least.astype(np.int64) + 1, cap)
            gained[first & ~queued[letter]] = 0
            tail = np.minimum.accumulate(shared[::-1])[::-1]
            np.minimum(since, tail[0], out=since)
            final = np.r_[first[1:], True] if at.size else first
            after = np.r_[tail, cap][at[final] + 1]
            since[letter[final]] = after
            queued[letter] = True
            queue.push(to[by], left[at], gained.astype(np.int16))
            before_place = int(places[-1])
        else:
            queue.push(to, left[from_], np.zeros(to.size, dtype=np.int16))
        before_key = int(keys[-1])
    return (
        np.concatenate(order) if order else seeds,
        np.concatenate(prefixes) if sharing and prefixes else np.empty(0, np.int16),
    )


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next; the last place counts so."""
    n = text.size
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1])
    step[-1] = 1
    decides = np.where(step != 0, np.arange(n), n)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    return step[decides] > 0


def _seed_places(rising: np.ndarray) -> np.ndarray:
    return np.nonzero(rising[1:] & ~rising[:-1])[0] + 1


def _sweeps(text, letters, rising, seeds, shared, cap, scratch):
    """All suffixes in order, and the prefix each shares with the one before."""
    falling, down = induce(text, letters, ~rising, seeds, shared, cap, scratch)
    keep = ~rising[falling]
    if shared is not None:
        # Over the seeds left out, neighbours share the least of what lies between.
        marks = np.nonzero(keep)[0]
        begin = np.r_[0, marks[:-1] + 1]
        down = _range_minima(down, begin[: marks.size], marks + 1)
    falling = falling[keep]
    # Downwards: letters mirrored, and what a suffix shares with the next below.
    mirrored = (letters - 1 - text).astype(text.dtype)
    below = None
    if shared is not None:
        below = np.r_[0, down[::-1][:-1]].astype(np.int16) if down.size else down
    order, up = induce(
        mirrored, letters, rising, falling[::-1], below, cap, scratch
    )
    order = np.r_[text.size - 1, order[::-1]]
    if shared is None:
        return order, None
    # `up` is shared with the one above in this order; shift it to the one before.
    prefixes = np.zeros(order.size, dtype=np.int16)
    prefixes[2:] = up[::-1][:-1]
    return order, prefixes


def _sorted_seeds(text, letters, rising, scratch) -> np.ndarray:
    seeds = _seed_places(rising)
    if seeds.size < 2:
        return seeds
    rough = seeds[np.argsort(text[seeds], kind="stable")]
    order, _ = _sweeps(text, letters, rising, rough, None, 0, scratch)
    is_seed = np.zeros(text.size, dtype=bool)
    is_seed[seeds] = True
    order = order[is_seed[order]]
    length = np.zeros(text.size, dtype=np.int64)
    length[seeds] = np.r_[np.diff(seeds) + 1, 1]
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    (at,) = np.nonzero(same)
    for step in range(int(length[a[at]].max()) if at.size else 0):
        at = at[length[a[at]] > step]
        if not at.size:
            break
        equal = text[a[at] + step] == text[b[at] + step]
        same[at[~equal]] = False
        at = at[equal]
    names = np.r_[0, np.cumsum(~same)]
    if names[-1] + 1 == seeds.size:
        return order
    named = np.zeros(text.size, dtype=np.int64)
    named[order] = names
    return seeds[suffix_order(named[seeds], int(names[-1]) + 1, scratch)]


def suffix_order(text: np.ndarray, letters: int, scratch: Scratch) -> np.ndarray:
    """Starts of all suffixes, sorted. `text` ends with its only 0."""
    if text.size == letters:
        return np.argsort(text, kind="stable")
    rising = _types(text)
    seeds = _sorted_seeds(text, letters, rising, scratch)
    return _sweeps(text, letters, rising, seeds, None, 0, scratch)[0]


def suffixes(
    text: np.ndarray, letters: int, cap: int, scratch: Scratch
) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all suffixes, sorted, and the prefix each shares with the one before.

    Prefixes count up to `cap`. `text` has letters below `letters` and ends with
    its only 0.
    """
    text = scratch.keep(text)
    rising = _types(text)
    seeds = _sorted_seeds(text, letters, rising, scratch)
    shared = np.zeros(seeds.size, dtype=np.int16)
    shared[1:] = common_prefix(in_fours(text), seeds[1:], seeds[:-1], cap)
    return _sweeps(text, letters, rising, seeds, shared, cap, scratch)
