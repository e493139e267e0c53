"""Spelling variants: all pairs of words one edit apart, by finite-state composition.

The vocabulary's minimised acceptor is composed with a transducer of one edit and with
the acceptor again; an accepted path of the composition is a pair of near words. Up to
the edit both sides read the same letters, so a path enters the transducer at a state
(p, p). The composition is dealt out by that: a pair whose longer word has M letters
and whose common beginning ends in the window lo..hi of places belongs to the partition
of its first lo and its last M - hi letters, which both words have. Each partition holds
the acceptor of what its words have between, and enumerates the pairs from its own
initial state. A pair has one M and one common beginning, so it is found once.

Windows are halves of a word; a partition with more than GROUP_WORDS words is halved
again, down to two places. With two places open a partition has at most the squared
number of letters of words, so no partition grows with the vocabulary.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import stored, table

# What a run of letters is, how many misspelled runs, what a word is.
LETTERS = "A-Za-zÀ-ÿ"
DELETED_IN = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_RATIO = 5

GROUP_WORDS = 20_000
HELD_WORDS = 300_000
PIECE_CHARS = 1 << 20


# -- vocabulary ----------------------------------------------------------------


def _runs(text: str) -> Iterator[list[str]]:
    """Runs of letters that are long enough, in lists of bounded size."""
    run = re.compile(f"[{LETTERS}]{{{LEAST_LETTERS},}}")
    gap = re.compile(f"[^{LETTERS}]")
    at = 0
    while at < len(text):
        end = gap.search(text, at + PIECE_CHARS)
        end = end.start() if end else len(text)
        # Only A-Z change when bytes are lower-cased.
        yield run.findall(text[at:end].encode("utf-8", "replace").lower().decode())
        at = end


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words and their counts; a task combines what it has read before it sends it."""
    held: dict[str, int] = {}

    def sent() -> pd.DataFrame:
        frame = pd.DataFrame({"word": list(held), "n": list(held.values())})
        held.clear()
        return frame.astype({"n": "int64"})

    for frame in frames:
        for doc, text in zip(frame["doc"], frame["text"], strict=True):
            prefix = zlib.crc32(f"{doc}:".encode())
            for runs in _runs(text):
                for word, n in Counter(runs).items():
                    h = zlib.crc32(word.encode(), prefix)
                    if h % DELETED_IN == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < LEAST_LETTERS:
                            continue
                    held[word] = held.get(word, 0) + n
            if len(held) > HELD_WORDS:
                yield sent()
    if held:
        yield sent()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of the words of whole texts that are long and common enough.

    Of every run whose crc32 with its doc_id is divisible by 199 a letter is deleted.
    NULL texts have no words; a NULL doc_id counts as an empty one. Repeated rows
    count as often as they stand there; no rows give no words.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text"
    )
    return (
        rows.where(F.col("text").isNotNull())
        .mapInPandas(_counted, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


# -- partitions of the composition ---------------------------------------------

PLACE = ["m", "lo", "hi", "left", "right"]


def _placed(entries: DataFrame) -> DataFrame:
    """`entries` with the letters that their window leaves on either side.

    A word stands in the partitions of pairs in which it is the longer or as long as
    the other (m is its length) and of those in which it is the shorter (one more).
    """
    size = F.char_length("word")
    return entries.withColumn(
        "left", F.substring("word", F.lit(1), F.col("lo"))
    ).withColumn(
        "right", F.substring("word", size - (F.col("m") - F.col("hi")) + 1, F.col("m") - F.col("hi"))
    )


def _halved(frame: DataFrame) -> DataFrame:
    middle = F.ceil((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("lo").alias("lo"), middle.alias("hi")),
        F.struct(middle.alias("lo"), F.col("hi").alias("hi")),
    )
    return frame.withColumn("half", F.explode(halves)).select(
        "word", "n", "m", "half.lo", "half.hi"
    )


def partitions(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """word, n, m, lo, hi, left, right: every word in every partition it belongs to."""
    size = F.char_length("word")
    whole = words.select(
        "word", "n", F.explode(F.array(size, size + 1)).alias("m")
    ).select("word", "n", "m", F.lit(0).alias("lo"), F.col("m").alias("hi"))
    entries, settled = _placed(_halved(whole)), []
    while True:
        crowded = stored(
            entries.groupBy(*PLACE).count().where(F.col("count") > group_words)
            .where("hi - lo > 2").drop("count"),
            "spelling",
        )
        if crowded.isEmpty():
            break
        settled.append(entries.join(crowded, PLACE, "left_anti"))
        entries = _placed(_halved(entries.join(crowded, PLACE, "left_semi")))
    for part in settled:
        entries = entries.unionByName(part)
    return entries


# -- acceptor and composition --------------------------------------------------


def acceptor(words: list[str]) -> tuple[list[tuple[bool, dict[str, int]]], int]:
    """States (final, arcs) of the minimal acceptor of sorted different words, and the first.

    Words are added one after the other; a state that no later word can change is
    looked up among those of equal ending and arcs and replaced by the one found.
    """
    states: list[tuple[bool, dict[str, int]]] = []
    register: dict[tuple, int] = {}
    path: list[list] = [[False, {}]]
    before = ""

    def fixed(final: bool, arcs: dict[str, int]) -> int:
        key = (final, tuple(arcs.items()))
        if key not in register:
            register[key] = len(states)
            states.append((final, arcs))
        return register[key]

    def shorten(depth: int) -> None:
        while len(path) > depth + 1:
            state = fixed(*path.pop())
            path[-1][1][before[len(path) - 1]] = state

    for word in words:
        shared = 0
        for a, b in zip(before, word):
            if a != b:
                break
            shared += 1
        shorten(shared)
        path.extend([False, {}] for _ in word[shared:])
        path[-1][0] = True
        before = word
    shorten(0)
    return states, fixed(*path[0])


class Composition:
    """Acceptor, one-edit transducer and acceptor: pairs of words one edit apart.

    Of its states (p, before, p) and (p, after, q), the first are the paths of the
    acceptor; from them a replaced letter leads to (p.a, after, p.b), with a < b, and
    an inserted one to (p, after, p.b). There the insertion may not be followed by
    its own letter on the left side: the letter would stand in a longer common
    beginning, and the pair would have two paths. `behind` is what follows all words,
    `width` the length of the longer words; pairs of two shorter ones belong elsewhere.
    """

    def __init__(self, words: list[str], width: int, behind: str = "") -> None:
        self.states, self.first = acceptor(words)
        self.width = width
        self.behind = behind[:1]
        self.met: dict[tuple[int, int], tuple[str, ...]] = {}

    def rests(self, p: int, q: int) -> tuple[str, ...]:
        """What both states accept; equal states are one and the same here."""
        key = (p, q) if p <= q else (q, p)
        found = self.met.get(key)
        if found is None:
            (end, arcs), (other_end, other_arcs) = self.states[p], self.states[q]
            out = [""] if end and other_end else []
            for letter, to in arcs.items():
                if letter in other_arcs:
                    out += [letter + r for r in self.rests(to, other_arcs[letter])]
            found = self.met[key] = tuple(out)
        return found

    def pairs(self) -> Iterator[tuple[str, str]]:
        ahead = [("", self.first)]
        while ahead:
            read, p = ahead.pop()
            arcs = list(self.states[p][1].items())
            for i, (b, q) in enumerate(arcs):
                ahead.append((read + b, q))
                for a, other in arcs[:i]:
                    for rest in self.rests(other, q):
                        if len(read) + 1 + len(rest) == self.width:
                            yield read + a + rest, read + b + rest
                for rest in self.rests(p, q):
                    if (rest or self.behind)[:1] != b:
                        yield read + rest, read + b + rest


def near_in(
    words: list[str], counts: list[int], width: int, left: str, right: str
) -> Iterator[tuple]:
    """word, its near words in this partition: how many, and the best one's n and text.

    words: the sorted middles; `left` and `right` stand around each.
    """
    n = dict(zip(words, counts, strict=True))
    found: dict[str, list] = {}
    for pair in Composition(words, width, right).pairs():
        for one, other in (pair, pair[::-1]):
            best = (-n[other], other + right)
            if one not in found:
                found[one] = [1, best]
            else:
                own = found[one]
                own[0] += 1
                own[1] = min(own[1], best)
    for word, (near, (least, best)) in found.items():
        yield left + word + right, near, -least, left + best


def _starts(frame: pd.DataFrame) -> np.ndarray:
    """Where the partitions of sorted rows start, and the end."""
    new = np.ones(len(frame), dtype=bool)
    new[1:] = False
    for c in PLACE:
        values = frame[c].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.nonzero(new)[0], len(frame))


def _solved(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
    """The near words of all partitions; one word alone has none."""
    out: list[tuple] = []
    for g in np.nonzero(np.diff(starts) > 1)[0]:
        part = slice(starts[g], starts[g + 1])
        words = frame["middle"].to_numpy()[part].tolist()
        # States are followed one call a letter.
        sys.setrecursionlimit(max(sys.getrecursionlimit(), max(map(len, words)) + 1_000))
        out += near_in(
            words,
            frame["n"].to_numpy()[part].tolist(),
            int(frame["hi"].iat[starts[g]] - frame["lo"].iat[starts[g]]),
            frame["left"].iat[starts[g]],
            frame["right"].iat[starts[g]],
        )
    return pd.DataFrame(out, columns=["word", "near", "best_n", "best"])


def _enumerated(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Solves partitions as they end; the last one of a batch may go on in the next."""
    rest = None
    for frame in frames:
        if not len(frame):
            continue
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        starts = _starts(frame)
        rest = frame.iloc[starts[-2] :].reset_index(drop=True)
        yield _solved(frame, starts[:-1])
    if rest is not None:
        yield _solved(rest, np.array([0, len(rest)]))


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """word, n_near, best_n, best of all words that have near ones.

    best is the near word of largest n, the least by code points of several.
    """
    size = F.char_length("word")
    middle = F.substring(
        "word", F.col("lo") + 1, size - F.col("lo") - (F.col("m") - F.col("hi"))
    )
    found = (
        partitions(words, group_words)
        .select(*PLACE, middle.alias("middle"), "n")
        .repartition(*PLACE)
        .sortWithinPartitions(*PLACE, "middle")
        .mapInPandas(_enumerated, "word string, near long, best_n long, best string")
    )
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best")))
    return (
        found.groupBy("word")
        .agg(F.sum("near").alias("n_near"), best.alias("b"))
        .select("word", "n_near", (-F.col("b.minus")).alias("best_n"), "b.best")
    )


# -- forms and roots -----------------------------------------------------------


def spelling_variants(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n for a vocabulary of different words.

    A form has at least FORM_RATIO times its word's n, so a chain of forms is no
    longer than the logarithm of the largest n; roots are found by following two
    steps, then four and so on, in as many rounds as that takes.
    """
    near = near_words(words, group_words)
    usual = F.col("best_n") >= FORM_RATIO * F.col("n")
    judged = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(usual, F.col("best")).alias("form"),
            F.when(usual, F.col("best_n")).alias("form_n"),
        ),
        "spelling",
    )
    with_form = judged.where("form IS NOT NULL")
    largest = with_form.agg(F.max("form_n")).first()[0] or 0
    steps = 0
    while FORM_RATIO ** (steps + 1) <= largest:
        steps += 1
    links = with_form.select("word", F.col("form").alias("root"))
    reached = 1
    while reached < steps:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stored(
            links.join(ahead, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root")
            ),
            "spelling",
        )
        reached *= 2
    return judged.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all documents with its usual form and the root of its forms."""
    words = stored(vocabulary(table(spark, sf_dir, "documents")), "vocabulary")
    return spelling_variants(words)
