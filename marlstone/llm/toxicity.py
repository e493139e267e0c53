"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: words, and beginnings of words, hashed to
2 ** HASH_BITS numbers. The machine adds a weight for each term and, for each two
terms, the product of their factors: two terms that are harmless alone (a mild
insult, the mention of a group) can be toxic together, and the other way round.

It is fitted on a bounded sample of labelled rows (SAMPLE_ROWS), which is all that
the driver sees; scoring is a map over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import in_remainder, table

HASH_BITS = 22
PREFIX_CHARS = 5
SAMPLE_ROWS = 20_000
"""Labelled rows that the machine is fitted on at most, those with the lowest hash."""

MAX_TERMS = 8_192
"""Terms that get weights: those that tell the labels apart best in the sample."""

LEAST_TEXTS = 4
FACTORS = 6
EPOCHS = 12
BATCH = 128
RATE = 0.05
PENALTY = 1e-4
THRESHOLD = 0.7

WORDS = regex.compile(r"\p{L}+")
CACHED_WORDS = 400_000


class Terms:
    """Hashed terms of texts; remembers a bounded number of words."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def of_word(self, word: str) -> tuple[int, int]:
        found = self.known.get(word)
        if found is None:
            mask = (1 << HASH_BITS) - 1
            start = "^" + word[:PREFIX_CHARS]
            found = (
                xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace")) & mask,
                xxhash.xxh3_64_intdigest(start.encode("utf-8", "replace")) & mask,
            )
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def of_text(self, text: str | None) -> np.ndarray:
        """Sorted, each term once; none for NULL and empty texts."""
        if not text:
            return np.empty(0, dtype=np.int32)
        words = set(WORDS.findall(text.lower()))
        terms = {t for w in words for t in self.of_word(w)}
        return np.fromiter(sorted(terms), dtype=np.int32, count=len(terms))


@dataclass
class Machine:
    terms: np.ndarray  # sorted hashes that have weights
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def known(self, terms: np.ndarray) -> np.ndarray:
        """Places of those terms that have weights."""
        if not self.terms.size:
            return np.empty(0, dtype=np.int64)
        at = np.searchsorted(self.terms, terms).clip(max=self.terms.size - 1)
        return at[self.terms[at] == terms]

    def score(self, terms: np.ndarray) -> float:
        at = self.known(terms)
        v = self.factors[at]
        both = 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum())
        return float(_chance(self.bias + self.weights[at].sum() + both))


def _chance(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _telling(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Terms of enough texts, the MAX_TERMS with the largest chi-square, sorted."""
    every = np.concatenate(rows) if rows else np.empty(0, dtype=np.int32)
    toxic = np.concatenate([r for r, y in zip(rows, labels) if y] or [every[:0]])
    terms, n = np.unique(every, return_counts=True)
    known, hits = np.unique(toxic, return_counts=True)
    n_toxic = np.zeros(terms.size)
    n_toxic[np.searchsorted(terms, known)] = hits
    expected = n * labels.mean()
    telling = (n_toxic - expected) ** 2 / np.maximum(expected, 1e-9)
    keep = np.nonzero(n >= LEAST_TEXTS)[0]
    best = keep[np.argsort(-telling[keep], kind="stable")[:MAX_TERMS]]
    return np.sort(terms[best])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Machine:
    """By AdaGrad on the logistic loss; the same result for the same rows in order."""
    labels = np.asarray(labels, dtype=np.float64)
    rate = min(max(labels.mean() if labels.size else 0.0, 1e-3), 1 - 1e-3)
    random = np.random.default_rng(7)
    terms = _telling(rows, labels) if labels.size else np.empty(0, dtype=np.int32)
    made = Machine(
        terms,
        float(np.log(rate / (1 - rate))),
        np.zeros(terms.size),
        random.normal(0, 0.05, (terms.size, FACTORS)),
    )
    at_rows = [made.known(r) for r in rows]
    past_w = np.full(terms.size, 1e-3)
    past_v = np.full((terms.size, FACTORS), 1e-3)
    past_b = 1e-3
    for _ in range(EPOCHS):
        order = random.permutation(labels.size)
        for start in range(0, labels.size, BATCH):
            batch = order[start : start + BATCH]
            sizes = np.array([at_rows[i].size for i in batch])
            at = np.concatenate([at_rows[i] for i in batch])
            row = np.repeat(np.arange(batch.size), sizes)
            v = made.factors[at]
            total = np.stack(
                [np.bincount(row, v[:, f], batch.size) for f in range(FACTORS)], 1
            )
            squares = np.bincount(row, (v**2).sum(1), batch.size)
            linear = np.bincount(row, made.weights[at], batch.size)
            x = made.bias + linear + 0.5 * ((total**2).sum(1) - squares)
            error = (_chance(x) - labels[batch]) / batch.size
            used, place = np.unique(at, return_inverse=True)
            to_w = np.bincount(place, error[row], used.size)
            to_w += PENALTY * made.weights[used]
            each = error[row, None] * (total[row] - v)
            to_v = np.stack(
                [np.bincount(place, each[:, f], used.size) for f in range(FACTORS)], 1
            )
            to_v += PENALTY * made.factors[used]
            past_w[used] += to_w**2
            past_v[used] += to_v**2
            past_b += error.sum() ** 2
            made.weights[used] -= RATE * to_w / np.sqrt(past_w[used])
            made.factors[used] -= RATE * to_v / np.sqrt(past_v[used])
            made.bias -= RATE * error.sum() / np.sqrt(past_b)
    return made


def learn(
    documents: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS
) -> Machine:
    """A machine from `documents` (doc_id, text) and `labels` (doc_id, toxic).

    Fitted on `sample_rows` labelled rows at most. An id with several labels is
    toxic if one says so; NULL labels and ids are no labels.
    """
    picked = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("pick", F.xxhash64("doc_id"))
        .orderBy("pick", "doc_id")
        .limit(sample_rows)
    )
    # At most sample_rows ids and labels.
    wanted = F.broadcast(picked.select("doc_id", "toxic"))

    def terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = Terms()
        for frame in frames:
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "toxic": frame["toxic"],
                    "terms": [made.of_text(t).tobytes() for t in frame["text"]],
                }
            )

    sample = (
        documents.select("doc_id", "text")
        .join(wanted, "doc_id")
        .mapInPandas(terms, "doc_id long, toxic int, terms binary")
        .dropDuplicates(["doc_id"])
        .toPandas()
        .sort_values("doc_id")
    )
    rows = [np.frombuffer(t, dtype=np.int32) for t in sample["terms"]]
    return fit(rows, sample["toxic"].to_numpy())


def score_toxicity(
    documents: DataFrame, machine: Machine, *, text_column: str = "text"
) -> DataFrame:
    """`documents` with toxicity (0 to 1), of their whole texts.

    NULL and empty texts get the machine's bias as chance. Repeated rows and all
    other columns stay; a column toxicity is replaced.
    """
    documents = documents.drop("toxicity")

    @F.pandas_udf("double")
    def score(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = Terms()
        for texts in series:
            yield pd.Series([machine.score(terms.of_text(t)) for t in texts])

    return documents.withColumn("toxicity", score(F.col(text_column)))


def held_out(id_column: str = "doc_id") -> Column:
    return in_remainder(id_column, 3, 1)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    scored = score_toxicity(documents, learn(documents, labels))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )
