"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of training texts. A
text is cut into blocks, every block is compressed with every dictionary, and the
language with the fewest bytes in sum wins. Blocks are short, so that what a
dictionary contributes does not fade as the compressor learns from the text
itself. Where the two best languages are close the text is rejected.

Only letters count: texts are lower-cased and everything between words becomes
one space, in training and prediction alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.llm.common import free_names, in_remainder, table

SAMPLE_DOCS = 400
"""Training texts taken for each language at most, those with the lowest hash."""

RANKS = 16
"""Windows that a language's hashes are ranked in before the last one."""

SAMPLE_CHARS = 1500
"""Characters that a training text gives to its dictionary at most."""

DICTIONARY_BYTES = 32 * 1024
"""Size of each dictionary."""

BLOCK_WORDS = 120
"""Words of a text that are compressed together, each different one once."""

GAIN = b" " * 64
"""Follows each block: it always compresses, so no block is stored as it is."""

MIN_MARGIN = 0.01
"""Rejected below this share of bytes saved by the best against the second best."""

SHARPNESS = 150.0
"""Of the score: how fast it rises with the margin."""

UNDETERMINED = "und"

LETTERS = regex.compile(r"\p{L}+")
PARAMETERS = {
    "window_log": 17,
    "hash_log": 16,
    "chain_log": 16,
    "search_log": 3,
    "min_match": 3,
    "target_length": 16,
    "strategy": zstandard.STRATEGY_GREEDY,
}


def letter_words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def dictionaries(training: DataFrame) -> dict[str, bytes]:
    """Raw content for each language, from columns text and lang.

    A bounded sample: SAMPLE_DOCS texts, SAMPLE_CHARS of each and DICTIONARY_BYTES
    a language. Rows without text or language teach nothing.
    """
    rows = training.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang",
        F.substring("text", 1, SAMPLE_CHARS).alias("text"),
        F.xxhash64("text").alias("pick"),
    )
    # Hashes first, so that copies of one text count once; texts meet the picks,
    # SAMPLE_DOCS a language, where they are, and only picked ones are shuffled.
    # Ranked by groups of tasks first: the last window gets RANKS * SAMPLE_DOCS rows.
    some = Window.partitionBy("lang", "group").orderBy("pick")
    lowest = Window.partitionBy("lang").orderBy("pick")
    picks = (
        rows.select("lang", "pick")
        .distinct()
        .withColumn("group", F.spark_partition_id() % RANKS)
        .withColumn("n", F.row_number().over(some))
        .where(F.col("n") <= SAMPLE_DOCS)
        .select("lang", "pick", F.row_number().over(lowest).alias("n"))
        .where(F.col("n") <= SAMPLE_DOCS)
    )
    sample = (
        rows.join(F.broadcast(picks), ["lang", "pick"])
        .dropDuplicates(["lang", "pick"])
        .select("lang", "n", "text")
        .toPandas()
        .sort_values(["lang", "n"])
    )
    found: dict[str, list[bytes]] = {}
    for lang, text in zip(sample["lang"], sample["text"]):
        part = " ".join(letter_words(text)).encode("utf-8", "replace")
        if part:
            found.setdefault(lang, []).append(part)
    return {
        lang: b" ".join(parts)[:DICTIONARY_BYTES].ljust(8)
        for lang, parts in found.items()
    }


class Compressors:
    def __init__(self, content: dict[str, bytes]):
        self.langs = sorted(content)
        self.each = []
        for lang in self.langs:
            made = zstandard.ZstdCompressionDict(
                content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            parameters = zstandard.ZstdCompressionParameters(
                write_content_size=False, write_dict_id=False, **PARAMETERS
            )
            made.precompute_compress(compression_params=parameters)
            self.each.append(
                zstandard.ZstdCompressor(
                    dict_data=made, compression_params=parameters
                )
            )

    def sizes(self, words: list[str]) -> tuple[np.ndarray, int]:
        """Compressed bytes by language, and bytes before."""
        total, before = np.zeros(len(self.each), dtype=np.int64), 0
        for start in range(0, len(words), BLOCK_WORDS):
            different = dict.fromkeys(words[start : start + BLOCK_WORDS])
            block = " ".join(different).encode("utf-8", "replace")
            before += len(block)
            block += GAIN
            total += [len(c.compress(block)) for c in self.each]
        return total, before

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, rejected. Equal sizes go to the first by name."""
        words = letter_words(text)
        if not words or not self.langs:
            return UNDETERMINED, 0.0, True
        sizes, before = self.sizes(words)
        best = int(np.argmin(sizes))
        if len(sizes) == 1:
            return self.langs[best], 1.0, False
        shares = (sizes - sizes[best]) / before
        margin = float(np.partition(shares, 1)[1])
        score = float(1 / np.exp(-SHARPNESS * shares).sum())
        return self.langs[best], score, margin < MIN_MARGIN


def identify(
    documents: DataFrame,
    content: dict[str, bytes],
    *,
    text_column: str = "text",
) -> DataFrame:
    """`documents` with lang_pred, lang_score (0 to 1) and lang_rejected.

    lang_pred is a language of `content`; `und`, with score 0 and rejected, for
    texts that are NULL or have no letter, or if `content` is empty. All columns
    and repeated rows stay; columns with these three names are replaced.
    """
    documents = documents.drop("lang_pred", "lang_score", "lang_rejected")
    (judged,) = free_names(documents, "judged")
    return documents.withColumn(judged, judgement(content, text_column)).withColumns(
        {
            "lang_pred": F.col(f"{judged}.lang"),
            "lang_score": F.col(f"{judged}.score"),
            "lang_rejected": F.col(f"{judged}.rejected"),
        }
    ).drop(judged)


def judgement(content: dict[str, bytes], text_column: str = "text") -> Column:
    """A struct of lang, score and rejected."""

    def judge(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compressors = Compressors(content)
        for texts in series:
            rows = [compressors.judge(t) for t in texts]
            yield pd.DataFrame(rows, columns=["lang", "score", "rejected"])

    judged = F.pandas_udf(judge, "lang string, score double, rejected boolean")
    return judged(F.col(text_column))


def held_out(id_column: str = "doc_id") -> Column:
    return in_remainder(id_column, 4, 2)


def learn(documents: DataFrame) -> dict[str, bytes]:
    """Dictionaries from the rows of `documents` that are not held out."""
    return dictionaries(documents.where(~held_out()).select("text", "lang"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    judged = identify(documents.select("doc_id", "text"), learn(documents))
    return judged.select(
        "doc_id",
        held_out().alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: documents whose language is told clearly stay, unchanged.

    NULL and empty texts and those without a letter have none and go; columns of
    any name, NULL ids and repeated rows stay as they are.
    """
    content = learn(table(spark, sf_dir, "documents"))
    (judged,) = free_names(docs, "judged")
    kept = docs.withColumn(judged, judgement(content)).where(~F.col(f"{judged}.rejected"))
    return kept.drop(judged)
