"""Documents to training sequences, in stages; each reads what the one before wrote.

Language ID, near duplicates, repeated strings, benchmark leaks, packing. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import (
    decontamination,
    language_id,
    near_duplicates,
    packing,
    suffix_dedup,
)
from marlstone.llm.common import stored, table

STAGES = [
    ("language_id", language_id.stage),
    ("near_duplicates", near_duplicates.stage),
    ("suffix_dedup", suffix_dedup.stage),
    ("decontamination", decontamination.stage),
    ("packing", packing.stage),
]

#: Compression, MinHash, suffix order and tokens have no SQL; tests compare the
#: stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all kept documents and their places in sequences."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
