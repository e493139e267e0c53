"""License scans by diagonal voting, in DataFrame operations only.

Every pair of neighbouring words of a document is joined to the places where
license templates have that pair. A hit votes for the diagonal (place in the
document minus place in the template): a copied passage puts its votes on one
diagonal, and words inserted or left out move it to a neighbouring one.
Diagonals that lie close together are merged, and a merged span counts if it has
enough of the template's different places.

Votes are kept as a bit set of template places. A document that comes twice, or a
task that runs twice, sets the same bits again, so rows need no identity beyond
their id and two hashes of their text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrase, label. Each place counts.
BASE_PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: Opening words of public license notices, label. A part of them is enough.
NOTICES = [
    (
        "permission is hereby granted free of charge to any person obtaining a copy of"
        " this software and associated documentation files the software to deal in the"
        " software without restriction",
        "mit",
    ),
    (
        "licensed under the apache license version 2 0 the license you may not use this"
        " file except in compliance with the license",
        "apache",
    ),
    (
        "this program is free software you can redistribute it and or modify it under"
        " the terms of the gnu general public license",
        "gpl",
    ),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    (
        "under the terms of the gnu lesser general public license as published by the"
        " free software foundation",
        "lgpl",
    ),
    (
        "redistribution and use in source and binary forms with or without modification"
        " are permitted provided that the following conditions are met",
        "bsd",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v"
        " 2 0",
        "mpl",
    ),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under the apache license version 2 0", "apache-2"),
]

MERGE_GAP = 2
"""Diagonals at most this far apart belong to one span."""

LEAST_SHARE = 0.8
"""Share of a notice's word pairs that a span must have."""

MAX_TEMPLATE_WORDS = 63
"""Votes are bits of a long."""


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text; NULL has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, BETWEEN_WORDS), lambda w: w != "")


def word_pairs(words: Column) -> Column:
    """(hash, first, second) for every two neighbouring words.

    `words` must be a column of the frame: as an expression it would be computed
    again for each element.
    """
    pairs = F.transform(
        words,
        lambda w, i: F.struct(
            F.xxhash64(w, F.get(words, i + 1)).alias("hash"),
            w.alias("first"),
            F.get(words, i + 1).alias("second"),
        ),
    )
    return F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0)))


def template_places(
    spark: SparkSession,
    phrases: Sequence[tuple[str, str]],
    notices: Sequence[tuple[str, str]],
) -> DataFrame:
    """A row for each word pair of each template; as large as the lists given."""
    listed = [(t, label, True) for t, label in phrases]
    listed += [(t, label, False) for t, label in notices]
    for text, _, _ in listed:
        if not 2 <= len(text.split()) <= MAX_TEMPLATE_WORDS:
            raise ValueError(f"a template needs 2 to {MAX_TEMPLATE_WORDS} words: {text}")
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("template"),
                F.lit(text).alias("template_text"),
                F.lit(label).alias("label"),
                F.lit(is_base).alias("is_base"),
            )
            for n, (text, label, is_base) in enumerate(listed)
        ]
    )
    templates = spark.range(1).select(F.inline(rows))
    return (
        templates.withColumn("words", words_of(F.col("template_text")))
        .select(
            "template", "label", "is_base", F.posexplode(word_pairs(F.col("words")))
        )
        .select(
            "template",
            "label",
            "is_base",
            F.col("pos").alias("place"),
            F.col("col.hash").alias("hash"),
            F.col("col.first").alias("first_of"),
            F.col("col.second").alias("second_of"),
        )
        .withColumn("pairs", F.count("*").over(Window.partitionBy("template")))
    )


def spans(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]],
    notices: Sequence[tuple[str, str]],
) -> DataFrame:
    """The verified spans: id, h1, h2, label, is_base, first, last (words), share.

    `docs` has id and text. h1 and h2 are hashes of the text.
    """
    places = template_places(docs.sparkSession, phrases, notices)
    hits = (
        docs.select(
            "id",
            F.xxhash64("text").alias("h1"),
            F.xxhash64(F.lit(1), "text").alias("h2"),
            words_of(F.col("text")).alias("words"),
        )
        .select("id", "h1", "h2", F.posexplode(word_pairs(F.col("words"))))
        .withColumn("hash", F.col("col.hash"))
        # As large as the template lists, not as the documents.
        .join(F.broadcast(places), "hash")
        .where("col.first = first_of AND col.second = second_of")
    )
    key = ["id", "h1", "h2", "template", "label", "is_base", "pairs"]
    diagonals = (
        hits.groupBy(*key, (F.col("pos") - F.col("place")).alias("diagonal"))
        .agg(
            F.bit_or(F.expr("shiftleft(1L, place)")).alias("votes"),
            F.min("pos").alias("first"),
            (F.max("pos") + 1).alias("last"),
        )
    )
    ordered = Window.partitionBy("id", "h1", "h2", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(ordered)
    # A phrase stands whole on one diagonal; the votes of a notice may lie on several.
    opens = F.col("is_base") | F.coalesce(gap > MERGE_GAP, F.lit(True))
    return (
        diagonals.withColumn("opens", opens.cast("long"))
        .withColumn("span", F.sum("opens").over(ordered))
        .groupBy(*key, "span")
        .agg(
            F.bit_or("votes").alias("votes"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        .withColumn("share", F.expr("bit_count(votes) / pairs"))
        .where(F.col("share") >= F.when(F.col("is_base"), 1.0).otherwise(LEAST_SHARE))
        .select("id", "h1", "h2", "label", "is_base", "first", "last", "share")
    )


def scan_licenses(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: Sequence[tuple[str, str]] = BASE_PHRASES,
    notices: Sequence[tuple[str, str]] = NOTICES,
) -> DataFrame:
    """One row per document with its places and labels.

    n_base counts the places where a phrase stands whole, first_word and
    last_word are their smallest and largest start. labels adds the notices
    found. score is 1 where a phrase stands, else the largest share of a
    notice, else 0. NULL and empty texts have no word and no label. Rows with a
    NULL id and repeated rows each keep their row. Other columns are ignored.
    """
    docs = documents.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text")
    )
    found = (
        spans(docs, phrases, notices)
        .groupBy("id", "h1", "h2")
        .agg(
            F.count_if("is_base").alias("n_base"),
            F.min(F.when(F.col("is_base"), F.col("first"))).alias("first_word"),
            F.max(F.when(F.col("is_base"), F.col("first"))).alias("last_word"),
            F.collect_set(F.when(F.col("is_base"), F.col("label"))).alias("base"),
            F.collect_set("label").alias("all"),
            F.max("share").alias("share"),
        )
        # A row without an id finds its own group by the text's hashes.
        .withColumnsRenamed({"id": "found_id", "h1": "found_h1", "h2": "found_h2"})
    )
    rows = docs.select(
        "id",
        F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit(1), "text").alias("h2"),
        F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
    )
    joined = rows.join(
        found,
        (F.col("h1") == F.col("found_h1"))
        & (F.col("h2") == F.col("found_h2"))
        & F.col("id").eqNullSafe(F.col("found_id")),
        "left",
    )
    as_text = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit(""))
    return joined.select(
        F.col("id").alias(id_column),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        as_text("base").alias("base_labels"),
        as_text("all").alias("labels"),
        F.coalesce("share", F.lit(0.0)).alias("score"),
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
