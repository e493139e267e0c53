"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import stored

MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); root is its component's least node.

    Alternates two steps that keep components as they are and shorten paths: every
    node hands its larger neighbours (large star), then its smaller ones (small
    star), to the least node it knows. Each round is written to the shared folder.
    No node's neighbours are gathered; the join that hands out least nodes can be
    split where a node has very many.
    """
    now = stored(
        edges.where("a <> b AND a IS NOT NULL AND b IS NOT NULL")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "components",
    )
    before = None
    for _ in range(MAX_ROUNDS):
        state = now.agg(
            F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))
        ).first()
        if state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.withColumn("m", F.least("a", "m"))
        large = (
            both.join(least, "a")
            .where("b > a AND b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        # a's smaller neighbours, all larger than b after the step above
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        handed = (
            large.join(small, "a")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        )
        now = stored(
            handed.unionByName(small.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct(),
            "components",
        )
    else:
        raise RuntimeError("components do not settle")
    return (
        now.groupBy("a")
        .agg(F.min("b").alias("root"))
        .select(F.col("a").alias("node"), "root")
        .unionByName(
            now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
        )
    )
