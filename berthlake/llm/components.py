"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from berthlake.llm.storage import stored


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step on links (a > b), which may repeat."""
    both = links.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    # larger neighbours go to the smallest node around, and so does the node itself, by the link that it has to it
    large = both.join(lowest, "a").filter("b > a or b = m").select(F.greatest("a", "b").alias("a"), F.col("m").alias("b"))
    lowest = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(lowest, "a").select(F.when(F.col("b") > F.col("m"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("m").alias("b"))
    return small.distinct()


def _settled(links: DataFrame) -> bool:
    """Whether each node is either the smallest of its component or linked with that one alone."""
    ends = links.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("up")),
                                         F.struct(F.col("b").alias("node"), F.lit(None).cast(links.schema["b"].dataType).alias("up")))))
    nodes = ends.groupBy("node").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.bool_or(F.col("up").isNull()).alias("below"))
    return not nodes.agg(F.bool_or((F.col("low") != F.col("high")) | (F.col("low").isNotNull() & F.col("below")))).first()[0]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): each node with a link, and the smallest node that it can reach.

    Aggregates combine before each shuffle, so a node with very many links is no single task. A round is written to the
    shared folder; the rounds end when only stars are left, after about the logarithm of the longest chain. Links that are
    stars already take none.
    """
    now = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b")
    while not _settled(now):
        now = stored(_stars(now), "links")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots).distinct()
