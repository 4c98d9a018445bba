"""Keeping the optimizer from inlining an expensive expression into each of its uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row, however often they are used later.

    Projections on top of each other are merged, so a lambda or parser used in several places (or
    inside another lambda) would run again for each use. An explode of a one-element array is not
    merged; all columns of one call go through the same one.
    """
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    out = df.select("*", F.explode(F.array(packed)).alias("_once"))
    return out.select(*df.columns, *[F.col(f"_once.{n}").alias(n) for n in columns])
