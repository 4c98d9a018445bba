"""Current row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]
) -> DataFrame:
    """Row number 1 per key.

    Spark plans a WindowGroupLimit below the exchange, so a task sends at most one row per key and
    a hot key costs no more than the number of map tasks.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def dedup_keep_last(
    df: DataFrame,
    keys: Sequence[str] = ("terminal_id", "berth", "vessel_name", "eta"),
    order_by: Sequence[str] = ("snapshot_id", "bronze_row_id"),
) -> DataFrame:
    """One row per vessel call: the one from the newest snapshot."""
    return latest_per_key(df, keys, [F.col(c).desc() for c in order_by])
