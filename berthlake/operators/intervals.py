"""Merging overlapping stays, and berth occupancy from the merged stays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from berthlake.functions import time as bt
from berthlake.operators import skew


def interval_islands(
    df: DataFrame,
    groups: Sequence[str],
    start: str = "eta",
    end: str = "etd",
    range_rows: int = skew.RANGE_ROWS,
) -> DataFrame:
    """Union of the intervals per group as disjoint intervals, with the number of sources.

    A new island starts where the running maximum end is passed; islands are numbered by the running count of such
    starts. Both are prefix scans, so a group of any size is spread over tasks, and the last aggregate combines on the map side.
    """
    base = df.select(*groups, start, end)
    slice_by = F.unix_timestamp(start)
    starts = skew.range_starts(base, groups, slice_by, range_rows)
    base = skew.with_range(base, groups, slice_by, starts)
    order, cut = [start, end], bool(starts)
    base = skew.running(base, groups, order, F.col(end), "_reached", "max", inclusive=False, cut=cut)
    fresh = F.when(F.col(start) <= F.col("_reached"), 0).otherwise(1)
    base = skew.running(base, groups, order, fresh, "_island", "sum", inclusive=True, cut=cut)
    return base.groupBy(*groups, "_island").agg(
        F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("interval_count")
    ).drop("_island")


def berth_occupancy(
    calls: DataFrame,
    grain: str = "month",
    range_rows: int = skew.RANGE_ROWS,
) -> DataFrame:
    """Percentage of berth hours in use per terminal and period (the period of the departure).

    A whole stay counts for the period of its departure, so the value can exceed 100. Stays without a berth make one
    more berth, whose hours count as available and never as busy: nobody knows what they overlap.
    """
    period = "month" if grain == "month" else "biweek"
    groups = ["terminal_id", "year", period]
    stays = calls.withColumn("year", F.year("etd")).withColumn(
        period, F.month("etd") if grain == "month" else bt.biweek("etd")
    )
    islands = interval_islands(stays, [*groups, "berth"], range_rows=range_rows)
    per_berth = islands.groupBy(*groups, "berth").agg(
        F.sum(bt.seconds_between("eta", "etd")).alias("busy_seconds")
    )
    days = bt.days_in_month("year", period) if grain == "month" else F.lit(14)
    return per_berth.groupBy(*groups).agg(
        F.count("*").alias("berth_count"),
        F.sum(F.when(F.col("berth").isNotNull(), F.col("busy_seconds")).otherwise(0)).alias("busy_seconds"),
    ).select(
        *groups,
        (F.col("busy_seconds") / 3600 / (F.col("berth_count") * days * 24.0) * 100).alias(
            "berth_occupancy"
        ),
    )
