"""The feature panel of the forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from berthlake.functions import time as bt
from berthlake.operators import intervals, panel as pn, series


def feature_panel(
    calls: DataFrame,
    ratios: DataFrame,
    index: DataFrame,
    grain: str = "month",
    before_year: int = 2026,
    corrections: Sequence[pn.Correction] = pn.PARTIAL_MONTHS,
) -> DataFrame:
    """One row per terminal and period with the eleven model features.

    ``calls`` are training calls, ``ratios`` the monthly transshipment shares, ``index`` the dated index
    values. Two aggregations read the calls; all that follows works on the panel.
    """
    per_year = series.PER_YEAR[grain]
    occupancy = intervals.berth_occupancy(calls, grain)
    if grain == "month":
        occupancy = occupancy.withColumnRenamed("month", "period")
    else:
        occupancy = occupancy.withColumnRenamed("biweek", "period")
    ops = pn.scale_partial_periods(pn.terminal_ops(calls, grain), corrections)
    out = pn.join_occupancy(ops, occupancy)
    out = pn.impute_occupancy(out, occupancy, before_year)
    out = pn.join_transship(out, ratios)
    out = pn.join_index(out, series.index_change(series.monthly_index(index, grain)))
    out = out.withColumns(
        {
            "weight": series.season_weight(F.col("month")),
            "season_sin": bt.season_sin("period", per_year),
            "season_cos": bt.season_cos("period", per_year),
        }
    )
    return series.trend_features(out, grain)


def mixed_grain_panel(
    calls: DataFrame, ratios: DataFrame, index: DataFrame, biweek_terminals: Sequence[str] = ("terminal_3",),
    before_year: int = 2026, corrections: Sequence[pn.Correction] = pn.PARTIAL_MONTHS,
) -> DataFrame:
    """Monthly rows for most terminals, two-week rows for the named ones."""
    fine = F.col("terminal_id").isin(*biweek_terminals)
    monthly = feature_panel(calls.filter(~fine), ratios, index, "month", before_year, corrections)
    biweekly = feature_panel(calls.filter(fine), ratios, index, "biweek", before_year, ())
    return monthly.withColumn("grain", F.lit("month")).unionByName(
        biweekly.withColumn("grain", F.lit("biweek")), allowMissingColumns=True
    )
