"""Row filters in front of the forecast features."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from berthlake import fixed_values as fv
from berthlake.functions import text
from berthlake.operators.latest import dedup_keep_last


class Exclusion(NamedTuple):
    """Calls of one terminal that are left out: a whole year, or all before a date."""

    terminal_id: str
    year: int | None = None
    before: str | None = None


class TrainingWindow(NamedTuple):
    first_year: int = 2022
    last_year: int = 2026
    last_month: int = 6
    exclusions: tuple[Exclusion, ...] = (
        Exclusion("terminal_6", year=2022),
        Exclusion("terminal_7", before="2025-07-01"),
    )


def filter_outlier_stays(df: DataFrame, non_negative: bool = True) -> DataFrame:
    """Dated calls with a stay below the limit; the forecast side has no lower limit."""
    hours = (F.unix_timestamp("etd") - F.unix_timestamp("eta")) / 3600
    keep = hours < fv.MAX_STAY_HOURS
    return df.filter(keep & (hours >= 0) if non_negative else keep)


def filter_excluded_names(df: DataFrame) -> DataFrame:
    return df.filter(~text.is_excluded_name("vessel_name"))


def filter_cancelled(df: DataFrame) -> DataFrame:
    return df.filter(~text.is_cancelled("status"))


def filter_training_window(df: DataFrame, window: TrainingWindow = TrainingWindow()) -> DataFrame:
    year, month = F.year("etd"), F.month("etd")
    out = df.filter(
        year.between(window.first_year, window.last_year - 1)
        | ((year == window.last_year) & (month <= window.last_month))
    )
    for rule in window.exclusions:
        hit = F.col("terminal_id") == rule.terminal_id
        if rule.year is not None:
            hit = hit & (F.year("etd") == rule.year)
        if rule.before is not None:
            hit = hit & (F.col("etd") < F.lit(rule.before).cast("timestamp_ntz"))
        out = out.filter(~hit)
    return out


def training_calls(
    df: DataFrame, window: TrainingWindow = TrainingWindow(), order_by: Sequence[str] = ("snapshot_id", "bronze_row_id")
) -> DataFrame:
    """Valid, deduplicated calls of the training window with ``volume`` = discharge + loading."""
    valid = df.filter(F.col("is_valid") & F.col("eta").isNotNull() & F.col("etd").isNotNull())
    # the name is part of the call key, so this filter may run before the shuffle of the dedup
    calls = dedup_keep_last(filter_excluded_names(valid), order_by=order_by)
    calls = calls.filter(F.col("stay_hours") < fv.MAX_STAY_HOURS)
    if "status" in calls.columns:
        calls = filter_cancelled(calls)
    return filter_training_window(calls, window).withColumn(
        "volume", F.coalesce("discharge", F.lit(0)) + F.coalesce("loading", F.lit(0))
    )
