"""Change detection between consecutive snapshots of the same call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from berthlake.operators import skew

# (column, label) in order of precedence
BERTH_FIRST = [
    ("terminal_id", "terminal_change"),
    ("berth", "berth_change"),
    ("eta", "ETA_change"),
    ("etd", "ETD_change"),
    ("closing", "closing_change"),
    ("discharge", "discharge_change"),
    ("loading", "loading_change"),
    ("shift", "shift_change"),
]
TIME_FIRST = [
    ("eta", "ETA_change"),
    ("etd", "ETD_change"),
    ("closing", "closing_change"),
    ("berth", "berth_change"),
    ("discharge", "discharge_change"),
    ("loading", "loading_change"),
    ("shift", "shift_change"),
]


def change_type(previous_hash: Column, current_hash: Column) -> Column:
    return (
        F.when(previous_hash.isNull(), "NEW")
        .when(previous_hash != current_hash, "CHANGED")
        .otherwise("NO_CHANGE")
    )


def change_detail(
    previous: Column, causes: Sequence[tuple[str, str]], null_safe: bool = True
) -> Column:
    detail = F.when(previous["row_hash"].isNull(), "new_schedule")
    for name, label in causes:
        now, before = F.col(name), previous[name]
        differs = ~before.eqNullSafe(now) if null_safe else before != now
        detail = detail.when(differs, label)
    return detail.otherwise("else_change")


def tracked_columns(causes: Sequence[tuple[str, str]]) -> list[str]:
    return ["row_hash", "snapshot_id", "parsed_at", *[name for name, _ in causes]]


def change_history(
    df: DataFrame,
    key: str = "gold_key",
    order_by: Sequence[str] = ("snapshot_ts", "bronze_row_id"),
    causes: Sequence[tuple[str, str]] = tuple(BERTH_FIRST),
    null_safe: bool = True,
    keep: Sequence[str] = ("NEW", "CHANGED"),
    slice_by: Column | None = None,
    range_rows: int = skew.RANGE_ROWS,
) -> DataFrame:
    """Compare each row with the one before it of the same key and classify the difference.

    All previous values come from one ``lag`` over one struct: one exchange and one sort.
    """
    if slice_by is None:
        slice_by = F.unix_timestamp(order_by[0])
    columns = tracked_columns(causes)
    out = skew.previous_row(df, [key], order_by, columns, slice_by, range_rows)
    prev = F.col("_prev")
    out = out.withColumn("change_type", change_type(prev["row_hash"], F.col("row_hash")))
    if keep:
        out = out.filter(F.col("change_type").isin(*keep))
    out = out.withColumn("change_detail", change_detail(prev, causes, null_safe))
    for name in columns:
        out = out.withColumn(f"prev_{name}", prev[name])
    return (
        out.drop("_prev")
        .withColumnRenamed("snapshot_id", "current_snapshot_id")
        .withColumnRenamed("parsed_at", "current_parsed_at")
    )


def change_summary(changes: DataFrame) -> DataFrame:
    """Count per cause, with the earliest creation time."""
    return (
        changes.groupBy("change_detail")
        .agg(F.min("created_at").alias("created_at"), F.count("*").alias("change_count"))
        .orderBy("created_at", "change_detail")
    )


def change_type_summary(changes: DataFrame) -> DataFrame:
    return (
        changes.groupBy("change_type", "change_detail")
        .agg(F.count("*").alias("cnt"))
        .orderBy("change_type", F.desc("cnt"), "change_detail")
    )
