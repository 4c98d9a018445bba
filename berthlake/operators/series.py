"""Time-series operators on (terminal, period) panels.

A panel has one row per terminal and period, so a terminal's window holds at most twelve or
twenty-six rows per year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from berthlake import fixed_values as fv
from berthlake.functions import text, time as bt

PER_YEAR = {"month": 12, "biweek": 26}


def by_terminal(order: str = "idx") -> WindowSpec:
    return Window.partitionBy("terminal_id").orderBy(order)


def calendar_lag(value: Column, steps: int, window: WindowSpec) -> Column:
    """Value exactly ``steps`` periods back, null where that period has no row.

    A range frame on the period index: a look-up by calendar without a self join.
    """
    return F.first(value).over(window.rangeBetween(-steps, -steps))


def season_weight(month: Column) -> Column:
    return F.try_element_at(text.literal_map(fv.SEASON_WEIGHTS), month)


def clamp_trend(recent: Column, year_ago: Column) -> Column:
    ratio = F.greatest(F.lit(0.5), F.least(F.lit(2.0), recent / year_ago))
    return F.when(year_ago > 0, ratio).otherwise(1.0)


def forward_backward_fill(df: DataFrame, columns: Sequence[str], window: WindowSpec) -> DataFrame:
    """Last known value, else the next known one, within a terminal."""
    back = window.rowsBetween(Window.unboundedPreceding, 0)
    ahead = window.rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns(
        {
            c: F.coalesce(
                F.last(c, ignorenulls=True).over(back), F.first(c, ignorenulls=True).over(ahead)
            )
            for c in columns
        }
    )


def monthly_index(index: DataFrame, grain: str = "month") -> DataFrame:
    """Mean index per period."""
    period = F.month("index_date") if grain == "month" else bt.biweek("index_date")
    return index.groupBy("category", F.year("index_date").alias("year"), period.alias("period")).agg(
        F.avg("index_value").alias("index_raw")
    )


def index_change(monthly: DataFrame) -> DataFrame:
    """Percent change to the row before, zero on the first one."""
    w = Window.partitionBy("category").orderBy("year", "period")
    before = F.lag("index_raw").over(w)
    return monthly.withColumn(
        "index_mom", F.coalesce((F.col("index_raw") - before) / before * 100, F.lit(0.0))
    )


def seasonality_index(panel: DataFrame) -> DataFrame:
    """Mean of a month over the overall mean."""
    months = panel.groupBy("month").agg(F.sum("volume").alias("s"), F.count("volume").alias("n"))
    overall = Window.partitionBy()  # twelve rows
    return months.select(
        "month",
        (F.col("s") / F.col("n") / (F.sum("s").over(overall) / F.sum("n").over(overall))).alias("seasonality"),
    )


def trend_features(panel: DataFrame, grain: str = "month") -> DataFrame:
    """Year-over-year value, trend ratio, adjusted lag and the mean around the same period last year.

    Needs terminal_id, idx, period, month and volume; missing values of last year are the mean of the
    terminal times the seasonal weight.
    """
    per_year = PER_YEAR[grain]
    recent = 3 if grain == "month" else 6
    w = by_terminal()
    volume = F.col("volume").cast("double")
    mean = F.avg(volume).over(Window.partitionBy("terminal_id"))

    def default(shift: int) -> Column:
        if grain != "month":
            return F.col("_mean") * season_weight(F.col("month"))
        return F.col("_mean") * season_weight(bt.period_of_year(F.col("idx") + shift, 12))

    out = panel.withColumns(
        {
            "time_index": F.row_number().over(w),
            "_mean": mean,
            "_yoy": calendar_lag(volume, per_year, w),
            "_after": calendar_lag(volume, per_year - 1, w),
            "_before": calendar_lag(volume, per_year + 1, w),
        }
    )
    out = out.withColumn("yoy", F.coalesce("_yoy", default(0)))
    previous = w.rowsBetween(-recent, -1)
    trend = clamp_trend(F.avg(volume).over(previous), F.avg("yoy").over(previous))
    out = out.withColumn("trend_ratio", F.when(F.col("time_index") > recent, trend).otherwise(1.0))
    around = F.coalesce("_after", default(1)) + F.col("yoy") + F.coalesce("_before", default(-1))
    return out.withColumns(
        {"lag_adj": F.col("yoy") * F.col("trend_ratio"), "rolling_yoy": around / 3}
    ).drop("_mean", "_yoy", "_after", "_before")


def history_means(
    panel: DataFrame, columns: Sequence[str], before_year: int, keys: Sequence[str] = ("terminal_id", "period")
) -> DataFrame:
    """Mean per terminal and period of the year over the years before the cut-off."""
    return panel.filter(F.col("year") < before_year).groupBy(*keys).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns]
    )


def unpivot_features(panel: DataFrame, columns: Sequence[str]) -> DataFrame:
    doubles = panel.select("terminal_id", "idx", *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(["terminal_id", "idx"], list(columns), "feature", "value")


def fallback_values(
    panel: DataFrame, ratios: DataFrame, before_year: int, columns: Sequence[str] = tuple(fv.OPERATIONAL_FEATURES)
) -> DataFrame:
    """Per terminal and feature a map: period of the year -> mean before the cut-off.

    At most 26 entries per map. The transshipment share is a value of the port: its means come
    from the monthly ratios, by the month of the period.
    """
    own = [c for c in columns if c != "transship_ratio"]
    means = panel.filter(F.col("year") < before_year).groupBy("terminal_id", "period").agg(
        *[F.avg(c).alias(c) for c in own], F.min("month").alias("month")
    )
    share = ratios.filter(F.col("year") < before_year).groupBy("month").agg(
        F.avg("transship_ratio").alias("transship_ratio")
    )
    means = means.join(share, "month", "left").withColumn(
        "transship_ratio", F.coalesce("transship_ratio", F.try_element_at(text.literal_map(fv.TRANSSHIP_DEFAULTS), "month"))
    )
    long = means.unpivot(["terminal_id", "period"], list(columns), "feature", "mean")
    return long.filter("mean IS NOT NULL").groupBy("terminal_id", "feature").agg(
        F.map_from_entries(F.collect_list(F.struct("period", "mean"))).alias("fallback")
    )


def trend_adjusted_feature(
    long: DataFrame, fallbacks: DataFrame, per_year: int = 12, recent: int = 3
) -> DataFrame:
    """Last year's value times the clamped recent trend, per (terminal, feature, period).

    Periods without a row take the history mean of their period of the year, then a constant.
    """
    w = Window.partitionBy("terminal_id", "feature").orderBy("idx")
    last_resort = F.try_element_at(text.literal_map(fv.FEATURE_LAST_RESORT), F.col("feature"))
    rows = long.join(fallbacks, ["terminal_id", "feature"], "left")

    def value_at(back: int, step: int) -> Column:
        period = bt.period_of_year(F.col("idx") - step, per_year)
        return F.coalesce(
            calendar_lag(F.col("value"), back, w), F.try_element_at("fallback", period), last_resort
        )

    def mean_of(offset: int) -> Column:
        total = value_at(offset + 1, 1)
        for i in range(2, recent + 1):
            total = total + value_at(offset + i, i)
        return total / recent

    return rows.select(
        "terminal_id", "feature", "idx", "value",
        (value_at(per_year, 0) * clamp_trend(mean_of(0), mean_of(per_year))).alias("adjusted"),
    )
