"""Aggregates per terminal and period, and the joins that complete the panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from berthlake import fixed_values as fv
from berthlake.functions import text, time as bt
from berthlake.operators.series import PER_YEAR, by_terminal, forward_backward_fill

Correction = tuple[str, int, int, float]  # terminal, year, period, factor
PARTIAL_MONTHS: tuple[Correction, ...] = (("terminal_1", 2026, 6, 1.25),)


def terminal_ops(calls: DataFrame, grain: str = "month") -> DataFrame:
    """Volume, shifts, named vessels, mean stay, carriers and routes per terminal and period.

    First summed per carrier and route (a hot terminal spreads over those keys, and the map side
    combines), then rolled up; the distinct counts run over the small result of the first step.
    """
    period = F.month("etd") if grain == "month" else bt.biweek("etd")
    fine = calls.groupBy(
        "terminal_id", F.year("etd").alias("year"), period.alias("period"), F.month("etd").alias("m"),
        "carrier", "route",
    ).agg(
        F.sum("volume").alias("volume"),
        F.sum(F.coalesce("shift", F.lit(0))).alias("shift_count"),
        F.count("vessel_name").alias("vessel_count"),
        F.sum("stay_hours").alias("stay_sum"),
        F.count("stay_hours").alias("stay_n"),
        F.count("*").alias("n"),
    )
    median = F.percentile("m", F.lit(0.5), F.col("n")).cast("int")
    month = F.max("m") if grain == "month" else median
    out = fine.groupBy("terminal_id", "year", "period").agg(
        F.sum("volume").alias("volume"),
        F.sum("shift_count").alias("shift_count"),
        F.sum("vessel_count").alias("vessel_count"),
        (F.sum("stay_sum") / F.sum("stay_n")).alias("avg_dwell"),
        F.greatest(F.count_distinct("carrier"), F.lit(1)).alias("carrier_count"),
        F.greatest(F.count_distinct("route"), F.lit(1)).alias("route_count"),
        month.alias("month"),
    )
    ratio = F.when(F.col("volume") != 0, F.col("shift_count") / F.col("volume") * 100).otherwise(0.0)
    return out.withColumns(
        {"shift_ratio": ratio, "idx": bt.period_index("year", "period", PER_YEAR[grain])}
    )


def scale_partial_periods(ops: DataFrame, corrections: Sequence[Correction] = PARTIAL_MONTHS) -> DataFrame:
    """Scale volume and vessel count of periods with incomplete data (a short constant list)."""
    factor = F.lit(1.0)
    for terminal, year, period, value in corrections:
        hit = (F.col("terminal_id") == terminal) & (F.col("year") == year) & (F.col("period") == period)
        factor = F.when(hit, value).otherwise(factor)
    return ops.withColumns(
        {"volume": F.col("volume") * factor, "vessel_count": F.bround(F.col("vessel_count") * factor)}
    )


def transship_ratio(monthly: DataFrame) -> DataFrame:
    """Transshipment share of import + export + transshipment, in percent; zero without volume."""
    parts = [F.coalesce(F.col(c), F.lit(0.0)) for c in ("import_total", "export_total", "transship_total")]
    whole = parts[0] + parts[1] + parts[2]
    return monthly.select(
        "year", "month", F.when(whole > 0, parts[2] / whole * 100).otherwise(0.0).alias("transship_ratio")
    )


def join_occupancy(ops: DataFrame, occupancy: DataFrame) -> DataFrame:
    return ops.join(occupancy, ["terminal_id", "year", "period"], "left")


def impute_occupancy(panel: DataFrame, occupancy: DataFrame, before_year: int) -> DataFrame:
    """Missing occupancy: history mean of the terminal and period, then a constant."""
    means = occupancy.filter(F.col("year") < before_year).groupBy("terminal_id", "period").agg(
        F.avg("berth_occupancy").alias("_mean")
    )
    return panel.join(means, ["terminal_id", "period"], "left").withColumn(
        "berth_occupancy", F.coalesce("berth_occupancy", "_mean", F.lit(fv.OCCUPANCY_LAST_RESORT))
    ).drop("_mean")


def join_transship(panel: DataFrame, ratios: DataFrame) -> DataFrame:
    """Actual share of the month, else the constant of the month."""
    default = F.try_element_at(text.literal_map(fv.TRANSSHIP_DEFAULTS), F.col("month"))
    return panel.join(ratios, ["year", "month"], "left").withColumn(
        "transship_ratio", F.coalesce("transship_ratio", default, F.lit(fv.TRANSSHIP_LAST_RESORT))
    )


def join_index(panel: DataFrame, index: DataFrame) -> DataFrame:
    """Freight index of the period; gaps filled forward, then backward, within a terminal."""
    values = index.select("year", "period", "index_raw", "index_mom")
    joined = panel.join(values, ["year", "period"], "left")
    return forward_backward_fill(joined, ["index_raw", "index_mom"], by_terminal())


def rollup_biweek_to_month(df: DataFrame, value: str = "volume", keys: Sequence[str] = ("terminal_id", "year")) -> DataFrame:
    month = F.try_element_at(text.literal_map(fv.BIWEEK_TO_MONTH), F.col("period"))
    return df.groupBy(*keys, month.alias("month")).agg(F.sum(value).alias(value))


def forecast_annual_summary(actual: DataFrame, forecast: DataFrame, base_year: int) -> DataFrame:
    """Actual part of the base year, its forecast part, both together, and the year after."""
    done = actual.filter(F.col("year") == base_year).groupBy("terminal_id").agg(
        F.sum("volume").cast("bigint").alias("actual_volume")
    )
    part = lambda y: F.sum(F.when(F.col("year") == y, F.col("volume")).otherwise(0))
    ahead = forecast.groupBy("terminal_id", "scenario").agg(
        part(base_year).cast("bigint").alias("forecast_volume"),
        part(base_year + 1).cast("bigint").alias("next_year_volume"),
    )
    return ahead.join(done, "terminal_id", "left").select(
        "terminal_id", "scenario", "actual_volume", "forecast_volume",
        (F.coalesce("actual_volume", F.lit(0)) + F.col("forecast_volume")).alias("base_year_volume"),
        "next_year_volume",
    )


def regression_metrics(df: DataFrame, actual: str = "volume", predicted: str = "predicted") -> DataFrame:
    """R2 and MAE per terminal; R2 is null where the actual values do not vary."""
    error = F.col(actual) - F.col(predicted)
    sums = df.groupBy("terminal_id").agg(
        F.sum(error * error).alias("ss_res"),
        (F.var_pop(actual) * F.count(actual)).alias("ss_tot"),
        F.avg(F.abs(error)).alias("mae"),
        F.count("*").alias("n"),
    )
    return sums.select(
        "terminal_id", "n", F.when(F.col("ss_tot") > 0, 1 - F.col("ss_res") / F.col("ss_tot")).alias("r2"), "mae"
    )
