"""Expected workload per terminal and hour, and the terminal summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from berthlake.functions import time as bt
from berthlake.functions.barrier import compute_once

RATES = {
    "estimated_hourly_workload": "total_workload",
    "estimated_hourly_discharge": "discharge",
    "estimated_hourly_loading": "loading",
    "estimated_hourly_shift": "shift",
}


def valid_schedule(df: DataFrame) -> DataFrame:
    """Checked behind a barrier: a filter is merged with what makes its columns and would make each of them once per use."""
    valid = (F.col("etd") > F.col("eta")) & (F.col("total_workload") > 0) & (F.col("stay_hours") > 0)
    return compute_once(df, _valid=valid).filter("_valid").drop("_valid")


def expand_hours(df: DataFrame) -> DataFrame:
    return df.withColumn("work_hour", F.explode(bt.hours_covered("eta", "etd")))


def by_day(df: DataFrame) -> DataFrame:
    """A row per day that [eta, etd] touches, with the first and the last clock hour it touches there, in place of eta and etd."""
    start, end, day = F.unix_date(F.to_date("eta")), F.unix_date(F.to_date("etd")), F.col("_day")
    return df.withColumn("_day", F.explode(F.sequence(start, end, F.lit(1)))).select(
        *[c for c in df.columns if c not in ("eta", "etd")],
        F.date_from_unix_date(day).alias("work_date"),
        F.when(day == start, F.hour("eta")).otherwise(0).alias("first"),
        F.when(day == end, F.hour("etd")).otherwise(23).alias("last"),
    )


def hours_of(df: DataFrame, name: str) -> DataFrame:
    """A row per terminal, day and value of ``name``; the bits of ``hours`` are the clock hours that its stays cover.

    A day has at most 24 of them, so a value is dealt out once per day and not once per hour.
    """
    days = by_day(df.filter(F.col(name).isNotNull()).select("terminal_id", name, "eta", "etd"))
    return days.groupBy("terminal_id", "work_date", name).agg(
        F.bit_or(F.expr("shiftleft(1, last + 1) - shiftleft(1, first)")).alias("hours"))


def vessels_per_hour(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys of a terminal and hour. Keys of a day that cover the same hours are counted before they are spread over them."""
    alike = hours_of(df, key).groupBy("terminal_id", "work_date", "hours").agg(F.count("*").alias("vessel_count"))
    covered = F.filter(F.sequence(F.lit(0), F.lit(23)), lambda h: F.getbit("hours", h) == 1)
    hours = alike.withColumn("_hour", F.explode(covered))
    return hours.select("terminal_id", bt.clock_hour("work_date", "_hour").alias("work_hour"), "vessel_count")


def hourly_amounts(df: DataFrame, key: str, key_is_unique: bool) -> DataFrame:
    """All of an hour but the names of its vessels: rows (terminal_id, work_hour, vessel_count, the rates, berth_list, latest_parsed_at).

    Stays are combined per day, first and last hour before they are spread over hours, so what is spread is bounded by the days
    and berths of a terminal and not by its stays. Where the input holds one row per key a plain count is the distinct count.
    """
    rated = df.select(
        "terminal_id", "eta", "etd", "berth", "parsed_at",
        *[(F.col(src) / F.col("stay_hours")).alias(name) for name, src in RATES.items()],
        F.lit(1 if key_is_unique else 0).alias("vessel_count"),
    )
    combined = by_day(rated).groupBy("terminal_id", "work_date", "first", "last", "berth").agg(
        *[F.sum(name).alias(name) for name in ("vessel_count", *RATES)], F.max("parsed_at").alias("parsed_at"))
    combined = combined.withColumn("eta", bt.clock_hour("work_date", "first")).withColumn(
        "etd", bt.clock_hour("work_date", "last"))
    hours = expand_hours(combined).drop("work_date", "first", "last", "eta", "etd")
    if not key_is_unique:
        hours = hours.unionByName(vessels_per_hour(df, key), allowMissingColumns=True)
    return hours.groupBy("terminal_id", "work_hour").agg(
        F.sum("vessel_count").alias("vessel_count"),
        *[F.round(F.sum(name), 2).alias(name) for name in RATES],
        F.array_sort(F.collect_set("berth")).alias("berth_list"),
        F.max("parsed_at").alias("latest_parsed_at"),
    )


def hourly_workload(df: DataFrame, key: str = "gold_key", key_is_unique: bool = True) -> DataFrame:
    """Spread the work of each call evenly over its stay and add it up per terminal and hour; rows come in this order.

    The vessels of an hour are looked up among those of its day, after both have met: no exchange carries a row per vessel
    and hour, and rows are ordered by day before the lists are made.
    """
    amounts = hourly_amounts(df, key, key_is_unique)
    amounts = amounts.select(
        "terminal_id", F.to_date("work_hour").alias("work_date"), F.struct(*amounts.columns[1:]).alias("hour"))
    named = F.struct(F.coalesce("vessel_name", F.lit("")).alias("vessel_name"), "hours")
    vessels = hours_of(df, "vessel_name").select("terminal_id", "work_date", named.alias("vessel"))
    # a fixed number: behind this exchange rows grow by the hours of a day, too much for partitions put together by their size before
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    days = (
        amounts.unionByName(vessels, allowMissingColumns=True)
        .repartitionByRange(parts, "terminal_id", "work_date")
        .groupBy("terminal_id", "work_date")
        .agg(F.sort_array(F.collect_list("hour")).alias("hours"), F.sort_array(F.collect_list("vessel")).alias("vessels"))
        .orderBy("terminal_id", "work_date")
    )
    clock = F.hour("hour.work_hour")
    there = F.filter("vessels", lambda v: F.getbit(v["hours"], F.col("work_hour_of_day")) == 1)
    return days.withColumn("hour", F.explode("hours")).withColumn("work_hour_of_day", clock).select(
        "terminal_id", "hour.work_hour", "hour.vessel_count", *[f"hour.{name}" for name in RATES], "hour.berth_list",
        there["vessel_name"].alias("vessel_list"), "hour.latest_parsed_at", "work_date", "work_hour_of_day",
    )


def arrivals_within(df: DataFrame, as_of, hours: int = 2) -> DataFrame:
    """Calls that arrive in [as_of, as_of + hours)."""
    start = F.lit(as_of).cast("timestamp_ntz")
    return df.filter(
        (F.col("eta") >= start) & (F.col("eta") < start + F.expr(f"INTERVAL {int(hours)} HOURS"))
    ).select("terminal_id", "berth", "vessel_name", "eta", "etd", "total_workload")


def terminal_vessel_count(df: DataFrame) -> DataFrame:
    return df.groupBy("terminal_id").agg(
        F.count("*").alias("vessel_count"), F.sum("total_workload").alias("total_workload")
    )


def terminal_status(df: DataFrame) -> DataFrame:
    return df.groupBy("terminal_id").agg(
        F.count("*").alias("vessel_count"),
        F.sum("total_workload").alias("total_workload"),
        F.sum("discharge").alias("total_discharge"),
        F.sum("loading").alias("total_loading"),
    )


def data_quality_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("terminal_id").agg(
        F.count("*").alias("row_count"),
        F.count_if("is_valid").alias("valid_count"),
        F.count_if(~F.col("is_valid")).alias("error_count"),
        F.count_if(F.col("eta").isNull()).alias("eta_missing"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("v")).filter("v is not null").distinct().orderBy("v")
