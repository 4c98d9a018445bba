"""Gold data products of the schedule and of the monthly container volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from berthlake.functions import text, time as bt
from berthlake.operators import changes, workload
from berthlake.operators.latest import latest_per_key

MEASURES = ["total_full", "total_empty", "import_full", "import_empty", "export_full",
            "export_empty", "import_transship_full", "import_transship_empty",
            "export_transship_full", "export_transship_empty"]


def snapshot_time(snapshot_id: Column | str = "snapshot_id") -> Column:
    """Time of a snapshot id; a yearly history id counts as the start of its year.

    As text, history ids ('hist_..') sort after live ones; as a time they come first.
    """
    c = F.col(snapshot_id) if isinstance(snapshot_id, str) else snapshot_id
    live = F.regexp_extract(c, r"_(\d{8})_\d{2}$", 1)
    hour = F.regexp_extract(c, r"_\d{8}_(\d{2})$", 1)
    year = F.regexp_extract(c, r"^hist_\d+_(\d{4})$", 1)
    return F.coalesce(
        bt.parse_ts(F.concat(live, F.lit(" "), hour, F.lit(":00"))),
        bt.parse_ts(F.concat(year, F.lit("-01-01"))),
    )


def integrated_schedule(silver: DataFrame) -> DataFrame:
    """Silver rows with safe casts, workload, durations and the cross-terminal key."""
    base = silver
    for c in ("parsed_at", "eta", "etd", "closing"):
        base = base.withColumn(c, F.col(c).try_cast("timestamp_ntz"))
    base = base.withColumn("eta_work_date", F.col("eta_work_date").try_cast("date"))
    if "snapshot_ts" not in base.columns:
        base = base.withColumn("snapshot_ts", snapshot_time())
    return base.select(
        "terminal_id", "berth", "vessel_name", "eta", "etd", "closing",
        F.to_date("eta").alias("eta_date"), "eta_work_date",
        "discharge", "loading", "shift",
        text.total_workload().alias("total_workload"),
        bt.hours_between("eta", "etd").alias("stay_hours"),
        bt.days_between("eta", "etd").alias("stay_days"),
        bt.hours_between("closing", "eta").alias("closing_to_eta_hours"),
        "business_key", "source_file_name", "row_hash", "snapshot_id", "snapshot_ts",
        "bronze_row_id", "parsed_at", "mother_vessel", "sun_vessel", "carrier", "route",
        "is_valid", "error_msg",
        text.gold_key().alias("gold_key"),
        text.gold_key_type().alias("gold_key_type"),
        F.current_timestamp().alias("created_at"),
    )


def schedule_change_history(integrated: DataFrame, **options) -> DataFrame:
    """NEW and CHANGED rows with the previous values and the cause."""
    return changes.change_history(integrated, **options)


def newest_first(*order: str) -> list[Column]:
    return [F.col(c).desc() for c in (order or ("snapshot_ts", "bronze_row_id"))]


def today_schedule(integrated: DataFrame, as_of, key: str = "gold_key") -> DataFrame:
    """Current row of each call of one working day. The date filter stays below the window."""
    day = integrated.filter(F.col("eta_work_date") == F.lit(as_of).cast("date"))
    current = latest_per_key(day, [key], newest_first())
    return current.withColumn("vessel_display_name", text.display_name()).orderBy(
        "terminal_id", "eta", key
    )


def hourly_terminal_workload(
    integrated: DataFrame, key: str = "gold_key", deduplicate: bool = True
) -> DataFrame:
    """Workload per terminal and hour, in this order, over the current rows (or over all snapshots)."""
    rows = latest_per_key(integrated, [key], newest_first()) if deduplicate else integrated
    valid = workload.valid_schedule(rows)
    return workload.hourly_workload(valid, key, key_is_unique=deduplicate)


def monthly_container(silver_monthly: DataFrame) -> DataFrame:
    """Numbers from the yearly text tables; rows whose month is no month (totals) drop out."""
    cleaned = silver_monthly.filter(F.col("month").rlike("^[0-9]{1,2}$")).select(
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        *[text.double_or_null(c).alias(c) for c in MEASURES],
    )
    in_range = cleaned.filter(F.col("month").between(1, 12))

    def total(*names: str) -> Column:
        parts = [F.coalesce(F.col(n), F.lit(0.0)) for n in names]
        out = parts[0]
        for p in parts[1:]:
            out = out + p
        return out

    return in_range.select(
        "year", "month", F.make_date("year", "month", F.lit(1)).alias("month_date"), *MEASURES,
        total("total_full", "total_empty").alias("total_container"),
        total("import_full", "import_empty").alias("import_total"),
        total("export_full", "export_empty").alias("export_total"),
        total("import_transship_full", "import_transship_empty",
              "export_transship_full", "export_transship_empty").alias("transship_total"),
        F.current_timestamp().alias("created_at"),
    )


def ml_features(monthly: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """Ratios, row lags, rolling means and growth rates of the monthly volume.

    The input has twelve rows per year and entity; ``entity`` spreads several series over tasks.
    """
    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) != 0, F.col(a) / F.col(b))

    base = monthly.select(
        *entity, "year", "month", "month_date", "total_container", "total_full", "total_empty",
        "import_total", "export_total", "transship_total",
        ratio("total_empty", "total_container").alias("empty_ratio"),
        ratio("transship_total", "total_container").alias("transship_ratio"),
        ratio("import_total", "export_total").alias("import_export_ratio"),
    )
    w = Window.partitionBy(*(entity or [F.lit(0)])).orderBy("month_date")
    volume = F.col("total_container")
    lagged = base.select(
        "*",
        F.lag(volume, 1).over(w).alias("prev_1month_total_container"),
        F.lag(volume, 12).over(w).alias("prev_12month_total_container"),
        F.avg(volume).over(w.rowsBetween(-2, 0)).alias("rolling_3month_avg_total_container"),
        F.avg(volume).over(w.rowsBetween(-5, 0)).alias("rolling_6month_avg_total_container"),
    )

    def growth(previous: str) -> Column:
        p = F.col(previous)
        return F.when(p != 0, (volume - p) / p)

    return lagged.select(
        "*",
        growth("prev_1month_total_container").alias("mom_growth_rate"),
        growth("prev_12month_total_container").alias("yoy_growth_rate"),
        F.current_timestamp().alias("created_at"),
    ).orderBy(*entity, "month_date")
