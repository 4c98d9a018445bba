"""Schedule side: integrated schedule, changes, current rows, hourly workload, views."""

from __future__ import annotations

from pyspark.sql import functions as F

from berthlake import testbed as tb
from berthlake.operators import changes, intervals, workload
from berthlake.operators.latest import dedup_keep_last, latest_per_key
from berthlake.plans import gold
from berthlake.registry import query

AS_OF = "2024-01-10"
AS_OF_TIME = "2024-01-10 06:30:00"


def integrated(spark, sf):
    return gold.integrated_schedule(tb.silver_schedule(spark, sf))


@query("scan_schedule", f"""WITH {tb.SILVER_SQL}
SELECT terminal_id, terminal_name, berth, vessel_name, eta, etd, row_hash, business_key FROM silver""")
def scan_schedule(spark, sf):
    return tb.silver_schedule(spark, sf).select(
        "terminal_id", "terminal_name", "berth", "vessel_name", "eta", "etd", "row_hash", "business_key")


GOLD_COLUMNS = [
    "terminal_id", "berth", "vessel_name", "eta", "etd", "closing", "eta_date", "eta_work_date", "discharge",
    "loading", "shift", "total_workload", "stay_hours", "stay_days", "closing_to_eta_hours", "business_key",
    "source_file_name", "row_hash", "snapshot_id", "bronze_row_id", "parsed_at", "mother_vessel", "sun_vessel",
    "carrier", "route", "is_valid", "error_msg", "gold_key", "gold_key_type"]
GOLD_SELECT = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c in ("eta_date", "eta_work_date") else c for c in GOLD_COLUMNS)


@query("gold_integrated_schedule", f"WITH {tb.INTEGRATED_SQL} SELECT {GOLD_SELECT} FROM gold")
def gold_integrated_schedule(spark, sf):
    return integrated(spark, sf).select(*GOLD_COLUMNS)


def change_sql(key, causes, null_safe, columns):
    lags = ", ".join(
        f"lag({c}) OVER w AS prev_{c}" for c in changes.tracked_columns(causes))
    op = "IS DISTINCT FROM" if null_safe else "<>"
    cases = " ".join(f"WHEN prev_{c} {op} {c} THEN '{label}'" for c, label in causes)
    return f"""WITH {tb.INTEGRATED_SQL},
ordered AS (SELECT *, {lags} FROM gold WINDOW w AS (PARTITION BY {key} ORDER BY snapshot_ts, bronze_row_id)),
changed AS (SELECT *,
  CASE WHEN prev_row_hash IS NULL THEN 'NEW' WHEN prev_row_hash <> row_hash THEN 'CHANGED'
    ELSE 'NO_CHANGE' END AS change_type,
  CASE WHEN prev_row_hash IS NULL THEN 'new_schedule' {cases} ELSE 'else_change' END AS change_detail,
  snapshot_id AS current_snapshot_id, parsed_at AS current_parsed_at
  FROM ordered)
SELECT {columns} FROM changed"""


CLOUD_COLUMNS = ["terminal_id", "prev_terminal_id", "berth", "prev_berth", "vessel_name", "eta", "prev_eta",
                 "etd", "prev_etd", "closing", "prev_closing", "discharge", "prev_discharge", "loading",
                 "prev_loading", "shift", "prev_shift", "total_workload", "stay_hours", "prev_snapshot_id",
                 "current_snapshot_id", "prev_parsed_at", "current_parsed_at", "source_file_name", "business_key",
                 "gold_key", "gold_key_type", "change_type", "change_detail"]
LOCAL_COLUMNS = [c for c in CLOUD_COLUMNS if c != "prev_terminal_id"]
KEPT = " WHERE change_type IN ('NEW', 'CHANGED')"


@query("gold_schedule_change_history",
       change_sql("gold_key", changes.BERTH_FIRST, True, ", ".join(CLOUD_COLUMNS)) + KEPT)
def gold_schedule_change_history(spark, sf):
    return gold.schedule_change_history(integrated(spark, sf)).select(*CLOUD_COLUMNS)


@query("change_history",
       change_sql("business_key", changes.TIME_FIRST, False, ", ".join(LOCAL_COLUMNS)) + KEPT)
def change_history(spark, sf):
    """Second form: business key, times first, plain comparison."""
    return changes.change_history(
        integrated(spark, sf), key="business_key", causes=changes.TIME_FIRST, null_safe=False,
    ).select(*LOCAL_COLUMNS)


@query("change_history_all_rows",
       change_sql("gold_key", changes.BERTH_FIRST, True, "bronze_row_id, gold_key, change_type, change_detail"))
def change_history_all_rows(spark, sf):
    return changes.change_history(integrated(spark, sf), keep=()).select(
        "bronze_row_id", "gold_key", "change_type", "change_detail")


@query("change_history_sliced",
       change_sql("gold_key", changes.BERTH_FIRST, True, "bronze_row_id, gold_key, change_type, change_detail") + KEPT)
def change_history_sliced(spark, sf):
    """The layout for hot keys, forced: keys of more than five rows are cut into ranges."""
    return changes.change_history(
        integrated(spark, sf), range_rows=5,
    ).select("bronze_row_id", "gold_key", "change_type", "change_detail")


def changed_rows(spark, sf):
    out = gold.schedule_change_history(integrated(spark, sf))
    return out.withColumn("created_at", F.col("current_parsed_at"))


@query("change_summary",
       change_sql("gold_key", changes.BERTH_FIRST, True,
                  "change_detail, min(parsed_at) AS created_at, count(*) AS change_count")
       + KEPT + " GROUP BY change_detail ORDER BY created_at, change_detail")
def change_summary(spark, sf):
    return changes.change_summary(changed_rows(spark, sf))


@query("change_type_summary",
       change_sql("gold_key", changes.BERTH_FIRST, True, "change_type, change_detail, count(*) AS cnt")
       + KEPT + " GROUP BY 1, 2 ORDER BY change_type, cnt DESC, change_detail")
def change_type_summary(spark, sf):
    return changes.change_type_summary(changed_rows(spark, sf))


LATEST_SQL = """latest AS (
  SELECT * FROM gold QUALIFY row_number() OVER (PARTITION BY gold_key ORDER BY snapshot_ts DESC, bronze_row_id DESC) = 1)"""


@query("latest_per_key", f"WITH {tb.INTEGRATED_SQL}, {LATEST_SQL} SELECT {GOLD_SELECT} FROM latest")
def latest_rows(spark, sf):
    return latest_per_key(integrated(spark, sf), ["gold_key"], gold.newest_first()).select(*GOLD_COLUMNS)


TODAY_SQL = f"""{tb.INTEGRATED_SQL}, today AS (
  SELECT *, coalesce(nullif(trim(vessel_name), ''), nullif(trim(mother_vessel), ''), nullif(trim(sun_vessel), ''),
    '미확인 선박(' || coalesce(carrier, 'UNKNOWN') || ')') AS vessel_display_name
  FROM gold WHERE eta_work_date = DATE '{AS_OF}'
  QUALIFY row_number() OVER (PARTITION BY gold_key ORDER BY snapshot_ts DESC, bronze_row_id DESC) = 1)"""
TODAY_COLUMNS = ["terminal_id", "berth", "vessel_name", "vessel_display_name", "carrier", "eta", "etd", "closing",
                 "discharge", "loading", "shift", "total_workload", "stay_hours", "stay_days",
                 "closing_to_eta_hours", "snapshot_id", "source_file_name", "parsed_at", "business_key", "gold_key",
                 "gold_key_type"]


def today(spark, sf):
    return gold.today_schedule(integrated(spark, sf), AS_OF)


@query("gold_today_schedule", f"WITH {TODAY_SQL} SELECT {', '.join(TODAY_COLUMNS)} FROM today")
def gold_today_schedule(spark, sf):
    return today(spark, sf).select(*TODAY_COLUMNS)


HOURLY_COLUMNS = ["terminal_id", "work_date", "work_hour", "work_hour_of_day", "vessel_count",
                  "estimated_hourly_workload", "estimated_hourly_discharge", "estimated_hourly_loading",
                  "estimated_hourly_shift", "berth_list", "vessel_list", "latest_parsed_at"]


def hourly_sql(source, key):
    return f"""expanded AS (
  SELECT *, unnest(generate_series(date_trunc('hour', eta), date_trunc('hour', etd), INTERVAL 1 HOUR)) AS work_hour
  FROM {source} WHERE etd > eta AND total_workload > 0 AND stay_hours > 0)
SELECT terminal_id, CAST(CAST(work_hour AS DATE) AS VARCHAR) AS work_date, work_hour,
  CAST(hour(work_hour) AS INT) AS work_hour_of_day, count(DISTINCT {key}) AS vessel_count,
  round(sum(total_workload / stay_hours), 2) AS estimated_hourly_workload,
  round(sum(discharge / stay_hours), 2) AS estimated_hourly_discharge,
  round(sum(loading / stay_hours), 2) AS estimated_hourly_loading,
  round(sum(shift / stay_hours), 2) AS estimated_hourly_shift,
  coalesce(string_agg(DISTINCT berth, ', ' ORDER BY berth), '') AS berth_list,
  coalesce(string_agg(DISTINCT vessel_name, ', ' ORDER BY vessel_name), '') AS vessel_list,
  max(parsed_at) AS latest_parsed_at
FROM expanded GROUP BY terminal_id, work_hour"""


@query("gold_hourly_workload", f"WITH {tb.INTEGRATED_SQL}, {LATEST_SQL}, {hourly_sql('latest', 'gold_key')}")
def gold_hourly_workload(spark, sf):
    return gold.hourly_terminal_workload(integrated(spark, sf)).select(*HOURLY_COLUMNS)


@query("hourly_workload", f"WITH {tb.INTEGRATED_SQL}, {hourly_sql('gold', 'business_key')}")
def hourly_workload(spark, sf):
    """Second form: every snapshot row counts, vessels counted by business key."""
    return gold.hourly_terminal_workload(
        integrated(spark, sf), key="business_key", deduplicate=False).select(*HOURLY_COLUMNS)


@query("filter_valid_schedule", f"""WITH {tb.INTEGRATED_SQL}
SELECT bronze_row_id, eta, etd, total_workload, stay_hours FROM gold
WHERE eta IS NOT NULL AND etd IS NOT NULL AND etd > eta AND total_workload > 0 AND stay_hours > 0""")
def filter_valid_schedule(spark, sf):
    return workload.valid_schedule(integrated(spark, sf)).select(
        "bronze_row_id", "eta", "etd", "total_workload", "stay_hours")


@query("arrivals_within", f"""WITH {TODAY_SQL}
SELECT terminal_id, berth, vessel_name, eta, etd, total_workload FROM today
WHERE eta >= TIMESTAMP '{AS_OF_TIME}' AND eta < TIMESTAMP '{AS_OF_TIME}' + INTERVAL 2 HOUR""")
def arrivals_within(spark, sf):
    return workload.arrivals_within(today(spark, sf), AS_OF_TIME)


@query("terminal_vessel_count", f"""WITH {TODAY_SQL}
SELECT terminal_id, count(*) AS vessel_count, CAST(sum(total_workload) AS BIGINT) AS total_workload
FROM today GROUP BY terminal_id""")
def terminal_vessel_count(spark, sf):
    return workload.terminal_vessel_count(today(spark, sf))


@query("terminal_status", f"""WITH {TODAY_SQL}
SELECT terminal_id, count(*) AS vessel_count, CAST(sum(total_workload) AS BIGINT) AS total_workload,
  CAST(sum(discharge) AS BIGINT) AS total_discharge, CAST(sum(loading) AS BIGINT) AS total_loading
FROM today GROUP BY terminal_id""")
def terminal_status(spark, sf):
    return workload.terminal_status(today(spark, sf))


@query("data_quality_summary", f"""WITH {tb.SILVER_SQL}
SELECT terminal_id, count(*) AS row_count, count(*) FILTER (is_valid) AS valid_count,
  count(*) FILTER (NOT is_valid) AS error_count, count(*) FILTER (eta IS NULL) AS eta_missing
FROM silver GROUP BY terminal_id""")
def data_quality_summary(spark, sf):
    return workload.data_quality_summary(tb.silver_schedule(spark, sf))


@query("distinct_values", f"""WITH {tb.INTEGRATED_SQL}
SELECT DISTINCT berth AS v FROM gold WHERE berth IS NOT NULL ORDER BY v""")
def distinct_values(spark, sf):
    return workload.distinct_values(integrated(spark, sf), "berth")


@query("ordered_output", f"""WITH {TODAY_SQL}
SELECT terminal_id, eta, gold_key, vessel_display_name FROM today ORDER BY terminal_id, eta, gold_key""")
def ordered_output(spark, sf):
    return today(spark, sf).select("terminal_id", "eta", "gold_key", "vessel_display_name")


@query("preview_limit", f"""WITH {tb.INTEGRATED_SQL}
SELECT terminal_id, vessel_name, eta, CAST(eta_work_date AS VARCHAR) AS eta_work_date, business_key, bronze_row_id
FROM gold ORDER BY bronze_row_id LIMIT 10""")
def preview_limit(spark, sf):
    return integrated(spark, sf).select(
        "terminal_id", "vessel_name", "eta", "eta_work_date", "business_key", "bronze_row_id",
    ).orderBy("bronze_row_id").limit(10)


@query("dedup_keep_last", f"""WITH {tb.INTEGRATED_SQL}
SELECT terminal_id, berth, vessel_name, eta, bronze_row_id FROM gold
QUALIFY row_number() OVER (PARTITION BY terminal_id, berth, vessel_name, eta
  ORDER BY snapshot_id DESC, bronze_row_id DESC) = 1""")
def dedup_last(spark, sf):
    return dedup_keep_last(integrated(spark, sf)).select(
        "terminal_id", "berth", "vessel_name", "eta", "bronze_row_id")


# ------------------------------------------------------------------ merged stays
OCCUPANCY_MINUTES = {"click": 61, "view": 123, "purchase": 242, "signup": 483}
STAYS_SQL = """stays AS (
  SELECT * FROM (SELECT 'B' || user_id AS berth, ts AS eta,
    ts + to_minutes(CASE event_type WHEN 'click' THEN 61 WHEN 'view' THEN 123 WHEN 'purchase' THEN 242
      WHEN 'signup' THEN 483 ELSE 15000 END) AS etd FROM events)
  WHERE epoch(etd) - epoch(eta) < 864000),
marked AS (
  SELECT *, CASE WHEN eta <= max(etd) OVER (PARTITION BY berth ORDER BY eta, etd
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM stays),
numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY berth ORDER BY eta, etd ROWS UNBOUNDED PRECEDING) AS island FROM marked)"""
ISLAND_SELECT = """SELECT berth, min(eta) AS eta, max(etd) AS etd, count(*) AS interval_count
FROM numbered GROUP BY berth, island"""


def stays(spark, sf):
    minutes = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for p in OCCUPANCY_MINUTES.items() for x in p]), F.col("event_type")),
        F.lit(15000))
    ts = F.col("ts").cast("timestamp_ntz")
    df = tb.table(spark, sf, "events").select(
        F.concat(F.lit("B"), F.col("user_id").cast("string")).alias("berth"), ts.alias("eta"),
        (ts + F.make_dt_interval(mins=minutes)).alias("etd"))
    return df.filter(F.unix_timestamp("etd") - F.unix_timestamp("eta") < 864000)


@query("interval_islands", f"WITH {STAYS_SQL} {ISLAND_SELECT}")
def interval_islands(spark, sf):
    return intervals.interval_islands(stays(spark, sf), ["berth"])


@query("interval_islands_sliced", f"WITH {STAYS_SQL} {ISLAND_SELECT}")
def interval_islands_sliced(spark, sf):
    """The layout for hot berths, forced."""
    return intervals.interval_islands(stays(spark, sf), ["berth"], range_rows=10)
