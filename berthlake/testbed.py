"""The given tables in the shapes the engine reads: silver schedule, vessel calls, monthly volumes,
freight index and raw snapshot files. Each builder is a lazy projection (or one grouped aggregate) of a
given table, so the work of every query grows with that table. ``*_SQL`` holds the same rows for the oracle.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from berthlake.functions import text, time as bt
from berthlake.sources import tables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.scan(spark, os.path.join(sf_dir, f"{name}.parquet"))


# ------------------------------------------------------------------ schedule from events

STAY_MINUTES = {"click": 365, "view": 740, "purchase": 1450, "signup": 2900}
OUTLIER_MINUTES = 15000


def silver_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows (before the gold casts), one snapshot row per event."""
    return silver_from_events(table(spark, sf_dir, "events"))


def silver_from_events(events: DataFrame) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    ts = F.col("ts").cast("timestamp_ntz")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    terminal_no = ((u + e % 2) % 7 + 1).cast("int")
    day6 = bt.operational_date(ts).cast("timestamp_ntz")
    minutes = F.coalesce(
        F.try_element_at(text.literal_map(STAY_MINUTES), F.col("event_type")), F.lit(OUTLIER_MINUTES)
    )
    hour_text = F.date_format(ts, "yyyyMMdd_HH")

    base = events.select(
        F.concat(F.lit("terminal_"), terminal_no.cast("string")).alias("terminal_id"),
        F.concat_ws("_", terminal_no.cast("string"), hour_text).alias("snapshot_id"),
        F.concat(
            F.lit("brz_"), text.zero_padded(terminal_no, 2), F.lit("_"), hour_text,
            F.lit("_"), text.zero_padded(e, 9),
        ).alias("bronze_row_id"),
        F.concat(
            F.lit("terminal_"), terminal_no.cast("string"), F.lit("_schedule_"), hour_text,
            F.lit(".xls"),
        ).alias("source_file_name"),
        e.cast("string").alias("source_row_number"),
        ts.alias("parsed_at"),
        ts.alias("snapshot_ts"),
        F.when(e % 26 != 0, F.concat(F.lit("B"), (u % 3 + e % 2).cast("string"))).alias("berth"),
        F.when(e % 19 != 0, F.concat(F.lit("C"), (u % 5).cast("string"))).alias("carrier"),
        F.when(e % 13 == 0, "").otherwise(F.concat(F.lit("VSL"), u.cast("string"))).alias("vessel_name"),
        F.when(e % 17 != 0, F.concat(F.lit("MV"), u.cast("string"))).alias("mother_vessel"),
        F.when(e % 5 != 0, F.concat(F.lit("SV"), (u % 11).cast("string"))).alias("sun_vessel"),
        F.lit("H").alias("head_bridge_stern"),
        F.when(e % 7 != 0, F.concat(F.lit("R"), (u % 9).cast("string"))).alias("route"),
        F.when(
            e % 101 != 0,
            day6 + F.expr("INTERVAL 6 HOURS") + F.make_dt_interval(hours=(e % 3).cast("int")),
        ).alias("eta"),
        minutes.alias("_minutes"),
        F.when(e % 11 != 0, day6 + F.expr("INTERVAL 1 HOUR")).alias("closing"),
        F.when(k % 10 != 0, k % 2 * 100).alias("discharge"),
        (F.floor("value").cast("int") % 3 * 50).alias("loading"),
        ((e % 3).cast("int") * 5).alias("shift"),
        F.when(e % 4 == 0, "Y").otherwise("n").alias("amp"),
        F.col("event_type").alias("status"),
    )
    base = base.withColumn("etd", F.col("eta") + F.make_dt_interval(mins="_minutes")).drop("_minutes")
    base = base.withColumn("eta_work_date", bt.operational_date("eta").cast("string"))
    seconds = [F.unix_timestamp(c).alias(c) for c in ("eta", "etd", "closing")]
    hashed = [F.coalesce(c.cast("string"), F.lit("-"))
              for c in [F.col("berth"), *seconds, *map(F.col, ("discharge", "loading", "shift"))]]
    return base.select(
        "*",
        text.terminal_name("terminal_id").alias("terminal_name"),
        F.md5(F.concat_ws("|", *hashed)).alias("row_hash"),
        text.business_key().alias("business_key"),
        F.col("berth").isNotNull().alias("is_valid"),
        F.when(F.col("berth").isNull(), "no berth").alias("error_msg"),
    )


SILVER_SQL = """
silver0 AS (
  SELECT event_id AS e, user_id AS u, ts, event_type, value,
    CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k,
    CAST((user_id + event_id % 2) % 7 + 1 AS INT) AS tno,
    date_trunc('day', ts - INTERVAL 6 HOUR)::TIMESTAMP AS day6,
    strftime(ts, '%Y%m%d_%H') AS hr,
    CASE event_type WHEN 'click' THEN 365 WHEN 'view' THEN 740 WHEN 'purchase' THEN 1450
      WHEN 'signup' THEN 2900 ELSE 15000 END AS minutes
  FROM events),
silver1 AS (
  SELECT e, 'terminal_' || tno AS terminal_id, tno || '_' || hr AS snapshot_id,
    'brz_' || printf('%02d', tno) || '_' || hr || '_' || printf('%09d', e) AS bronze_row_id,
    'terminal_' || tno || '_schedule_' || hr || '.xls' AS source_file_name,
    e::VARCHAR AS source_row_number,
    ts AS parsed_at, ts AS snapshot_ts,
    CASE WHEN e % 26 <> 0 THEN 'B' || (u % 3 + e % 2) END AS berth,
    CASE WHEN e % 19 <> 0 THEN 'C' || (u % 5) END AS carrier,
    CASE WHEN e % 13 = 0 THEN '' ELSE 'VSL' || u END AS vessel_name,
    CASE WHEN e % 17 <> 0 THEN 'MV' || u END AS mother_vessel,
    CASE WHEN e % 5 <> 0 THEN 'SV' || (u % 11) END AS sun_vessel,
    'H' AS head_bridge_stern,
    CASE WHEN e % 7 <> 0 THEN 'R' || (u % 9) END AS route,
    CASE WHEN e % 101 <> 0 THEN day6 + INTERVAL 6 HOUR + to_hours((e % 3)::INT) END AS eta,
    CASE WHEN e % 101 <> 0 THEN
      day6 + INTERVAL 6 HOUR + to_hours((e % 3)::INT) + to_minutes(minutes) END AS etd,
    CASE WHEN e % 11 <> 0 THEN day6 + INTERVAL 1 HOUR END AS closing,
    CASE WHEN k % 10 <> 0 THEN k % 2 * 100 END AS discharge,
    CAST(floor(value) AS INT) % 3 * 50 AS loading,
    CAST(e % 3 AS INT) * 5 AS shift,
    CASE WHEN e % 4 = 0 THEN 'Y' ELSE 'n' END AS amp,
    event_type AS status,
    CASE tno WHEN 1 THEN 'PNIT' WHEN 2 THEN 'PNC' WHEN 3 THEN 'HJNC' WHEN 4 THEN 'HPNT'
      WHEN 5 THEN 'BNCT' WHEN 6 THEN 'BCT' ELSE 'DGT' END AS terminal_name,
    e % 26 <> 0 AS is_valid,
    CASE WHEN e % 26 = 0 THEN 'no berth' END AS error_msg
  FROM silver0),
silver AS (
  SELECT *, CAST(CAST(eta - INTERVAL 6 HOUR AS DATE) AS VARCHAR) AS eta_work_date,
    md5(concat_ws('|', coalesce(berth, '-'), coalesce(epoch(eta)::BIGINT::VARCHAR, '-'),
      coalesce(epoch(etd)::BIGINT::VARCHAR, '-'), coalesce(epoch(closing)::BIGINT::VARCHAR, '-'), coalesce(discharge::VARCHAR, '-'),
      coalesce(loading::VARCHAR, '-'), coalesce(shift::VARCHAR, '-'))) AS row_hash,
    concat_ws('_', terminal_id, mother_vessel, sun_vessel,
      CAST(CAST(eta - INTERVAL 6 HOUR AS DATE) AS VARCHAR)) AS business_key
  FROM silver1)"""

INTEGRATED_SQL = SILVER_SQL + """,
gold AS (
  SELECT terminal_id, berth, vessel_name, eta, etd, closing, CAST(eta AS DATE) AS eta_date,
    CAST(eta_work_date AS DATE) AS eta_work_date, discharge, loading, shift,
    coalesce(discharge, 0) + coalesce(loading, 0) + coalesce(shift, 0) AS total_workload,
    round((epoch(etd) - epoch(eta)) / 3600.0, 2) AS stay_hours,
    round((epoch(etd) - epoch(eta)) / 86400.0, 2) AS stay_days,
    round((epoch(eta) - epoch(closing)) / 3600.0, 2) AS closing_to_eta_hours,
    business_key, source_file_name, row_hash, snapshot_id, snapshot_ts, bronze_row_id, parsed_at,
    mother_vessel, sun_vessel, carrier, route, is_valid, error_msg,
    (CASE WHEN trim(mother_vessel) <> '' THEN 'MV_' || trim(mother_vessel)
      WHEN trim(vessel_name) <> '' THEN 'VN_' || trim(vessel_name)
      WHEN trim(sun_vessel) <> '' THEN 'SV_' || trim(sun_vessel)
      WHEN trim(route) <> '' THEN 'RT_' || trim(route)
      WHEN trim(carrier) <> '' THEN 'WEAK_' || trim(carrier) || '_' ||
        coalesce(discharge::VARCHAR, '0') || '_' || coalesce(loading::VARCHAR, '0')
      ELSE 'UNKNOWN_' || coalesce(discharge::VARCHAR, '0') || '_' ||
        coalesce(loading::VARCHAR, '0') END) || '_' || coalesce(eta_work_date, 'UNKNOWN_DATE') AS gold_key,
    CASE WHEN trim(mother_vessel) <> '' THEN 'mother_vessel'
      WHEN trim(vessel_name) <> '' THEN 'vessel_name'
      WHEN trim(sun_vessel) <> '' THEN 'sun_vessel'
      WHEN trim(route) <> '' THEN 'route'
      WHEN trim(carrier) <> '' THEN 'weak_carrier_workload' ELSE 'unknown' END AS gold_key_type
  FROM silver)"""

# ------------------------------------------------------------------ vessel calls from lineitem


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vessel calls over 83 months, one per line item, with blank, dummy and cancelled ones."""
    li = table(spark, sf_dir, "lineitem")
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    order = F.col("l_orderkey")
    etd = F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(hours=(order % 24).cast("int"))
    minutes = F.when(order % 97 == 0, 15000).otherwise(line * 60 + (part % 60).cast("int")).cast("int")
    return li.select(
        F.concat(F.lit("terminal_"), (supp % 7 + 1).cast("string")).alias("terminal_id"),
        F.concat(F.lit("B"), (part % 4).cast("string")).alias("berth"),
        F.when(order % 89 == 0, F.lit("dummy ship")).when(
            order % 83 != 0, F.concat(F.lit("VSL"), supp.cast("string"))
        ).alias("vessel_name"),
        F.concat(F.lit("C"), (supp % 5).cast("string")).alias("carrier"),
        F.concat(F.lit("R"), (part % 9).cast("string")).alias("route"),
        (etd - F.make_dt_interval(mins=minutes)).alias("eta"),
        etd.alias("etd"),
        F.round(minutes / 60, 2).alias("stay_hours"),
        F.col("l_quantity").cast("int").alias("discharge"),
        (line * 10).cast("int").alias("loading"),
        F.when(F.col("l_returnflag") == "R", 5).otherwise(0).alias("shift"),
        F.when(order % 71 == 0, "canceled").otherwise("DONE").alias("status"),
        (order % 61 != 0).alias("is_valid"),
        F.concat_ws("_", (supp % 7 + 1).cast("string"), F.date_format(etd, "yyyyMMdd_HH")).alias("snapshot_id"),
        F.concat_ws("_", text.zero_padded(order, 12), line.cast("string")).alias("bronze_row_id"),
    )


CALLS_SQL = """
calls0 AS (
  SELECT *, l_shipdate + to_hours((l_orderkey % 24)::INT) AS etd,
    CASE WHEN l_orderkey % 97 = 0 THEN 15000 ELSE l_linenumber * 60 + (l_partkey % 60)::INT END AS minutes
  FROM lineitem),
calls AS (
  SELECT 'terminal_' || (l_suppkey % 7 + 1) AS terminal_id, 'B' || (l_partkey % 4) AS berth,
    CASE WHEN l_orderkey % 89 = 0 THEN 'dummy ship' WHEN l_orderkey % 83 <> 0 THEN 'VSL' || l_suppkey END AS vessel_name,
    'C' || (l_suppkey % 5) AS carrier, 'R' || (l_partkey % 9) AS route,
    etd - to_minutes(minutes::INT) AS eta, etd, round(minutes / 60.0, 2) AS stay_hours,
    CAST(l_quantity AS INT) AS discharge, l_linenumber * 10 AS loading,
    CASE WHEN l_returnflag = 'R' THEN 5 ELSE 0 END AS shift,
    CASE WHEN l_orderkey % 71 = 0 THEN 'canceled' ELSE 'DONE' END AS status,
    l_orderkey % 61 <> 0 AS is_valid,
    (l_suppkey % 7 + 1) || '_' || strftime(etd, '%Y%m%d_%H') AS snapshot_id,
    printf('%012d', l_orderkey) || '_' || l_linenumber AS bronze_row_id
  FROM calls0)"""

# ------------------------------------------------------------------ monthly container volumes

MONTHLY_FLAGS = [("N", "import"), ("A", "export"), ("R", "transship")]


def silver_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text table of monthly volumes with thousands commas, plus a totals row per year."""
    li = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
        "l_returnflag", "l_linestatus", "l_quantity",
    )

    def qty(flag: str, status: str):
        return F.sum(F.when((F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status),
                            F.col("l_quantity")).otherwise(0.0)).cast("bigint")

    sums = [
        qty("N", "F").alias("import_full"), qty("N", "O").alias("import_empty"),
        qty("A", "F").alias("export_full"), qty("A", "O").alias("export_empty"),
        qty("R", "F").alias("import_transship_full"), qty("R", "O").alias("import_transship_empty"),
    ]
    per_month = li.rollup("year", "month").agg(*sums).filter("year IS NOT NULL")
    half = lambda c: F.floor(F.col(c) / 2)
    numbers = {
        "total_full": F.col("import_full") + F.col("export_full") + F.col("import_transship_full"),
        "total_empty": F.col("import_empty") + F.col("export_empty") + F.col("import_transship_empty"),
        "import_full": F.col("import_full"), "import_empty": F.col("import_empty"),
        "export_full": F.col("export_full"), "export_empty": F.col("export_empty"),
        "import_transship_full": half("import_transship_full"),
        "import_transship_empty": half("import_transship_empty"),
        "export_transship_full": F.col("import_transship_full") - half("import_transship_full"),
        "export_transship_empty": F.col("import_transship_empty") - half("import_transship_empty"),
    }
    return per_month.select(
        F.col("year").cast("string").alias("year"),
        F.coalesce(F.col("month").cast("string"), F.lit("합계")).alias("month"),
        *[F.format_number(v, 0).alias(n) for n, v in numbers.items()],
    )


MONTHLY_SQL = """
monthly0 AS (
  SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
    CAST(sum(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS DOUBLE) AS import_full,
    CAST(sum(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS DOUBLE) AS import_empty,
    CAST(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS DOUBLE) AS export_full,
    CAST(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS DOUBLE) AS export_empty,
    CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS DOUBLE) AS tf,
    CAST(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS DOUBLE) AS te
  FROM lineitem GROUP BY 1, 2),
monthly AS (
  SELECT year, month, make_date(year, month, 1) AS month_date,
    import_full + export_full + tf AS total_full, import_empty + export_empty + te AS total_empty,
    import_full, import_empty, export_full, export_empty,
    floor(tf / 2) AS import_transship_full, floor(te / 2) AS import_transship_empty,
    tf - floor(tf / 2) AS export_transship_full, te - floor(te / 2) AS export_transship_empty,
    import_full + export_full + tf + import_empty + export_empty + te AS total_container,
    import_full + import_empty AS import_total, export_full + export_empty AS export_total,
    tf + te AS transship_total
  FROM monthly0)"""

# ------------------------------------------------------------------ freight index


def freight_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows as text: category, value with commas, registration date, one spare column."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.when(F.col("o_orderkey") % 5 == 0, "OTHER").otherwise("SCFI").alias("c0"),
        F.format_number("o_totalprice", 2).alias("c1"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("c2"),
        F.col("o_orderpriority").alias("c3"),
    )


INDEX_SQL = """
freight AS (
  SELECT CAST(o_orderdate AS DATE) AS index_date, o_totalprice AS index_value
  FROM orders WHERE o_orderkey % 5 <> 0)"""
