"""Files, header rules, bronze metadata and the silver columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from berthlake import fixed_values as fv, testbed as tb, testbed_files as tf
from berthlake.functions import text, time as bt
from berthlake.operators import bronze as bz
from berthlake.plans import silver
from berthlake.registry import query
from berthlake.session import scratch_path
from berthlake.sinks import tables as sinks
from berthlake.sources import files, sheets, tables

CELLS_SQL = """SELECT file_name, CAST(r + {shift} AS INT) AS row_no, CAST(c AS INT) AS col_no, val AS value FROM (
  SELECT file_name, r, tno, unnest({values}) AS val, unnest(range(1, len({values}) + 1)) AS c FROM raw WHERE tno IN ({terminals}))"""


def decoded(spark, sf, *suffixes):
    raw = tf.raw_files(spark, sf)
    if suffixes:
        raw = raw.filter(F.substring_index("path", ".", -1).isin(*suffixes))
    return sheets.decode(raw)


def bronze(spark, sf):
    return bz.bronze(decoded(spark, sf))


def raw_silver(spark, sf):
    return silver.silver_from_bronze(bronze(spark, sf), F.lit("2024-02-01 00:00:00"))


@query("scan_file_listing")
def scan_file_listing(spark, sf):
    """Name and size of the given table files."""
    return files.file_listing(spark, sf, ["parquet"])


@query("ingest_nexacro_xml", f"""WITH {tf.RAW_SQL}
SELECT file_name, r AS row_no, {", ".join(f"nullif(v_{s}, '') AS {h}" for h, s in fv.COLUMN_MAPS[6].items())}
FROM raw WHERE tno = 6""")
def ingest_nexacro_xml(spark, sf):
    rows = bz.bronze(decoded(spark, sf, "xml"))
    return rows.select(
        F.col("source_file_name").alias("file_name"), F.col("source_row_number").alias("row_no"),
        *[bz.cell(F.lit(h)).alias(h) for h in fv.COLUMN_MAPS[6]])


@query("ingest_html_tables", f"WITH {tf.RAW_SQL} " + CELLS_SQL.format(
    shift=0, values=tf.sql_by_terminal(tf.sql_list), terminals="1, 2, 4"))
def ingest_html_tables(spark, sf):
    return sheets.cells(decoded(spark, sf, "xls"))


@query("ingest_xlsx_cells", f"""WITH {tf.RAW_SQL},
heads AS (SELECT DISTINCT file_name, tno FROM raw WHERE tno IN (3, 5, 7)),
head_rows AS (
  SELECT file_name, 1 AS row_no, ['title'] || list_transform(range(17), lambda i: NULL::VARCHAR) AS vals FROM heads WHERE tno = 3
  UNION ALL SELECT file_name, CASE WHEN tno = 3 THEN 2 ELSE 1 END, {tf.sql_by_terminal(tf.sql_headers)} FROM heads)
{CELLS_SQL.format(shift="CASE WHEN tno = 3 THEN 2 ELSE 1 END", values=tf.sql_by_terminal(tf.sql_list), terminals="3, 5, 7")}
UNION ALL SELECT file_name, row_no, CAST(unnest(range(1, len(vals) + 1)) AS INT), unnest(vals) FROM head_rows""")
def ingest_xlsx_cells(spark, sf):
    return sheets.cells(decoded(spark, sf, "xlsx"))


@query("error_tolerant_ingest", f"""WITH {tf.RAW_SQL}
SELECT file_name, tno AS terminal_no, piece % 3 = 0 AND tno <> 6 AS failed,
  CASE WHEN NOT (piece % 3 = 0 AND tno <> 6) THEN count(*) END AS row_count FROM raw GROUP BY file_name, tno, piece""")
def error_tolerant_ingest(spark, sf):
    """Every third binary file is cut short; it is recorded and the others go on."""
    raw = tf.raw_files(spark, sf)
    hours = F.unix_timestamp(files.snapshot_ts_of_file(files.file_name("path"))) / 3600
    # hour number of 2024-01-01 00:00 is a multiple of three
    broken = (hours % 3 == 0) & ~F.col("path").endswith(".xml")
    raw = raw.withColumn("content", F.when(broken, F.substring("content", 1, 20)).otherwise(F.col("content")))
    found = bz.apply_header_rule(sheets.decode(raw))
    return found.select(
        "file_name", "terminal_no", F.col("error").isNotNull().alias("failed"),
        F.when(F.col("error").isNull(), F.size("data").cast("bigint")).alias("row_count"))


NAMED_SQL = f"""SELECT file_name, r AS row_no,
  array_to_string({tf.sql_by_terminal(tf.sql_headers)}, ', ') AS names,
  array_to_string(list_transform({tf.sql_by_terminal(tf.sql_list)}, lambda v: coalesce(v, '~')), ', ') AS cells FROM raw"""


@query("apply_header_rule", f"WITH {tf.RAW_SQL} {NAMED_SQL}")
def apply_header_rule(spark, sf):
    ruled = bz.apply_header_rule(decoded(spark, sf))
    rows = ruled.select("file_name", "names", F.posexplode("data").alias("pos", "row"))
    return rows.select(
        "file_name", (F.col("pos") + 1).alias("row_no"), "names",
        F.array_join("row", ", ", "~").alias("cells"))


JSON_SQL = f"""'{{' || array_to_string(list_transform(list_zip({tf.sql_by_terminal(tf.sql_headers)}, {tf.sql_by_terminal(tf.sql_list)}),
  lambda p: '"' || replace(p[1], chr(10), chr(92) || 'n') || '": ' || coalesce('"' || p[2] || '"', 'NaN')), ', ') || '}}'"""


@query("bronze_metadata", f"""WITH {tf.RAW_SQL}, j AS (SELECT *, {JSON_SQL} AS raw_row_json FROM raw)
SELECT 'terminal_' || tno AS terminal_id, tno || '_' || stamp AS snapshot_id, file_name AS source_file_name,
  '/raw/terminal_' || tno || '/' || file_name AS source_file_path, 'Sheet1' AS source_sheet_name, r AS source_row_number,
  raw_row_json, md5(raw_row_json) AS row_hash, snapshot_ts AS downloaded_at,
  md5('[' || string_agg(raw_row_json, ',' ORDER BY r) OVER (PARTITION BY file_name ORDER BY r
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) || ']') AS file_hash,
  'brz_' || lpad(tno::VARCHAR, 2, '0') || '_' || stamp || '_' || lpad(r::VARCHAR, 4, '0') AS bronze_row_id FROM j""")
def bronze_metadata(spark, sf):
    return bronze(spark, sf).select(
        "terminal_id", "snapshot_id", "source_file_name", "source_file_path", "source_sheet_name", "source_row_number",
        "raw_row_json", "row_hash", "downloaded_at", "file_hash", "bronze_row_id")


@query("parse_snapshot_name", f"""WITH {tf.RAW_SQL}
SELECT DISTINCT file_name, tno AS terminal_no, snapshot_ts FROM raw""")
def parse_snapshot_name(spark, sf):
    names = tf.raw_files(spark, sf).select(files.file_name("path").alias("file_name"))
    return names.select("file_name", files.terminal_of_file("file_name").alias("terminal_no"),
                        files.snapshot_ts_of_file("file_name").alias("snapshot_ts"))


def wide_sql(t):
    """Raw rows of one terminal under its safe names, and nothing for names that terminals share only by chance."""
    names = ", ".join(f'v_{s} AS "{text.safe_name(h)}"' for h, s in fv.COLUMN_MAPS[t].items())
    return f"SELECT file_name AS source_file_name, r AS source_row_number, {names} FROM raw WHERE tno = {t}"


@query("sanitize_columns", f"WITH {tf.RAW_SQL} " + " UNION ALL ".join(
    f"SELECT file_name AS source_file_name, r AS source_row_number, tno AS terminal_no, '{text.safe_name(h)}' AS column_name, v_{s} AS value "
    f"FROM raw WHERE tno = {t}" for t, m in fv.COLUMN_MAPS.items() for h, s in m.items()))
def sanitize_columns(spark, sf):
    """Every cell of every terminal under its safe column name."""
    rows, out = bronze(spark, sf), None
    for t, headers in fv.COLUMN_MAPS.items():
        names = [text.safe_name(h) for h in headers]
        cells = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("value")) for n in names]))
        part = bz.wide(rows, t).select("source_file_name", "source_row_number", F.lit(t).alias("terminal_no"), cells.alias("c"))
        part = part.select("source_file_name", "source_row_number", "terminal_no", "c.*")
        out = part if out is None else out.unionByName(part)
    return out


@query("concat_union_schema", f"WITH {tf.RAW_SQL} " + " UNION ALL BY NAME ".join(wide_sql(t) for t in fv.COLUMN_MAPS))
def concat_union_schema(spark, sf):
    """All terminals under one schema; a column that a terminal lacks is null."""
    rows, out = bronze(spark, sf), None
    for t in fv.COLUMN_MAPS:
        part = bz.wide(rows, t)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.drop("terminal_id", "snapshot_id", "bronze_row_id", "row_hash")


STANDARD = ["berth", "carrier", "vessel_name", "mother_vessel", "sun_vessel", "head_bridge_stern", "route", "amp",
            "status", "discharge", "loading", "shift"]


@query("standardize_columns", f"WITH {tf.RAW_SILVER_SQL} SELECT bronze_row_id, {', '.join(STANDARD)} FROM raw_silver")
def standardize_columns(spark, sf):
    return silver.standardize(bronze(spark, sf)).select("bronze_row_id", *STANDARD)


SILVER_OUT = [c for c in fv.SILVER_COLUMNS if c not in ("row_hash", "parsed_at")]
SILVER_RENAMED = {"source_file_name": "file_name AS source_file_name",
                  "source_row_number": "r::VARCHAR AS source_row_number"}


@query("silver_from_bronze",
       f"WITH {tf.RAW_SILVER_SQL} SELECT {', '.join(SILVER_RENAMED.get(c, c) for c in SILVER_OUT)} FROM raw_silver")
def silver_from_bronze(spark, sf):
    return raw_silver(spark, sf).select(*SILVER_OUT)


@query("validate_rows", f"WITH {tf.RAW_SILVER_SQL} SELECT bronze_row_id, berth, vessel_name, is_valid, error_msg FROM raw_silver")
def validate_rows(spark, sf):
    return silver.validate(silver.standardize(bronze(spark, sf))).select(
        "bronze_row_id", "berth", "vessel_name", "is_valid", "error_msg")


@query("split_error_log", f"""WITH {tf.RAW_SILVER_SQL}
SELECT 'err_' || left(sha256(bronze_row_id), 8) AS error_id, bronze_row_id, terminal_id, file_name AS source_file_name,
  r::VARCHAR AS source_row_number, 'PARSE_ERROR' AS error_type, error_msg AS error_message,
  '2024-02-01 00:00:00' AS detected_at FROM raw_silver WHERE NOT is_valid""")
def split_error_log(spark, sf):
    return silver.error_log(raw_silver(spark, sf))


# ------------------------------------------------------------------ scalar rules on event texts

def texts(spark, sf):
    return tf.event_texts(tb.table(spark, sf, "events"))


@query("clean_null_tokens", f"""WITH {tf.RAW_SQL}
SELECT e, nullif(v_berth, '') AS berth, CASE WHEN v_carrier <> 'None' THEN v_carrier END AS carrier,
  CASE WHEN v_mother_vessel <> 'nan' THEN v_mother_vessel END AS mother_vessel FROM raw""")
def clean_null_tokens(spark, sf):
    padded = lambda c: F.concat(F.lit(" "), F.col(c), F.lit("\t"))
    return texts(spark, sf).select("e", *[text.clean_token(padded(f"v_{c}")).alias(c)
                                          for c in ("berth", "carrier", "mother_vessel")])


@query("parse_workload_triplet", f"""WITH {tf.RAW_SQL}
SELECT e, CASE WHEN e % 23 <> 0 THEN k * 37 END AS discharge, CAST(floor(value) AS INT) * 30 AS loading,
  CAST(e % 3 * 5 AS INT) AS shift FROM raw""")
def parse_workload_triplet(spark, sf):
    return texts(spark, sf).select("e", text.workload_strict(f"v_{fv.WORKLOAD}").alias("w")).select("e", "w.*")


@query("parse_workload_lenient", f"""WITH {tf.RAW_SQL}
SELECT e, CASE WHEN e % 7 = 0 THEN 0 WHEN e % 23 = 0 THEN 120 ELSE k * 37 END AS discharge,
  CASE WHEN e % 7 = 0 THEN 0 ELSE CAST(floor(value) AS INT) * 30 END AS loading,
  CASE WHEN e % 7 = 0 OR e % 5 = 0 THEN 0 ELSE CAST(e % 3 * 5 AS INT) END AS shift FROM raw""")
def parse_workload_lenient(spark, sf):
    """Slash triple, blank-separated pair, and a text without any separator."""
    e = F.col("e")
    value = F.when(e % 7 == 0, "x").when(
        e % 5 == 0, F.concat_ws(" ", "v_discharge", "v_loading")
    ).otherwise(F.concat_ws("/", "v_discharge", "v_loading", "v_shift"))
    return texts(spark, sf).select("e", text.workload_lenient(value).alias("w")).select("e", "w.*")


@query("to_int_commas", f"""WITH {tf.RAW_SQL}
SELECT e, CASE WHEN e % 23 <> 0 THEN k * 37 END AS discharge, CAST(floor(value) AS INT) * 30 AS loading,
  NULL::INT AS closing FROM raw""")
def to_int_commas(spark, sf):
    return texts(spark, sf).select("e", *[text.int_or_null(f"v_{c}").alias(c) for c in ("discharge", "loading", "closing")])


@query("safe_timestamp_cast", f"""WITH {tf.RAW_SQL}
SELECT e, CASE WHEN e % 101 <> 0 THEN date_trunc('minute', ts) END AS eta,
  date_trunc('minute', ts + to_hours((e % 40)::INT)) AS etd,
  CASE WHEN e % 11 <> 0 THEN date_trunc('minute', ts - INTERVAL 5 HOUR) END AS closing, NULL::TIMESTAMP AS berth FROM raw""")
def safe_timestamp_cast(spark, sf):
    return texts(spark, sf).select("e", *[bt.parse_ts(f"v_{c}").alias(c) for c in ("eta", "etd", "closing", "berth")])


@query("operational_date", """SELECT event_id, CAST(CAST(ts - INTERVAL 6 HOUR AS DATE) AS VARCHAR) AS eta_work_date FROM events""")
def operational_date(spark, sf):
    ts = F.col("ts").cast("timestamp_ntz")
    return tb.table(spark, sf, "events").select("event_id", bt.operational_date(ts).alias("eta_work_date"))


@query("business_key", f"WITH {tb.SILVER_SQL} SELECT bronze_row_id, business_key FROM silver")
def business_key(spark, sf):
    return tb.silver_schedule(spark, sf).drop("business_key").select(
        "bronze_row_id", text.business_key().alias("business_key"))


@query("gold_key_cascade", f"WITH {tb.INTEGRATED_SQL} SELECT bronze_row_id, gold_key, gold_key_type FROM gold")
def gold_key_cascade(spark, sf):
    return tb.silver_schedule(spark, sf).select(
        "bronze_row_id", text.gold_key().alias("gold_key"), text.gold_key_type().alias("gold_key_type"))


@query("total_workload", f"WITH {tb.INTEGRATED_SQL} SELECT bronze_row_id, total_workload FROM gold")
def total_workload(spark, sf):
    return tb.silver_schedule(spark, sf).select("bronze_row_id", text.total_workload().alias("total_workload"))


@query("stay_duration", f"WITH {tb.INTEGRATED_SQL} SELECT bronze_row_id, stay_hours, stay_days, closing_to_eta_hours FROM gold")
def stay_duration(spark, sf):
    return tb.silver_schedule(spark, sf).select(
        "bronze_row_id", bt.hours_between("eta", "etd").alias("stay_hours"),
        bt.days_between("eta", "etd").alias("stay_days"),
        bt.hours_between("closing", "eta").alias("closing_to_eta_hours"))


@query("date_parts", f"""WITH {tb.SILVER_SQL}
SELECT bronze_row_id, CAST(CAST(eta AS DATE) AS VARCHAR) AS eta_date, CAST(hour(eta) AS INT) AS eta_hour,
  CAST(dayofweek(eta) + 1 AS INT) AS eta_dayofweek FROM silver""")
def date_parts(spark, sf):
    return tb.silver_schedule(spark, sf).select(
        "bronze_row_id", F.to_date("eta").alias("eta_date"), F.hour("eta").alias("eta_hour"),
        F.dayofweek("eta").alias("eta_dayofweek"))


@query("flag_from_text", f"WITH {tb.SILVER_SQL} SELECT bronze_row_id, CASE WHEN upper(amp) = 'Y' THEN 1 ELSE 0 END AS is_amp FROM silver")
def flag_from_text(spark, sf):
    return tb.silver_schedule(spark, sf).select("bronze_row_id", text.yes_flag("amp").alias("is_amp"))


@query("display_name_fallback", f"""WITH {tb.SILVER_SQL}
SELECT bronze_row_id, coalesce(nullif(trim(vessel_name), ''), nullif(trim(mother_vessel), ''), nullif(trim(sun_vessel), ''),
  '미확인 선박(' || coalesce(carrier, 'UNKNOWN') || ')') AS vessel_display_name FROM silver""")
def display_name_fallback(spark, sf):
    return tb.silver_schedule(spark, sf).select("bronze_row_id", text.display_name().alias("vessel_display_name"))


@query("terminal_name_lookup", """SELECT event_id, k AS terminal, CASE WHEN k IN ('terminal_1', '1', ' 1 ') THEN 'PNIT'
  WHEN k IN ('terminal_2', '2') THEN 'PNC' WHEN k IN ('terminal_3', '3') THEN 'HJNC' WHEN k IN ('terminal_4', '4') THEN 'HPNT'
  WHEN k IN ('terminal_5', '5') THEN 'BNCT' WHEN k IN ('terminal_6', '6') THEN 'BCT' WHEN k IN ('terminal_7', '7') THEN 'DGT'
  ELSE k END AS terminal_name FROM (
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'terminal_' || (event_id % 9 + 1) ELSE CAST(event_id % 9 + 1 AS VARCHAR) END AS k
  FROM events)""")
def terminal_name_lookup(spark, sf):
    number = (F.col("event_id") % 9 + 1).cast("string")
    key = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("terminal_"), number)).otherwise(number)
    return tb.table(spark, sf, "events").select(
        "event_id", key.alias("terminal"), text.terminal_name(key).alias("terminal_name"))


# ------------------------------------------------------------------ yearly history files

HISTORY_HEADERS = ["선석", "선사", "모선 항차", "선사항차", "모선명", "ROUTE", "접안예정시간\n(ETB)", "출항 일시", "반입마감시간",
                   "작업량\n양하/적하/Shift", "양하", "AMP", "비고"]


def history_sheets(spark, sf):
    """Yearly tables of line items; every second file has two title rows above its header."""
    piece, no = F.floor(F.col("l_orderkey") / 100), F.floor(F.col("l_orderkey") / 100) % 7 + 1
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    etd = F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(hours=(order % 24).cast("int"))
    minutes = F.when(order % 31 == 0, 14400).when(order % 37 == 0, -60).otherwise(line * 60).cast("int")
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    cells = F.array(
        F.concat(F.lit("B"), (F.col("l_partkey") % 4).cast("string")),
        F.when(line % 5 != 0, F.concat(F.lit("C"), (F.col("l_suppkey") % 5).cast("string"))),
        F.concat(F.lit("MV"), order.cast("string")), F.lit(None).cast("string"),
        F.concat(F.lit("VSL"), F.col("l_suppkey").cast("string")), F.lit("R1"),
        F.when(order % 41 != 0, stamp(etd - F.make_dt_interval(mins=minutes))), stamp(etd), F.lit("-"),
        F.concat_ws("/", (line * 1000).cast("string"), F.col("l_quantity").cast("int").cast("string")),
        F.when(line % 3 != 0, F.format_number(F.col("l_quantity") * 100, 0)), F.lit("y"), F.lit("x"),
    )
    row = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", cells.alias("cells"))
    # one file per hundred orders, so a group has a fixed size
    grouped = tb.table(spark, sf, "lineitem").groupBy(piece.alias("piece"), no.cast("int").alias("terminal_no")).agg(
        F.transform(F.array_sort(F.collect_list(row)), lambda r: r["cells"]).alias("body"))
    title = F.array(F.lit("title"), *[F.lit(None).cast("string")] * (len(HISTORY_HEADERS) - 1))
    head = F.array(*[F.lit(h) for h in HISTORY_HEADERS])
    rows = F.when(F.col("piece") % 2 == 0, F.concat(F.array(head), F.col("body"))).otherwise(
        F.concat(F.array(title, title, head), F.col("body")))
    name = F.concat(F.col("terminal_no").cast("string"), F.lit("부두_"), (F.col("piece") % 5 + 2021).cast("string"), F.lit("_"),
                    F.col("piece").cast("string"), F.lit(".xlsx"))
    return grouped.select(
        name.alias("file_name"), files.terminal_of_history_file(name).alias("terminal_no"), rows.alias("rows"))


HISTORY_SQL = """
h0 AS (
  SELECT *, l_orderkey // 100 AS piece, CAST(l_orderkey // 100 % 7 + 1 AS INT) AS tno,
    l_shipdate + to_hours((l_orderkey % 24)::INT) AS etd,
    CASE WHEN l_orderkey % 31 = 0 THEN 14400 WHEN l_orderkey % 37 = 0 THEN -60 ELSE l_linenumber * 60 END AS minutes,
    tno || '부두_' || (piece % 5 + 2021) || '_' || piece || '.xlsx' AS file_name
  FROM lineitem),
h1 AS (
  SELECT *, etd - to_minutes(minutes::INT) AS eta,
    row_number() OVER (PARTITION BY file_name ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity) - 1 AS pos
  FROM h0 WHERE l_orderkey % 41 <> 0 AND minutes >= 0 AND minutes < 14400),
hist AS (
  SELECT 'terminal_' || tno AS terminal_id, tno, file_name AS source_file_name,
    'hist_' || tno || '_' || (piece % 5 + 2021) AS snapshot_id,
    'hist_' || lpad(tno::VARCHAR, 2, '0') || '_' || (piece % 5 + 2021) || '_' || lpad(pos::VARCHAR, 5, '0') AS bronze_row_id,
    CAST(pos + 1 AS VARCHAR) AS source_row_number, 'B' || (l_partkey % 4) AS berth,
    CASE WHEN l_linenumber % 5 <> 0 THEN 'C' || (l_suppkey % 5) ELSE 'nan' END AS carrier,
    'MV' || l_orderkey AS mother_vessel, 'nan' AS sun_vessel, 'VSL' || l_suppkey AS vessel_name, 'R1' AS route, 'y' AS amp,
    eta, etd, CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_quantity * 100 AS INT) ELSE 0 END AS discharge,
    CAST(l_quantity AS INT) AS loading, 0 AS shift, true AS is_valid,
    CAST(CAST(eta - INTERVAL 6 HOUR AS DATE) AS VARCHAR) AS eta_work_date
  FROM h1)"""
HISTORY_OUT = ["terminal_id", "source_file_name", "snapshot_id", "bronze_row_id", "source_row_number", "berth", "carrier",
               "mother_vessel", "sun_vessel", "vessel_name", "route", "amp", "eta", "etd", "discharge", "loading", "shift",
               "is_valid", "eta_work_date", "business_key", "row_hash", "total_workload", "is_amp"]


@query("historical_silver", f"""WITH {HISTORY_SQL} SELECT *
  EXCLUDE (tno), concat_ws('_', terminal_id, mother_vessel, sun_vessel, eta_work_date) AS business_key,
  md5(berth || vessel_name || strftime(eta, '%Y-%m-%d %H:%M:%S') || strftime(etd, '%Y-%m-%d %H:%M:%S')) AS row_hash,
  discharge + loading + shift AS total_workload, 1 AS is_amp FROM hist""")
def historical_silver(spark, sf):
    return silver.historical_silver(history_sheets(spark, sf)).select(*HISTORY_OUT)


@query("auto_header_promote", """WITH h AS (SELECT DISTINCT l_orderkey // 100 AS piece FROM lineitem)
SELECT (piece % 7 + 1) || '부두_' || (piece % 5 + 2021) || '_' || piece || '.xlsx' AS file_name,
  CAST(CASE WHEN piece % 2 = 0 THEN 0 ELSE 2 END AS INT) AS header_row FROM h""")
def auto_header_promote(spark, sf):
    return history_sheets(spark, sf).select(
        "file_name", silver.promoted_header(F.col("rows")).alias("header_row"))


@query("normalize_column_names", """WITH h AS (SELECT l_orderkey // 100 AS piece, count(*) AS data_rows FROM lineitem GROUP BY 1)
SELECT (piece % 7 + 1) || '부두_' || (piece % 5 + 2021) || '_' || piece || '.xlsx' AS file_name,
  'berth, carrier, mother_vessel, sun_vessel, vessel_name, route, eta, etd, closing, 작업량' || chr(10) ||
  '양하/적하/Shift, discharge, amp, 비고' AS names, CAST(data_rows AS INT) AS data_rows FROM h""")
def normalize_column_names(spark, sf):
    return silver.with_header(history_sheets(spark, sf)).select("file_name", "names", F.size("data").alias("data_rows"))


UNION_OUT = ["terminal_id", "bronze_row_id", "berth", "vessel_name", "eta", "etd", "discharge", "loading", "shift"]
UNION_SQL = f"""WITH {tf.RAW_SILVER_SQL}, {HISTORY_SQL}
SELECT {', '.join(UNION_OUT)} FROM raw_silver UNION ALL SELECT {', '.join(UNION_OUT)} FROM hist"""


@query("union_history", UNION_SQL)
def union_history(spark, sf):
    live = raw_silver(spark, sf)
    return silver.union_history(live, silver.historical_silver(history_sheets(spark, sf))).select(*UNION_OUT)


@query("scan_history_optional", UNION_SQL)
def scan_history_optional(spark, sf):
    """History is stored and found by its path; a path that does not exist adds nothing."""
    path = scratch_path(spark, "history")
    sinks.write_table(silver.historical_silver(history_sheets(spark, sf)), path)
    live = raw_silver(spark, sf)
    live = silver.union_history(live, tables.scan_optional(spark, path + "-absent"))
    return silver.union_history(live, tables.scan_optional(spark, path)).select(*UNION_OUT)


# ------------------------------------------------------------------ sinks

@query("write_overwrite_table", f"WITH {tb.SILVER_SQL} SELECT terminal_id, count(*) AS row_count FROM silver GROUP BY terminal_id")
def write_overwrite_table(spark, sf):
    """Written twice: the second write replaces rows and schema of the first."""
    path, df = scratch_path(spark, "table"), tb.silver_schedule(spark, sf)
    sinks.write_table(df.select("terminal_id"), path)
    stored = sinks.write_table(df, path, view="berthlake_silver_schedule")
    return spark.table("berthlake_silver_schedule").filter("row_hash is not null").groupBy("terminal_id").agg(
        F.count("*").alias("row_count")) if stored.columns else stored


@query("write_staging_with_manifest", f"""WITH {tf.RAW_SQL}
SELECT file_name AS file, regexp_replace(file_name, '\\.[^.]*$', '') || '.parquet' AS parquet_file, tno AS terminal_no,
  CAST(count(*) AS INT) AS rows, CAST(max(len({tf.sql_by_terminal(tf.sql_list)})) AS INT) AS cols,
  max(array_to_string({tf.sql_by_terminal(tf.sql_headers)}, ', ')) AS columns, count(*) AS staged_rows
FROM raw GROUP BY file_name, tno""")
def write_staging_with_manifest(spark, sf):
    rows, manifest = sinks.write_staging(decoded(spark, sf), scratch_path(spark, "staging"))
    staged = rows.groupBy(F.col("source_file_name").alias("file")).agg(F.count("*").alias("staged_rows"))
    return manifest.join(staged, "file")


@query("flatten_arrays", """SELECT o_custkey, coalesce(string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority), '') AS priorities
FROM orders GROUP BY o_custkey""")
def flatten_arrays(spark, sf):
    grouped = tb.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"))
    return sinks.flatten_arrays(grouped)
