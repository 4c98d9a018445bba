"""Raw snapshot files (HTML, spreadsheet, dataset XML) written from the events table.

Every file holds FILE_ROWS consecutive events, so a file has a fixed size and their number grows
with the table.
"""

from __future__ import annotations

import io
import sys
import zipfile
from xml.sax.saxutils import escape

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from berthlake import fixed_values as fv, testbed as tb

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_ROWS = 500
SUFFIX = {1: "xls", 2: "xls", 3: "xlsx", 4: "xls", 5: "xlsx", 6: "xml", 7: "xlsx"}
NAMESPACE = "http://www.nexacroplatform.com/platform/dataset"


def xlsx_bytes(rows) -> bytes:
    """A minimal workbook with one sheet of inline strings."""
    def ref(i, j):
        return f"{chr(65 + j)}{i + 1}"

    body = "".join(
        f'<row r="{i + 1}">' + "".join(
            f'<c r="{ref(i, j)}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
            for j, v in enumerate(row) if v
        ) + "</row>"
        for i, row in enumerate(rows)
    )
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
                           '<sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}"><Relationship Id="rId1" '
                                      f'Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in parts.items():
            archive.writestr(name, content)
    return out.getvalue()


def xlsx_or_none(rows) -> bytes | None:
    return None if rows is None else xlsx_bytes(rows)


# without Arrow a worker is given a hundred tables at a time; an Arrow batch takes thousands
_xlsx = F.udf(xlsx_or_none, T.BinaryType(), useArrow=False)


def event_texts(events: DataFrame) -> DataFrame:
    """The texts a terminal would show for each event, by canonical column."""
    e, u = F.col("event_id"), F.col("user_id")
    ts = F.col("ts").cast("timestamp_ntz")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    piece = F.floor(e / FILE_ROWS)
    terminal = (piece % 7 + 1).cast("int")
    label = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    discharge = F.when(e % 23 == 0, "12.0").otherwise(F.format_number(k * 37, 0))
    loading, shift = F.format_number(F.floor("value") * 30, 0), (e % 3 * 5).cast("string")
    texts = {
        "berth": F.when(e % 26 == 0, "").otherwise(label("B", u % 3 + e % 2)),
        "carrier": F.when(e % 19 == 0, "None").otherwise(label("C", u % 5)),
        "vessel_name": F.when(e % 13 == 0, "").otherwise(label("VSL", u)),
        "mother_vessel": F.when(e % 17 == 0, "nan").otherwise(label("MV", u)),
        "sun_vessel": label("SV", u % 11),
        "head_bridge_stern": F.lit("H"),
        "route": label("R", u % 9),
        "eta": F.when(e % 101 == 0, "").otherwise(F.date_format(ts, "yyyy/MM/dd HH:mm")),
        "etd": F.date_format(ts + F.make_dt_interval(hours=(e % 40).cast("int")), "yyyy-MM-dd HH:mm"),
        "closing": F.when(e % 11 == 0, "-").otherwise(F.date_format(ts - F.expr("INTERVAL 5 HOURS"), "yyyy.MM.dd HH:mm")),
        "discharge": discharge,
        "loading": loading,
        "shift": shift,
        "amp": F.when(e % 4 == 0, "Y").otherwise("n"),
        "status": F.col("event_type"),
        fv.WORKLOAD: F.concat(discharge, F.lit(" / "), loading, F.lit("／"), shift),
        fv.DROP: F.lit("x"),
    }
    hour = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=piece.cast("int"))
    suffix = F.try_element_at(F.create_map(*[F.lit(x) for p in SUFFIX.items() for x in p]), terminal)
    return events.select(
        e.alias("e"), terminal.alias("terminal_no"), F.date_format(hour, "yyyyMMdd_HH").alias("stamp"), suffix.alias("suffix"),
        *[c.alias(f"v_{n}") for n, c in texts.items()],
    )


def _cells(terminal: int) -> Column:
    return F.array(*[F.col(f"v_{std}") for std in fv.COLUMN_MAPS[terminal].values()])


def _table_rows(headers: bool = True) -> Column:
    """Header rows in front of the data rows ``rows``, where the terminal has any."""
    out = F.when(F.lit(False), F.col("rows"))
    for t, names in fv.COLUMN_MAPS.items():
        head = []
        if fv.HEADER_ROW[t] == 1:
            head.append(F.array(F.lit("title"), *[F.lit("")] * (len(names) - 1)))
        if fv.HEADER_ROW[t] is not None and SUFFIX[t] != "xml":
            head.append(F.array(*[F.lit(n) for n in names]))
        rows = F.concat(F.array(*head), F.col("rows")) if head else F.col("rows")
        out = out.when(F.col("terminal_no") == t, rows)
    return out


def _html(rows: Column) -> Column:
    line = lambda r: F.concat(F.lit("<tr><td>"), F.array_join(r, "</td><td>"), F.lit("</td></tr>\n"))
    return F.concat(
        F.lit("<html><head><meta charset=udf-8></head><body><table>\n"),
        F.array_join(F.transform(rows, line), ""),
        F.lit("</table><table><tr><td>second</td></tr></table></body></html>"),
    )


def _xml(rows: Column) -> Column:
    ids = list(fv.COLUMN_MAPS[6])
    columns = "".join(f'<Column id="{i}" type="STRING" size="256"/>' for i in ids)
    open_tags = F.array(*[F.lit(f'<Col id="{i}">') for i in ids])

    def line(r):
        cols = F.zip_with(open_tags, r, lambda t, v: F.when(v == "", "").otherwise(F.concat(t, v, F.lit("</Col>"))))
        return F.concat(F.lit("<Row>"), F.array_join(cols, ""), F.lit("</Row>\n"))

    return F.concat(
        F.lit(f'<?xml version="1.0" encoding="UTF-8"?>\n<Root xmlns="{NAMESPACE}"><Parameters/>'
              f'<Dataset id="ds"><ColumnInfo>{columns}</ColumnInfo><Rows>\n'),
        F.array_join(F.transform(rows, line), ""),
        F.lit("</Rows></Dataset></Root>"),
    )


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, content - the shape of the binary file reader."""
    texts = event_texts(tb.table(spark, sf_dir, "events"))
    cells = F.when(F.lit(False), F.array().cast("array<string>"))
    for t in fv.COLUMN_MAPS:
        cells = cells.when(F.col("terminal_no") == t, _cells(t))
    # FILE_ROWS rows per group, by construction
    pieces = (
        texts.select("terminal_no", "stamp", "suffix", F.struct("e", cells.alias("cells")).alias("row"))
        .groupBy("terminal_no", "stamp", "suffix")
        .agg(F.transform(F.array_sort(F.collect_list("row")), lambda r: r["cells"]).alias("rows"))
        .withColumn("rows", _table_rows())
    )
    xlsx = _xlsx(F.when(F.col("suffix") == "xlsx", F.col("rows")))
    content = (
        F.when(F.col("suffix") == "xls", _html(F.col("rows")).cast("binary"))
        .when(F.col("suffix") == "xml", _xml(F.col("rows")).cast("binary"))
        .otherwise(xlsx)
    )
    name = F.concat(
        F.lit("terminal_"), F.col("terminal_no").cast("string"), F.lit("_schedule_"), F.col("stamp"),
        F.lit("."), F.col("suffix"),
    )
    return pieces.select(F.concat(F.lit("file:/raw/"), name).alias("path"), content.alias("content"))


RAW_SQL = f"""
raw0 AS (
  SELECT event_id AS e, user_id AS u, ts, event_type, value,
    CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k, event_id // {FILE_ROWS} AS piece,
    CAST(event_id // {FILE_ROWS} % 7 + 1 AS INT) AS tno,
    CAST(event_id % {FILE_ROWS} + 1 AS INT) AS r
  FROM events),
raw AS (
  SELECT e, u, ts, k, value, event_type, piece, tno, r,
    strftime(TIMESTAMP '2024-01-01' + to_hours(piece::INT), '%Y%m%d_%H') AS stamp,
    TIMESTAMP '2024-01-01' + to_hours(piece::INT) AS snapshot_ts,
    'terminal_' || tno || '_schedule_' || strftime(TIMESTAMP '2024-01-01' + to_hours(piece::INT), '%Y%m%d_%H')
      || CASE WHEN tno IN (1, 2, 4) THEN '.xls' WHEN tno = 6 THEN '.xml' ELSE '.xlsx' END AS file_name,
    CASE WHEN e % 26 <> 0 THEN 'B' || (u % 3 + e % 2) END AS v_berth,
    CASE WHEN e % 19 = 0 THEN 'None' ELSE 'C' || (u % 5) END AS v_carrier,
    CASE WHEN e % 13 <> 0 THEN 'VSL' || u END AS v_vessel_name,
    CASE WHEN e % 17 = 0 THEN 'nan' ELSE 'MV' || u END AS v_mother_vessel,
    'SV' || (u % 11) AS v_sun_vessel, 'H' AS v_head_bridge_stern, 'R' || (u % 9) AS v_route,
    CASE WHEN e % 101 <> 0 THEN strftime(ts, '%Y/%m/%d %H:%M') END AS v_eta,
    strftime(ts + to_hours((e % 40)::INT), '%Y-%m-%d %H:%M') AS v_etd,
    CASE WHEN e % 11 = 0 THEN '-' ELSE strftime(ts - INTERVAL 5 HOUR, '%Y.%m.%d %H:%M') END AS v_closing,
    CASE WHEN e % 23 = 0 THEN '12.0' ELSE format('{{:,}}', k * 37) END AS v_discharge,
    format('{{:,}}', CAST(floor(value) AS BIGINT) * 30) AS v_loading, CAST(e % 3 * 5 AS VARCHAR) AS v_shift,
    CASE WHEN e % 4 = 0 THEN 'Y' ELSE 'n' END AS v_amp, event_type AS v_status,
    (CASE WHEN e % 23 = 0 THEN '12.0' ELSE format('{{:,}}', k * 37) END) || ' / ' ||
      format('{{:,}}', CAST(floor(value) AS BIGINT) * 30) || '／' || CAST(e % 3 * 5 AS VARCHAR) AS v__workload,
    'x' AS v__drop
  FROM raw0)"""


def sql_list(terminal: int) -> str:
    return "[" + ", ".join(f"v_{std}" for std in fv.COLUMN_MAPS[terminal].values()) + "]"


def sql_headers(terminal: int) -> str:
    names = [n if fv.HEADER_ROW[terminal] is not None else f"col_{i + 1}"
             for i, n in enumerate(fv.COLUMN_MAPS[terminal])]
    return "[" + ", ".join("'" + n.replace("'", "''") + "'" for n in names) + "]"


def sql_by_terminal(make) -> str:
    return "CASE tno " + " ".join(f"WHEN {t} THEN {make(t)}" for t in fv.COLUMN_MAPS) + " END"


# canonical values as the silver table has them
_KNOWN = {std: [t for t, m in fv.COLUMN_MAPS.items() if std in m.values()]
          for std in ("berth", "carrier", "vessel_name", "mother_vessel", "sun_vessel", "head_bridge_stern",
                      "route", "amp", "status")}
RAW_SILVER_SQL = RAW_SQL + """,
raw_silver0 AS (
  SELECT e, tno, r, stamp, snapshot_ts, file_name,
    'terminal_' || tno AS terminal_id, tno || '_' || stamp AS snapshot_id,
    'brz_' || lpad(tno::VARCHAR, 2, '0') || '_' || stamp || '_' || lpad(r::VARCHAR, 4, '0') AS bronze_row_id,
    """ + ",\n    ".join(
    f"CASE WHEN tno IN ({', '.join(map(str, ts))}) AND v_{std} NOT IN ('nan', 'None') THEN v_{std} END AS {std}"
    for std, ts in _KNOWN.items()) + """,
    CASE WHEN e % 101 <> 0 THEN date_trunc('minute', ts) END AS eta,
    date_trunc('minute', ts + to_hours((e % 40)::INT)) AS etd,
    CASE WHEN e % 11 <> 0 AND tno <> 6 THEN date_trunc('minute', ts - INTERVAL 5 HOUR) END AS closing,
    CASE WHEN e % 23 <> 0 THEN k * 37 END AS discharge,
    CAST(floor(value) AS INT) * 30 AS loading, CAST(e % 3 * 5 AS INT) AS shift
  FROM raw),
raw_silver AS (
  SELECT *, NOT (berth IS NULL AND vessel_name IS NULL) AS is_valid,
    CASE WHEN berth IS NULL AND vessel_name IS NULL THEN '선석/선명 모두 없음' END AS error_msg,
    CASE tno WHEN 1 THEN 'PNIT' WHEN 2 THEN 'PNC' WHEN 3 THEN 'HJNC' WHEN 4 THEN 'HPNT'
      WHEN 5 THEN 'BNCT' WHEN 6 THEN 'BCT' ELSE 'DGT' END AS terminal_name,
    CAST(CAST(eta - INTERVAL 6 HOUR AS DATE) AS VARCHAR) AS eta_work_date,
    concat_ws('_', terminal_id, mother_vessel, sun_vessel, CAST(CAST(eta - INTERVAL 6 HOUR AS DATE) AS VARCHAR)) AS business_key,
    CAST(CAST(eta AS DATE) AS VARCHAR) AS eta_date,
    coalesce(discharge, 0) + coalesce(loading, 0) + coalesce(shift, 0) AS total_workload,
    CAST(hour(eta) AS INT) AS eta_hour, CAST(dayofweek(eta) + 1 AS INT) AS eta_dayofweek,
    CASE WHEN amp = 'Y' THEN 1 ELSE 0 END AS is_amp
  FROM raw_silver0)"""
