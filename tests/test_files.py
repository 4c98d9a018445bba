"""Real files on disk: HTML in two charsets, workbooks, dataset XML, broken files; batch and stream."""

import datetime as dt
import io
import os
import zipfile

import pytest

from berthlake.operators import bronze as bz
from berthlake.plans import silver
from berthlake.sources import files, parsers, sheets
from berthlake.streaming import ingest
from berthlake.testbed_files import xlsx_bytes

XML = """<?xml version="1.0" encoding="UTF-8"?><Root xmlns="http://example.org/dataset"><Dataset id="ds"><ColumnInfo>
<Column id="plvBerth"/><Column id="cdvName"/><Column id="plvAtb"/></ColumnInfo><Rows>
<Row><Col id="plvBerth">B1</Col><Col id="plvAtb">2026-06-26 05:00</Col></Row>
<Row><Col id="cdvName">A &amp; B</Col><Col id="other">x</Col></Row></Rows></Dataset></Root>"""


def html(rows, charset="udf-8"):
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f"<html><meta charset={charset}><table><tbody>{body}</table><table><tr><td>no</td></tr></table></html>"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    row = ["B1", "C", "MV1", "SV", "H", "선박", "R", "-", "2026-06-26 07:00", "2026-06-26 09:00", "1,200", "", "3", "Y", "ok"]
    (base / "terminal_1_schedule_20260626_10.xls").write_bytes(html([row]).encode("utf-8"))
    (base / "pnc_20260626_11.xls").write_bytes(html([["x", "한글배", *["1"] * 15]]).encode("cp949"))
    (base / "dgt_20260626_12.xlsx").write_bytes(xlsx_bytes([
        ["선석", "선사코드", "작업량\n양하/적하/Shift", "상태"], ["B7", "C7", "1,015 / 960 / 12", "ok"], ["", "", "", "x"]]))
    (base / "bct_20260626_10.xml").write_text(XML, encoding="utf-8")
    (base / "terminal_6_schedule_20260626_13.xml").write_text("<Root><Dataset/></Root>")
    (base / "terminal_3_schedule_20260626_10.xlsx").write_bytes(b"broken")
    (base / "unknown_20260626_10.xls").write_bytes(html([["a"]]).encode())
    (base / "notes.txt").write_text("ignored")
    return str(base)


def test_listing(spark, folder):
    listed = files.file_listing(spark, folder).collect()
    assert [r.name for r in listed] == sorted(n for n in os.listdir(folder) if n != "notes.txt")
    assert all(r.size == os.path.getsize(os.path.join(folder, r.name)) for r in listed)


def test_ingest(spark, folder):
    found = sheets.decode(files.raw_files(spark, folder)).cache()
    failed = {r.file_name: r.error for r in sheets.failed(found).collect()}
    assert set(failed) == {"terminal_6_schedule_20260626_13.xml", "terminal_3_schedule_20260626_10.xlsx", "unknown_20260626_10.xls"}
    rows = silver.silver_from_bronze(bz.bronze(found)).collect()
    by_id = {r.bronze_row_id: r for r in rows}
    first = by_id["brz_01_20260626_10_0001"]
    assert (first.berth, first.vessel_name, first.discharge, first.loading, first.shift, first.is_amp) == ("B1", "선박", 1200, None, 3, 1)
    assert first.eta == dt.datetime(2026, 6, 26, 7) and first.closing is None and first.eta_work_date == "2026-06-26"
    assert by_id["brz_02_20260626_11_0001"].vessel_name == "한글배"
    seven = by_id["brz_07_20260626_12_0001"]
    assert (seven.discharge, seven.loading, seven.shift, seven.total_workload) == (1015, 960, 12, 1987)
    assert not by_id["brz_07_20260626_12_0002"].is_valid
    xml = by_id["brz_06_20260626_10_0001"], by_id["brz_06_20260626_10_0002"]
    assert (xml[0].berth, xml[0].vessel_name, xml[0].eta_work_date) == ("B1", None, "2026-06-25")
    assert (xml[1].berth, xml[1].vessel_name) == (None, "A & B")


def test_stream_reads_each_file_once(spark, folder, tmp_path):
    out, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    for _ in range(2):
        ingest.ingest(ingest.raw_file_stream(spark, folder, files_per_batch=2), out, log).awaitTermination()
    assert spark.read.parquet(out).count() == 6


def test_html_spans_and_headings():
    page = "<table><thead><tr><th>a<th>b</tr></thead><tr><td rowspan=2>x<td>1</tr><tr><td>2</tr><tr><td colspan=2>y</table>"
    assert parsers.html_table(page.encode()) == ([["a", "b"], ["x", "1"], ["x", "2"], ["y", "y"]], 1)


def test_workbook_dates_and_gaps():
    raw = xlsx_bytes([["a"]])
    sheet = ('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
             '<row r="2"><c r="B2" s="1"><v>46199.4375</v></c><c r="D2"><v>12</v></c></row></sheetData></worksheet>')
    styles = ('<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><cellXfs>'
              '<xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(raw)) as src, zipfile.ZipFile(out, "w") as dst:
        for n in src.namelist():
            dst.writestr(n, sheet if n.endswith("sheet1.xml") else src.read(n))
        dst.writestr("xl/styles.xml", styles)
    assert parsers.xlsx_table(out.getvalue()) == [[None] * 4, [None, "2026-06-26 10:30:00", None, "12"]]


def test_encoding_of_a_page_with_a_misspelt_label():
    from berthlake.sources import parsers

    page = '<meta charset="udf-8"><table><tr><th>부두</th></tr><tr><td>신선대 é</td></tr></table>'
    assert parsers.encoding_of(page.encode()) == "utf-8" and parsers.encoding_of(b"") == "utf-8"
    korean = page.replace(" é", "").encode("cp949")
    assert parsers.encoding_of(korean) == "cp949" and "신선대" in str(korean, "cp949")
    # one spoilt byte makes a page no UTF-8; what the code page does not know is replaced
    spoilt = page.encode() + b"\xff"
    assert parsers.encoding_of(spoilt) == "cp949" and str(spoilt, "cp949", "replace")
