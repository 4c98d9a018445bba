"""First table of an HTML page, and first sheet of a spreadsheet, as lists of text cells.

Small file parsers on the standard library; they run inside tasks, one file at a time.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import sys
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle

# Workers get the code of this module with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def encoding_of(page: bytes) -> str:
    """Pages are UTF-8 or in the Korean code page. Their own label is often misspelt, so only the bytes decide."""
    survives = page.decode("utf-8", "ignore").encode("utf-8")
    return "utf-8" if survives == page else "cp949"


class _FirstTable(HTMLParser):
    """Collects the first table: per row a list of (text, is_heading), with spans resolved."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.done, self.in_head = 0, False, False
        self.rows, self.row, self.cell, self.pending = [], None, None, {}

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if tag == "table":
            self.depth += 1
        elif self.depth == 1:
            if tag == "thead":
                self.in_head = True
            elif tag == "tr":
                self._end_row()
                self.row = []
            elif tag in ("td", "th"):
                self._end_cell()
                if self.row is None:
                    self.row = []
                span = dict(attrs)
                self.cell = {
                    "text": [],
                    "head": tag == "th" or self.in_head,
                    "cols": int(span.get("colspan") or 1),
                    "rows": int(span.get("rowspan") or 1),
                }
            elif tag == "br" and self.cell is not None:
                self.cell["text"].append("\n")

    def handle_endtag(self, tag):
        if self.done or not self.depth:
            return
        if tag == "table":
            self.depth -= 1
            if self.depth == 0:
                self._end_row()
                self.done = True
        elif self.depth == 1:
            if tag in ("td", "th"):
                self._end_cell()
            elif tag == "tr":
                self._end_row()
            elif tag == "thead":
                self._end_row()
                self.in_head = False

    def handle_data(self, data):
        if self.cell is not None and not self.done:
            self.cell["text"].append(data)

    def _fill_pending(self):
        while self.pending.get(len(self.row), (0, None))[0] > 0:
            left, value = self.pending[len(self.row)]
            self.pending[len(self.row)] = (left - 1, value)
            self.row.append(value)

    def _end_cell(self):
        if self.cell is None:
            return
        self._fill_pending()
        value = ("".join(self.cell["text"]).strip() or None, self.cell["head"])
        for _ in range(self.cell["cols"]):
            if self.cell["rows"] > 1:
                self.pending[len(self.row)] = (self.cell["rows"] - 1, value)
            self.row.append(value)
        self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.row is not None:
            self._fill_pending()
            if self.row:
                self.rows.append(self.row)
        self.row = None


def html_table(content: bytes) -> tuple[list[list[str | None]], int]:
    """Rows of the first table, and how many leading rows are headings."""
    parser = _FirstTable()
    parser.feed(str(content, encoding_of(content), "replace"))
    parser.close()
    if not parser.rows:
        raise ValueError("no table found")
    heads = 0
    while heads < len(parser.rows) and all(head for _, head in parser.rows[heads]):
        heads += 1
    return [[value for value, _ in row] for row in parser.rows], heads


_BUILTIN_DATE_FORMATS = set(range(14, 23)) | set(range(45, 48))


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell styles that show a number as a date."""
    if "xl/styles.xml" not in archive.namelist():
        return set()
    root = ElementTree.fromstring(archive.read("xl/styles.xml"))
    custom = {
        int(f.get("numFmtId"))
        for f in root.iterfind("{*}numFmts/{*}numFmt")
        if re.search(r"[ymdhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")).lower())
    }
    dates = _BUILTIN_DATE_FORMATS | custom
    styles = root.findall("{*}cellXfs/{*}xf")
    return {i for i, xf in enumerate(styles) if int(xf.get("numFmtId", 0)) in dates}


def _first_sheet(archive: zipfile.ZipFile) -> str:
    book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
    links = ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))
    sheet = book.find("{*}sheets/{*}sheet")
    link_id = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
    target = next(r.get("Target") for r in links if r.get("Id") == link_id)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def xlsx_table(content: bytes) -> list[list[str | None]]:
    """Cells of the first sheet as text; absent cells and rows are filled in."""
    archive = zipfile.ZipFile(io.BytesIO(content))
    shared = []
    if "xl/sharedStrings.xml" in archive.namelist():
        for item in ElementTree.fromstring(archive.read("xl/sharedStrings.xml")):
            shared.append("".join(t.text or "" for t in item.iterfind(".//{*}t")))
    dates = _date_styles(archive)
    rows: list[list[str | None]] = []
    with archive.open(_first_sheet(archive)) as sheet:
        for _, node in ElementTree.iterparse(sheet):
            if not node.tag.endswith("}row"):
                continue
            while len(rows) < int(node.get("r", len(rows) + 1)) - 1:
                rows.append([])
            row: list[str | None] = []
            for cell in node.iterfind("{*}c"):
                letters = re.match(r"[A-Z]*", cell.get("r", "")).group()
                column = 0
                for letter in letters:
                    column = column * 26 + ord(letter) - 64
                while len(row) < column - 1:
                    row.append(None)
                row.append(_cell_text(cell, shared, dates))
            rows.append(row)
            node.clear()
    width = max((len(r) for r in rows), default=0)
    return [r + [None] * (width - len(r)) for r in rows]


def _cell_text(cell, shared: list[str], dates: set[int]) -> str | None:
    kind, value = cell.get("t", "n"), cell.findtext("{*}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iterfind(".//{*}t")) or None
    if value is None:
        return None
    if kind == "s":
        return shared[int(value)] or None
    if kind == "n" and int(cell.get("s", 0)) in dates:
        moment = dt.datetime(1899, 12, 30) + dt.timedelta(days=float(value))
        return str((moment + dt.timedelta(milliseconds=500)).replace(microsecond=0))
    return value


CHUNK_BYTES = 1 << 20  # contents that are decoded before their rows leave the worker


def decode_one(name: str, content: bytes | None) -> tuple:
    """Rows, heading rows and error of a file; no content means nothing to do."""
    rows, heads, error = None, 0, None
    if content is not None:
        try:
            if name.endswith(".xlsx"):
                rows = xlsx_table(content)
            else:
                rows, heads = html_table(content)
        except Exception as e:  # a bad file is recorded, the others go on
            error = f"{type(e).__name__}: {e}"
    return rows, heads, error


def decode_batches(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Arrow batches of (name, content) -> rows, heading rows, error.

    Decoded tables are many times larger than files, so they leave in chunks of few files: a worker holds one chunk, however many
    files its task has.
    """
    for names, contents in batches:
        out, held = [], 0
        for name, content in zip(names, contents):
            out.append(decode_one(name, content))
            held += 1024 + len(content or b"")
            if held >= CHUNK_BYTES:
                yield pd.DataFrame(out, columns=["rows", "head_rows", "error"])
                out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=["rows", "head_rows", "error"])
