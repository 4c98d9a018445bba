"""Decoded files -> bronze rows: header rules, metadata, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from berthlake import fixed_values as fv
from berthlake.functions import text
from berthlake.functions.barrier import compute_once
from berthlake.sources import files


def rows_from(rows: Column, start: Column) -> Column:
    """Rows from the 0-based position on."""
    return F.slice(rows, start + 1, F.greatest(F.size(rows) - start, F.lit(0)))


def apply_header_rule(sheets: DataFrame) -> DataFrame:
    """Replace ``rows`` by ``names`` and ``data``, following the rule of the terminal."""
    header_row = F.try_element_at(
        text.literal_map({t: k for t, k in fv.HEADER_ROW.items() if k is not None}), F.col("terminal_no")
    )
    width = F.array_max(F.transform("rows", lambda r: F.size(r)))
    numbered = F.transform(F.sequence(F.lit(1), width), lambda i: F.concat(F.lit("col_"), i.cast("string")))
    first = F.when(header_row.isNull(), F.coalesce(F.col("head_rows"), F.lit(0))).otherwise(header_row + 1)
    known = F.col("terminal_no").isin(list(fv.HEADER_ROW))
    error = F.coalesce(
        F.col("error"),
        F.when(~known, F.concat(F.lit("no header rule for terminal_"), F.col("terminal_no").cast("string"))),
    )
    return sheets.select(
        "path", "file_name", "terminal_no",
        F.when(header_row.isNull(), numbered).otherwise(F.get("rows", header_row)).alias("names"),
        rows_from(F.col("rows"), first).alias("data"),
        error.alias("error"),
    )


SHORT_ESCAPES = {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}


def _escaped(c: Column) -> Column:
    """Text inside a JSON string: backslash, quote and every control character; the latter are rare and tried for first."""
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    out = plain = F.replace(out, F.lit('"'), F.lit('\\"'))
    for char in map(chr, range(32)):
        out = F.replace(out, F.lit(char), F.lit(SHORT_ESCAPES.get(char, f"\\u{ord(char):04x}")))
    return F.when(c.rlike("[\\x00-\\x1f]"), out).otherwise(plain)


def json_names(names: Column) -> Column:
    """The '"name": ' part of every column, made once per file."""
    return F.transform(
        names, lambda n: F.concat(F.lit('"'), _escaped(F.coalesce(n, F.lit("nan"))), F.lit('": '))
    )


def row_json(json_names_: Column, values: Column) -> Column:
    quoted = lambda v: F.coalesce(F.concat(F.lit('"'), _escaped(v), F.lit('"')), F.lit("NaN"))
    pairs = F.zip_with(json_names_, values, lambda n, v: F.concat(n, quoted(v)))
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def bronze(sheets: DataFrame) -> DataFrame:
    """One row per source row with its cells (``names``, ``values``) and metadata. No shuffle."""
    ruled = apply_header_rule(sheets).filter("error IS NULL")
    ruled = compute_once(ruled, _names=json_names(F.col("names")))
    ruled = compute_once(ruled, _jsons=F.transform("data", lambda v: row_json(F.col("_names"), v)))
    ruled = ruled.withColumn(
        "file_hash", F.md5(F.concat(F.lit("["), F.array_join("_jsons", ","), F.lit("]")))
    )
    ts = files.snapshot_ts_of_file("file_name")
    ruled = ruled.withColumn("snapshot_ts", ts).withColumn("_hour", F.date_format("snapshot_ts", "yyyyMMdd_HH"))
    exploded = ruled.select(
        "file_name", "terminal_no", "names", "file_hash", "snapshot_ts", "_hour",
        F.posexplode(F.arrays_zip("data", F.col("_jsons").alias("json"))).alias("_pos", "_row"),
    )
    no = F.col("terminal_no").cast("string")
    number = F.col("_pos") + 1
    padded = text.zero_padded(number, 4)
    return exploded.select(
        "terminal_no",
        F.concat(F.lit("terminal_"), no).alias("terminal_id"),
        F.concat(no, F.lit("_"), F.col("_hour")).alias("snapshot_id"),
        "snapshot_ts",
        F.col("file_name").alias("source_file_name"),
        F.concat(F.lit("/raw/terminal_"), no, F.lit("/"), F.col("file_name")).alias("source_file_path"),
        F.lit("Sheet1").alias("source_sheet_name"),
        number.alias("source_row_number"),
        number.alias("data_row_number"),
        F.col("_row.json").alias("raw_row_json"),
        F.md5(F.col("_row.json")).alias("row_hash"),
        "file_hash",
        F.current_timestamp().alias("ingested_at"),
        F.col("snapshot_ts").alias("downloaded_at"),
        F.concat_ws("_", F.lit("brz"), text.zero_padded(no, 2), F.col("_hour"), padded).alias("bronze_row_id"),
        "names",
        F.col("_row.data").alias("values"),
    )


META = ["terminal_id", "snapshot_id", "source_file_name", "source_row_number", "bronze_row_id", "row_hash"]


def wide(bronze_rows: DataFrame, terminal_no: int) -> DataFrame:
    """Bronze rows of one terminal with one text column per source header."""
    rows = bronze_rows.filter(F.col("terminal_no") == terminal_no)
    headers = list(fv.COLUMN_MAPS[terminal_no])
    return rows.select(
        *META, *[cell(F.lit(h)).alias(text.safe_name(h)) for h in headers]
    )


def cell(header: Column, names: str = "names", values: str = "values") -> Column:
    """Value under a header; null where the header is absent, the first one where it repeats."""
    return F.get(F.col(values), (F.array_position(F.col(names), header) - 1).cast("int"))


def manifest(sheets: DataFrame) -> DataFrame:
    """One row per staged file: rows, columns and column names."""
    ruled = apply_header_rule(sheets).filter("error IS NULL")
    return ruled.select(
        F.col("file_name").alias("file"),
        F.concat(F.regexp_replace("file_name", r"\.[^.]*$", ""), F.lit(".parquet")).alias("parquet_file"),
        "terminal_no",
        F.size("data").alias("rows"),
        F.size("names").alias("cols"),
        F.col("names").alias("columns"),
    )
