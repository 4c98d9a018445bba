"""Raw files decoded to one row per file with its whole table as array<array<string>>.

A snapshot file is small (the binary reader takes 2 GiB at most), so a file is decoded in one task and its
header is at hand for every row of it: header rules, renaming and row numbering need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from berthlake.functions.barrier import compute_once
from berthlake.sources import files, parsers

_XML_SCHEMA = (
    "Dataset array<struct<ColumnInfo: array<struct<Column: array<struct<_id: string>>>>, "
    "Rows: array<struct<Row: array<struct<Col: array<struct<_id: string, _VALUE: string>>>>>>>>"
)


def _flat(sets: Column, field: str) -> Column:
    """All elements of a repeated child of a list of structs."""
    return F.flatten(F.transform(sets, lambda s: F.coalesce(s[field], F.array())))


def with_dataset_rows(df: DataFrame, content: Column, out: str) -> DataFrame:
    """Add the rows of a dataset XML, the column ids of its first ColumnInfo being row 0."""
    document = F.from_xml(F.make_valid_utf8(content.cast("string")), _XML_SCHEMA)
    parsed = compute_once(df, _datasets=document["Dataset"])
    info = F.get(_flat(F.col("_datasets"), "ColumnInfo"), F.lit(0))
    ids = F.filter(F.transform(info["Column"], lambda c: c["_id"]), lambda i: i.isNotNull())
    rows = _flat(_flat(F.col("_datasets"), "Rows"), "Row")
    parsed = compute_once(parsed, _ids=ids, _rows=rows)

    def by_id(row: Column) -> Column:
        def last_value(i: Column) -> Column:
            hits = F.filter(row["Col"], lambda c: c["_id"] == i)
            return F.get(hits, F.size(hits) - 1)["_VALUE"]

        return F.transform(F.col("_ids"), last_value)

    table = F.concat(F.array("_ids"), F.transform("_rows", by_id))
    parsed = compute_once(parsed, **{out: F.when(F.size("_ids") > 0, table)})
    return parsed.drop("_datasets", "_ids", "_rows")


_decode_binary = F.pandas_udf(
    parsers.decode_batches,
    T.StructType()
    .add("rows", T.ArrayType(T.ArrayType(T.StringType())))
    .add("head_rows", T.IntegerType())
    .add("error", T.StringType()),
)


def decode(raw: DataFrame, terminal: Column | None = None) -> DataFrame:
    """path, file_name, terminal_no, rows, head_rows, error - one row per file."""
    name = files.file_name("path")
    named = raw.select("path", "content", name.alias("file_name"))
    named = named.withColumn("terminal_no", files.terminal_of_file("file_name") if terminal is None else terminal)
    suffix = F.lower(F.substring_index("file_name", ".", -1))
    parsed = with_dataset_rows(named, F.when(suffix == "xml", F.col("content")), "_dataset_rows")
    parsed = parsed.withColumn(
        "_bin", _decode_binary(F.lower("file_name"), F.when(suffix.isin("xls", "xlsx"), F.col("content")))
    )
    problem = (
        F.when(F.col("terminal_no").isNull(), "no terminal number in the file name")
        .when(F.col("_bin.error").isNotNull(), F.col("_bin.error"))
        .when((suffix == "xml") & F.col("_dataset_rows").isNull(), "no column definitions in ColumnInfo")
        .when(~suffix.isin(*files.RAW_SUFFIXES), F.concat(F.lit("unsupported suffix: "), suffix))
    )
    # also keeps a later filter on ``error`` from being pushed down, which would decode twice
    parsed = compute_once(
        parsed,
        rows=F.coalesce(F.col("_dataset_rows"), F.col("_bin.rows")),
        head_rows=F.col("_bin.head_rows"),
        error=problem,
    )
    return parsed.select("path", "file_name", "terminal_no", "rows", "head_rows", "error")


def good(sheets: DataFrame) -> DataFrame:
    return sheets.filter("error IS NULL")


def failed(sheets: DataFrame) -> DataFrame:
    return sheets.filter("error IS NOT NULL").select("file_name", "error")


def cells(sheets: DataFrame) -> DataFrame:
    """Long form: file_name, row_no, col_no (from 1), value."""
    rows = sheets.select("file_name", F.posexplode("rows").alias("r", "row"))
    return rows.select(
        "file_name", (F.col("r") + 1).alias("row_no"), F.posexplode("row").alias("c", "value")
    ).select("file_name", "row_no", (F.col("c") + 1).alias("col_no"), "value")
