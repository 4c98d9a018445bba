"""Bronze rows and yearly history files -> the canonical silver table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from berthlake import fixed_values as fv
from berthlake.functions import text, time as bt
from berthlake.functions.barrier import compute_once
from berthlake.operators.bronze import cell, rows_from
from berthlake.sources import files

TEXT_COLUMNS = ["berth", "carrier", "vessel_name", "mother_vessel", "sun_vessel",
                "head_bridge_stern", "route", "amp", "status"]
TIME_COLUMNS = ["eta", "etd", "closing"]
COUNT_COLUMNS = ["discharge", "loading", "shift"]


def source_cell(column: str) -> Column:
    """The cell that a terminal delivers for a canonical column."""
    headers = {
        t: h for t, names in fv.COLUMN_MAPS.items() for h, std in names.items() if std == column
    }
    return text.clean_token(cell(F.try_element_at(text.literal_map(headers), F.col("terminal_no"))))


def standardize(bronze: DataFrame) -> DataFrame:
    """Text columns under their canonical names; the combined workload cell split."""
    named = bronze.withColumns(
        {c: source_cell(c) for c in TEXT_COLUMNS + TIME_COLUMNS + COUNT_COLUMNS}
        | {fv.WORKLOAD: source_cell(fv.WORKLOAD)}
    )
    triple = text.workload_strict(fv.WORKLOAD)
    return named.withColumns(
        {c: F.when(F.col(fv.WORKLOAD).isNotNull(), triple[c]).otherwise(text.int_or_null(c))
         for c in COUNT_COLUMNS}
    ).drop(fv.WORKLOAD, "names", "values")


def validate(df: DataFrame) -> DataFrame:
    empty = (F.coalesce("berth", F.lit("")) == "") & (F.coalesce("vessel_name", F.lit("")) == "")
    return df.withColumn("is_valid", ~empty).withColumn(
        "error_msg", F.when(empty, fv.INVALID_ROW_MESSAGE)
    )


def enrich(df: DataFrame) -> DataFrame:
    """Typed times, working day, key and derived columns."""
    typed = df.withColumns({c: bt.parse_ts(c) for c in TIME_COLUMNS if dict(df.dtypes)[c] == "string"})
    dated = typed.withColumn("eta_work_date", bt.operational_date("eta").cast("string"))
    return dated.withColumns(
        {
            "business_key": text.business_key(),
            "eta_date": F.to_date("eta"),
            "total_workload": text.total_workload(),
            "eta_hour": F.hour("eta"),
            "eta_dayofweek": F.dayofweek("eta"),
            "is_amp": text.yes_flag("amp"),
        }
    )


def silver_from_bronze(bronze: DataFrame, parsed_at: Column | None = None) -> DataFrame:
    """The canonical table, column expressions only: a map-side job from file to table."""
    rows = standardize(bronze).withColumns(
        {
            "terminal_name": F.try_element_at(text.literal_map(fv.TERMINAL_NAMES), F.col("terminal_no")),
            "source_row_number": F.col("source_row_number").cast("string"),
            "parsed_at": (F.current_timestamp() if parsed_at is None else parsed_at).cast("timestamp_ntz"),
        }
    )
    return enrich(validate(rows)).select(*fv.SILVER_COLUMNS)


def error_log(silver: DataFrame) -> DataFrame:
    """Invalid rows in log form. The id comes from the row id, so a rerun writes the same log."""
    return silver.filter(~F.col("is_valid")).select(
        F.concat(F.lit("err_"), F.left(F.sha2("bronze_row_id", 256), F.lit(8))).alias("error_id"),
        "bronze_row_id", "terminal_id", "source_file_name", "source_row_number",
        F.lit("PARSE_ERROR").alias("error_type"),
        F.col("error_msg").alias("error_message"),
        F.col("parsed_at").cast("string").alias("detected_at"),
    )


# ---------------------------------------------------------------- yearly history files

def normalized_names(names: Column) -> Column:
    return F.transform(names, lambda n: F.regexp_replace(F.lower(n), "[ \n]", ""))


def canonical_names(names: Column) -> Column:
    """Synonyms resolved; an unknown header keeps its own spelling."""
    synonyms = text.literal_map(fv.HISTORY_SYNONYMS)
    return F.transform(
        names,
        lambda n: F.coalesce(F.try_element_at(synonyms, F.regexp_replace(F.lower(n), "[ \n]", "")), n),
    )


def promoted_header(rows: Column) -> Column:
    """Position of the header: row 0, or the first of the next three that has a known word."""
    pattern = "|".join(fv.HISTORY_HEADER_WORDS)

    def has_word(i: int) -> Column:
        row = F.coalesce(F.get(rows, F.lit(i)), F.array().cast("array<string>"))
        return F.exists(row, lambda c: F.coalesce(c.rlike(pattern), F.lit(False)))

    found = F.when(has_word(0), 0)
    for i in (1, 2, 3):
        found = found.when(has_word(i), i)
    return found.otherwise(0)


def with_header(sheets: DataFrame) -> DataFrame:
    header = promoted_header(F.col("rows"))
    return sheets.select(
        "file_name", "terminal_no",
        F.get("rows", header).alias("raw_names"),
        rows_from(F.col("rows"), header + 1).alias("data"),
    ).withColumn("names", canonical_names(F.col("raw_names")))


def historical_silver(
    sheets: DataFrame, parsed_at: Column | None = None, missing_as_text: bool = True
) -> DataFrame:
    """Yearly files of dated calls with stays of [0, 240) hours.

    With ``missing_as_text`` a missing text cell of a present column is the text 'nan', which makes
    such rows valid; without it the cell is null.
    """
    headed = with_header(sheets)
    # positions of the columns, once per file
    place = lambda c: (F.array_position("names", c) - 1).cast("int")
    is_work = F.transform(normalized_names(F.col("raw_names")), lambda n: n.contains(fv.HISTORY_WORKLOAD_WORD))
    wanted = [*TEXT_COLUMNS, *TIME_COLUMNS, *COUNT_COLUMNS]
    headed = compute_once(
        headed, **{f"_{c}": place(c) for c in wanted}, _work=(F.array_position(is_work, True) - 1).cast("int"),
    )
    headed = headed.withColumn("_year", files.year_of_history_file("file_name"))

    def timed(values: Column) -> Column:
        return F.struct(
            bt.parse_ts(F.get(values, F.col("_eta"))).alias("eta"),
            bt.parse_ts(F.get(values, F.col("_etd"))).alias("etd"),
            values.alias("values"),
        )

    stay = lambda r: F.unix_timestamp(r["etd"]) - F.unix_timestamp(r["eta"])
    kept = F.filter(
        F.transform("data", timed),
        lambda r: (stay(r) >= 0) & (stay(r) < fv.MAX_STAY_HOURS * 3600),
    )
    rows = headed.select(
        "file_name", "terminal_no", "_year", "_work", *[f"_{c}" for c in wanted],
        F.posexplode(kept).alias("_pos", "_row"),
    ).select("*", F.col("_row.eta").alias("eta"), F.col("_row.etd").alias("etd"), F.col("_row.values").alias("values"))

    triple = text.workload_lenient(F.get("values", "_work"))
    has = lambda c: F.col(f"_{c}") >= 0
    value_of = lambda c: F.get("values", f"_{c}")

    def text_cell(c: str) -> Column:
        value = value_of(c)
        return F.when(has(c), F.coalesce(value, F.lit("nan"))) if missing_as_text else text.clean_token(value)

    def count_cell(c: str) -> Column:
        # text that is no number, or one outside the integers (nan, inf, too many digits), counts as zero
        value = text.double_or_null(value_of(c))
        number = F.coalesce(F.when(F.abs(value) < 2.0**31, value).cast("int"), F.lit(0))
        return F.when(has(c), number).when(F.col("_work") >= 0, triple[c]).otherwise(0)

    no = F.col("terminal_no").cast("string")
    pos = F.col("_pos")
    padded = text.zero_padded(pos, 5)
    out = rows.withColumns({c: text_cell(c) for c in TEXT_COLUMNS}).withColumns(
        {
            "closing": bt.parse_ts(value_of("closing")),
            **{c: count_cell(c) for c in COUNT_COLUMNS},
            "terminal_id": F.concat(F.lit("terminal_"), no),
            "terminal_name": F.try_element_at(text.literal_map(fv.TERMINAL_NAMES), F.col("terminal_no")),
            "snapshot_id": F.concat_ws("_", F.lit("hist"), no, F.col("_year")),
            "bronze_row_id": F.concat_ws("_", F.lit("hist"), text.zero_padded(no, 2), F.col("_year"), padded),
            "source_file_name": F.col("file_name"),
            "source_row_number": (pos + 1).cast("string"),
            "parsed_at": (F.current_timestamp() if parsed_at is None else parsed_at).cast("timestamp_ntz"),
            "error_msg": F.lit(None).cast("string"),
        }
    )
    identity = [F.coalesce(F.col(c), F.lit("None")) for c in ("berth", "vessel_name")]
    times = [F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("eta", "etd")]
    out = out.withColumns(
        {
            "is_valid": F.col("berth").isNotNull() | F.col("vessel_name").isNotNull(),
            "row_hash": F.md5(F.concat(*identity, *times)),
        }
    )
    return enrich(out).select(*fv.SILVER_COLUMNS)


def union_history(live: DataFrame, history: DataFrame | None) -> DataFrame:
    """Live rows and, where there are any, historical rows, by column name."""
    return live if history is None else live.unionByName(history.select(*live.columns))
