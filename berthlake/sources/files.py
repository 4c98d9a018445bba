"""Raw snapshot files as a DataFrame, and what their names say."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from berthlake import fixed_values as fv
from berthlake.functions import text, time as bt

RAW_SUFFIXES = ("xlsx", "xls", "xml")


def _reader(spark: SparkSession, suffixes: Sequence[str]):
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}")
        .option("recursiveFileLookup", "true")
    )


def raw_files(spark: SparkSession, path: str, suffixes: Sequence[str] = RAW_SUFFIXES) -> DataFrame:
    """path, modificationTime, length, content."""
    return _reader(spark, suffixes).load(path)


def file_listing(spark: SparkSession, path: str, suffixes: Sequence[str] = RAW_SUFFIXES) -> DataFrame:
    """Name and size of the files, by name. The contents are pruned from the scan."""
    return (
        raw_files(spark, path, suffixes)
        .select(file_name("path").alias("name"), F.col("length").alias("size"))
        .orderBy("name")
    )


def file_name(path: Column | str) -> Column:
    c = F.col(path) if isinstance(path, str) else path
    return F.url_decode(F.replace(F.regexp_extract(c, r"([^/]+)$", 1), F.lit("+"), F.lit("%2B")))


def terminal_of_file(name: Column | str) -> Column:
    """Number from 'terminal_3_..', else through the leading name token."""
    c = F.col(name) if isinstance(name, str) else name
    number = F.regexp_extract(c, r"terminal_(\d+)_", 1).try_cast("int")
    token = F.lower(F.substring_index(c, "_", 1))
    return F.coalesce(number, F.try_element_at(text.literal_map(fv.FILE_TOKEN_TO_TERMINAL), token))


def terminal_of_history_file(name: Column | str) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_extract(c, rf"(\d+){fv.HISTORY_FILE_WORD}", 1).try_cast("int")


def year_of_history_file(name: Column | str) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    year = F.regexp_extract(c, r"_(\d{4})", 1)
    return F.when(year != "", year).otherwise("0000")


def snapshot_ts_of_file(name: Column | str) -> Column:
    """'.._20260626_10.xls' -> 2026-06-26 10:00."""
    c = F.col(name) if isinstance(name, str) else name
    stamp = r"_(\d{8})_(\d{2})(?:\.[^.]*)?$"
    day, hour = F.regexp_extract(c, stamp, 1), F.regexp_extract(c, stamp, 2)
    return bt.parse_ts(F.concat(day, F.lit(" "), hour, F.lit(":00")))
