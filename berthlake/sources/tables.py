"""Tables that are already columnar, and the small yearly sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from berthlake import fixed_values as fv
from berthlake.functions import text, time as bt
from berthlake.operators.bronze import rows_from


def scan(spark: SparkSession, path: str) -> DataFrame:
    """A stored table. One with fewer splits than cores would leave cores idle, so it is spread over them;
    its splits being few, it is small. Any other is read as it is.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scan_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where the path does not exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def freight_index(rows: DataFrame, category: str = fv.FREIGHT_CATEGORY) -> DataFrame:
    """First three columns of the index sheets: category, value with commas, date; one category."""
    kind, value, day = rows.columns[:3]
    return rows.filter(F.col(kind) == category).select(
        F.col(kind).alias("category"),
        bt.parse_ts(day).cast("date").alias("index_date"),
        text.double_or_null(value).alias("index_value"),
    )


def monthly_sheets(sheets: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """One file per year, of all years or those asked for: an exact name wins over any other file name with that year.

    Row 0 is the title, row 1 the sub-header; a sheet of another width is an error row.
    """
    pattern = r"(20\d{2}|19\d{2})"
    dated = sheets.withColumn("year", F.regexp_extract("file_name", pattern, 1).try_cast("int"))
    dated = dated.filter(F.col("year").isNotNull())
    if first_year is not None:
        dated = dated.filter(F.col("year") >= first_year)
    if last_year is not None:
        dated = dated.filter(F.col("year") <= last_year)
    before, after = fv.MONTHLY_FILE_NAME.split("{year}")
    exact = F.col("file_name") == F.concat(F.lit(before), F.col("year").cast("string"), F.lit(after))
    rank = F.struct(exact.cast("int").alias("exact"), F.col("file_name").alias("name"))
    # file names only: one pick per year, a handful of rows
    picked = dated.groupBy("year").agg(F.max(rank)["name"].alias("file_name"))
    width = F.size(F.get("rows", F.lit(0)))
    return dated.join(picked, ["year", "file_name"]).select(
        "year", "file_name", rows_from(F.col("rows"), F.lit(2)).alias("data"),
        F.coalesce(
            "error",
            F.when(width != len(fv.MONTHLY_COLUMNS),
                   F.concat(F.lit("unexpected column count: "), width.cast("string"))),
        ).alias("error"),
    )


def monthly_rows(sheets: DataFrame) -> DataFrame:
    rows = sheets.filter("error IS NULL").select("year", F.explode("data").alias("_row"))
    return rows.select(
        F.col("year").cast("string").alias("year"),
        *[F.get("_row", F.lit(i)).alias(c) for i, c in enumerate(fv.MONTHLY_COLUMNS)],
    )


def union_years(tables: dict[int, DataFrame]) -> DataFrame:
    """UNION ALL of yearly tables with the year as a column."""
    parts = [df.withColumn("year", F.lit(str(year))) for year, df in sorted(tables.items())]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def scan_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str],
    partition_column: str | None = None, lower: object = None, upper: object = None, partitions: int = 1,
) -> DataFrame:
    """Serving table over JDBC; with a partition column the read is spread over tasks."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return reader.load()
