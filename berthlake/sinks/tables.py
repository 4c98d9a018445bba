"""Writing tables and staged files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from berthlake.operators import bronze as bz


def write_table(
    df: DataFrame, path: str, view: str | None = None, partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """Overwrite with schema replacement and hand back the stored table (not the query again)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    stored = df.sparkSession.read.parquet(path)
    if view:
        stored.createOrReplaceTempView(view)
    return stored


def write_staging(sheets: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Stage the rows of every good file, all text, one folder per file, plus a manifest table."""
    rows = bz.bronze(sheets).select(
        "source_file_name", "source_row_number", "names", F.col("values").alias("cells")
    )
    rows.write.mode("overwrite").partitionBy("source_file_name").parquet(f"{path}/rows")
    bz.manifest(sheets).write.mode("overwrite").parquet(f"{path}/manifest")
    spark = sheets.sparkSession
    return spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/manifest")


def flatten_arrays(df: DataFrame, separator: str = ", ") -> DataFrame:
    """Every array column as joined text."""
    return df.select(
        *[
            F.concat_ws(separator, F.col(f"`{f.name}`").cast("array<string>")).alias(f.name)
            if isinstance(f.dataType, T.ArrayType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str], partitions: int | None = None
) -> None:
    """Replace a serving table; ``partitions`` bounds the number of connections."""
    flat = flatten_arrays(df)
    if partitions:
        flat = flat.coalesce(partitions)
    flat.write.mode("overwrite").jdbc(url, table, properties=properties)
