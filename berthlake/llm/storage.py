"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from berthlake.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them from there: lineage ends, lost executors lose nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
