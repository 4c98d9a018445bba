"""Registered queries: name -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from berthlake.session import tune


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Column types that every result comparer reads alike: dates as text, arrays joined."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ", ")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(tune(spark), sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(run, sql)
        return fn

    return register


def load_all() -> dict[str, Query]:
    from berthlake.registry import (  # noqa: F401
        forecast_queries, ingest_queries, panel_queries, schedule_queries, stream_queries,
    )

    return QUERIES
