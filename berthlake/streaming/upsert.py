"""The current row per key from a stream, kept as a folded log of micro-batches.

A micro-batch adds its own newest rows as a run of level 0, split by a hash of the key into ``buckets`` folders. Every
``fold`` runs of a level are folded into one run of the next level, which holds the newest row per key of all of them: a row is
rewritten once per level, and readers meet at most ``fold - 1`` runs per level, however many epochs there were. A lookup by
key reads the folders of its bucket alone.

A run counts once it is complete; a repeated epoch writes its own runs anew. Runs that were folded are removed one fold later, so
that readers which began before the fold can finish. ``fold`` and ``buckets`` belong to a log and must not change.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from berthlake.operators.latest import latest_per_key

FOLD = 8
BUCKETS = 16


def _newest(order_by: Sequence[str]):
    return [F.col(c).desc() for c in order_by]


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets))


def _folder(spark: SparkSession, path: str):
    """The file system of a path and the path in its terms."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The values of the folders ``name=value`` below a path."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(f.split("=")[1]) for f in found if f.startswith(f"{name}="))


def live_runs(spark: SparkSession, path: str, fold: int = FOLD) -> list[tuple[int, int]]:
    """(level, last epoch) of the complete runs that no complete run of a higher level covers."""
    kept: list[tuple[int, int]] = []
    for level in reversed(_numbers(spark, path, "level")):
        for epoch in _numbers(spark, f"{path}/level={level}", "epoch"):
            fs, done = _folder(spark, f"{path}/level={level}/epoch={epoch}/_SUCCESS")
            covered = any(up > level and last - fold ** up < epoch <= last for up, last in kept)
            if not covered and fs.exists(done):
                kept.append((level, epoch))
    return sorted(kept)


def _read(spark: SparkSession, path: str, runs: Sequence[tuple[int, int]]) -> DataFrame:
    folders = [f"{path}/level={level}/epoch={epoch}" for level, epoch in runs]
    return spark.read.option("basePath", path).parquet(*folders).drop("level", "epoch")


def _write_run(rows: DataFrame, path: str, level: int, epoch: int, key: str, order_by: Sequence[str], buckets: int) -> None:
    # only the newest rows are dealt to their buckets; a bucket that is large for a task is split over several
    dealt = rows.withColumn("bucket", _bucket(F.col(key), buckets))
    newest = latest_per_key(dealt, ["bucket", key], _newest(order_by))
    newest.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/level={level}/epoch={epoch}")


def add_epoch(
    batch: DataFrame, epoch: int, path: str, key: str = "gold_key", order_by: Sequence[str] = ("snapshot_ts", "bronze_row_id"),
    fold: int = FOLD, buckets: int = BUCKETS,
) -> None:
    """Add a micro-batch as a run, and fold the levels that it fills up."""
    spark = batch.sparkSession
    # streams turn this off for operators with a state of their own; there are none here
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    _write_run(batch, path, 0, epoch, key, order_by, buckets)
    level = 1
    while (epoch + 1) % fold ** level == 0:
        below = level - 1
        there = _numbers(spark, f"{path}/level={below}", "epoch")
        parts = [(below, e) for e in there if epoch - fold ** level < e <= epoch]
        _write_run(_read(spark, path, parts), path, level, epoch, key, order_by, buckets)
        for old in there:
            if 0 <= old <= epoch - fold ** level:  # folded by the fold before this one
                fs, folder = _folder(spark, f"{path}/level={below}/epoch={old}")
                fs.delete(folder, True)
        level += 1


def upsert_latest(
    stream: DataFrame, path: str, checkpoint: str, key: str = "gold_key",
    order_by: Sequence[str] = ("snapshot_ts", "bronze_row_id"), fold: int = FOLD, buckets: int = BUCKETS,
) -> StreamingQuery:
    def merge(batch: DataFrame, epoch: int) -> None:
        add_epoch(batch, epoch, path, key, order_by, fold, buckets)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_rows(
    spark: SparkSession, path: str, key: str = "gold_key",
    order_by: Sequence[str] = ("snapshot_ts", "bronze_row_id"), fold: int = FOLD, buckets: int = BUCKETS,
    keys: Sequence[Any] | None = None,
) -> DataFrame:
    """The current row per key; with ``keys``, of these alone, from the folders of their buckets."""
    log = _read(spark, path, live_runs(spark, path, fold))
    if keys is not None:
        wanted = F.lit(False)
        for k in keys:
            value = F.lit(k).cast(log.schema[key].dataType)
            wanted = wanted | ((F.col("bucket") == _bucket(value, buckets)) & (F.col(key) == value))
        log = log.filter(wanted)
    return latest_per_key(log, [key], _newest(order_by)).drop("bucket")


def compact(
    spark: SparkSession, path: str, target: str, key: str = "gold_key", order_by: Sequence[str] = ("snapshot_ts", "bronze_row_id"),
    fold: int = FOLD, buckets: int = BUCKETS,
) -> DataFrame:
    """Write the current rows as the base (epoch -1) of a new log."""
    _write_run(current_rows(spark, path, key, order_by, fold, buckets), target, 0, -1, key, order_by, buckets)
    return current_rows(spark, target, key, order_by, fold, buckets)
