"""Change detection on a stream of silver rows: the same result as the batch operator, in whatever order rows come.

Each micro-batch is merged with the rows that later ones may still need, held per bucket of keys in order of their time. Every new
row is compared with the row before it, and the row after it is compared anew, so a late row corrects its neighbour. The log takes
both, and the newest entry of a row holds; an entry may also say that nothing changed any more, which retracts an earlier one.

Rows older than ``expiry`` before the newest time seen leave the state, except for the last one of each key. A row that comes
even before that one cannot be placed; it goes to a side table of its own (``late_rows``) and is never dropped silently.

Every write goes to a folder named by the epoch and replaces what a failed attempt left there, so a repeated epoch changes
nothing. A row that is delivered again counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from berthlake.operators import changes, skew
from berthlake.operators.latest import latest_per_key

EXPIRY = "30 days"
BUCKETS = 16
TIME, ROW = "snapshot_ts", "bronze_row_id"


def merge_batch(
    batch: DataFrame, epoch: int, path: str, key: str, causes: Sequence[tuple[str, str]], null_safe: bool, expiry: str, buckets: int,
) -> None:
    spark = batch.sparkSession
    # streams turn this off for operators with a state of their own; there are none here
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    tracked = changes.tracked_columns(causes)
    order = [TIME, ROW]
    identity = [key, *order]
    kept = list(dict.fromkeys([*identity, *tracked]))
    place = F.struct(*order)

    fresh = batch.select(*kept, F.lit(False).alias("_base"), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("state_bucket"))
    fresh = fresh.dropDuplicates(identity).persist()
    # one row per bucket at most
    touched = [r[0] for r in fresh.select("state_bucket").distinct().collect()]
    epochs, high = {}, None
    if epoch > 0:
        rows = spark.read.parquet(f"{path}/manifest/{epoch - 1}").collect()
        epochs = {r["state_bucket"]: r["at"] for r in rows if r["at"] is not None}
        high = max((r["high"] for r in rows if r["high"] is not None), default=None)
    folders = [f"{path}/state/epoch={epochs[b]}/state_bucket={b}" for b in touched if b in epochs]
    known = fresh.limit(0)
    if folders:
        known = spark.read.schema(fresh.schema).option("basePath", f"{path}/state").parquet(*folders).select(*fresh.columns)

    # what is known already, and what comes before all that is still held
    new = fresh.join(known.select(*identity), identity, "left_anti")
    held_from = known.filter("_base").select(key, place.alias("_from"))
    new = new.join(held_from, key, "left").withColumn("_late", F.coalesce(place < F.col("_from"), F.lit(False))).drop("_from")
    new.filter("_late").select(*kept).write.mode("overwrite").parquet(f"{path}/late/epoch={epoch}")
    new = new.filter("NOT _late").drop("_late")

    rows = known.withColumn("_fresh", F.lit(False)).unionByName(new.withColumn("_fresh", F.lit(True)))
    # the log and the state are two writes of the same sorted rows
    rows = skew.previous_row(rows, [key], order, [*tracked, "_fresh"], F.unix_timestamp(TIME)).persist(StorageLevel.DISK_ONLY)
    prev = F.col("_prev")
    compared = rows.filter(F.col("_fresh") | F.coalesce(prev["_fresh"], F.lit(False)))
    compared = compared.withColumn("change_type", changes.change_type(prev["row_hash"], F.col("row_hash")))
    compared = compared.withColumn("change_detail", changes.change_detail(prev, causes, null_safe))
    compared.select(*kept, *[prev[c].alias(f"prev_{c}") for c in tracked], "change_type", "change_detail").write.mode(
        "overwrite").parquet(f"{path}/log/epoch={epoch}")

    newest = fresh.agg(F.max(TIME)).first()[0]
    high = max((t for t in (high, newest) if t is not None), default=None)
    horizon = F.lit(high).cast(batch.schema[TIME].dataType) - F.expr(f"INTERVAL '{expiry}'")
    last_old = rows.filter(F.col(TIME) < horizon).groupBy(key).agg(F.max(place).alias("_last"))
    state = rows.join(last_old, key, "left")
    is_last = F.coalesce(place == F.col("_last"), F.lit(False))
    state = state.filter((F.col(TIME) >= horizon) | is_last)
    state = state.withColumn("_base", F.col("_base") | (is_last & prev.isNotNull()))
    # a bucket that is large for a task is split over several
    dealt = state.select(*fresh.columns).hint("rebalance", "state_bucket")
    dealt.write.mode("overwrite").partitionBy("state_bucket").parquet(f"{path}/state/epoch={epoch}")

    now = {**epochs, **{b: epoch for b in touched}}
    manifest = [(b, e, high) for b, e in now.items()] or [(None, None, high)]
    spark.createDataFrame(manifest, f"state_bucket int, at bigint, high {batch.schema[TIME].dataType.simpleString()}").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/manifest/{epoch}")
    rows.unpersist()
    fresh.unpersist()


def merge_changes(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "gold_key",
    causes: Sequence[tuple[str, str]] = tuple(changes.BERTH_FIRST),
    null_safe: bool = True,
    expiry: str = EXPIRY,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Start the stream; ``expiry`` is an interval, ``buckets`` the number of key buckets that a batch reads and writes apart."""
    return (
        stream.writeStream.foreachBatch(lambda batch, epoch: merge_batch(batch, epoch, path, key, causes, null_safe, expiry, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_changes(spark: SparkSession, path: str, key: str = "gold_key") -> DataFrame:
    """The NEW and CHANGED rows as they stand now: the newest entry of each row, retracted ones left out."""
    newest = latest_per_key(spark.read.parquet(f"{path}/log"), [key, TIME, ROW], [F.col("epoch").desc()])
    return newest.filter(F.col("change_type") != "NO_CHANGE").drop("epoch")


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came when all their neighbours had left the state."""
    return spark.read.parquet(f"{path}/late").drop("epoch")
