"""Shards by jump consistent hashing, in DataFrame functions only.

The jump walk of a key visits rising shard numbers; the last one below the shard count is its shard. Step ``b`` draws a
number in (0, 1] from the digest of key and ``b``, and jumps to ``floor((b + 1) / draw)``. So a further shard
takes rows from the others only into itself, and no table of shards is kept.

Edge cases: a null key is the key ``null``; null text has no bytes; repeated rows get the shard of their key and slots of
their own; an empty table gives no rows; added columns replace input columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from berthlake.llm.columns import sets_aside

# slots are numbered in this many slices of a shard, so that no task holds a whole shard
SLICES = 4096


def draw(key: Column, step: Column) -> Column:
    """In (0, 1], from the first 52 bits of a digest."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), step.cast("string")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1.0) / float(1 << 52)


def jump_shard(key: Column, shards: int) -> Column:
    """Shard number of a key: at most ``shards`` steps, as each one goes up by one at least."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    def step(state: Column, _: Column) -> Column:
        jumped = F.floor((state["next"] + 1.0) / draw(key, state["next"]))
        # far jumps end the walk all the same; the bound keeps them inside an integer
        onward = F.struct(state["next"].alias("at"), F.least(jumped, F.lit(1 << 30)).cast("int").alias("next"))
        return F.when(state["next"] < shards, onward).otherwise(state)

    start = F.struct(F.lit(0).cast("int").alias("at"), F.lit(0).cast("int").alias("next"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step, lambda state: state["at"])


@sets_aside("_slice", "_rows", "_first", "_at")
def assign(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``shard``, ``slot`` (gapless in the shard) and ``grown_shard``.

    Slots are counted in slices of each shard; the slices' first slots come from their counts.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    placed = docs.withColumns({
        "size": F.octet_length(body).cast("long") + 1,
        "text_crc32": F.crc32(body.cast("binary")),
        "shard": jump_shard(F.col(key), shards),
        "grown_shard": jump_shard(F.col(key), shards + 1),
    })
    placed = placed.withColumn("_slice", F.pmod(F.xxhash64(key, "text_crc32", "size"), F.lit(SLICES)).cast("int"))
    counts = placed.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("shard", "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("shard", "_slice").orderBy(F.col(key), "text_crc32", "size")
    numbered = placed.withColumn("_at", F.row_number().over(within))
    return (
        numbered.join(firsts, ["shard", "_slice"])
        .withColumn("slot", F.col("_first") + F.col("_at") - 1)
        .drop("_slice", "_rows", "_first", "_at")
    )
