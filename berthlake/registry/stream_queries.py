"""Streams over the given tables, run to the end of the input and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from berthlake import testbed as tb, testbed_files as tf
from berthlake.operators import changes
from berthlake.registry import query, schedule_queries as sq
from berthlake.session import scratch_path
from berthlake.streaming import changes as sc, ingest, upsert


def staged_stream(df, label, by, parts=3):
    """Rows dealt by a hash of ``by`` to parts that are stored one after the other, and a stream that reads about one part per micro-batch.

    A part has a file per task, so its size bounds no task; parts are mixed in time.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    for part in range(parts):
        df.filter(F.pmod(F.xxhash64(by), F.lit(parts)) == part).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    per_batch = -(-len(stored.inputFiles()) // parts)
    return spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", max(1, per_batch)).parquet(path)


@query("stream_snapshot_ingest", f"""WITH {tf.RAW_SQL}
SELECT file_name AS source_file_name, r AS source_row_number, snapshot_ts,
  array_to_string(list_transform({tf.sql_by_terminal(tf.sql_list)}, lambda v: coalesce(v, '~')), ', ') AS cells FROM raw""")
def stream_snapshot_ingest(spark, sf):
    out = scratch_path(spark, "stream-bronze")
    files = tf.raw_files(spark, sf).withColumn("modificationTime", F.lit("2026-01-01").cast("timestamp"))
    raw = staged_stream(files, "stream-raw", "path")
    ingest.ingest(raw, out, scratch_path(spark, "stream-log")).awaitTermination()
    return spark.read.parquet(out).select(
        "source_file_name", "source_row_number", "snapshot_ts", F.array_join("values", ", ", "~").alias("cells"))


STREAM_OUT = ["bronze_row_id", "gold_key", "berth", "prev_berth", "eta", "prev_eta", "discharge", "prev_discharge",
              "change_type", "change_detail"]


@query("stream_change_detect",
       sq.change_sql("gold_key", changes.BERTH_FIRST, True, ", ".join(STREAM_OUT)) + sq.KEPT)
def stream_change_detect(spark, sf):
    """The schedule rows in files that are not in the order of their times: rows come late in every batch."""
    stream = staged_stream(sq.integrated(spark, sf).drop("created_at"), "stream-silver", "bronze_row_id")
    out = scratch_path(spark, "stream-changes")
    sc.merge_changes(stream, out, scratch_path(spark, "stream-log"), expiry="20000 days", buckets=8).awaitTermination()
    return sc.current_changes(spark, out).select(*STREAM_OUT)


@query("stream_latest_upsert",
       f"WITH {tb.INTEGRATED_SQL}, {sq.LATEST_SQL} SELECT gold_key, bronze_row_id, berth, eta, row_hash FROM latest")
def stream_latest_upsert(spark, sf):
    out = scratch_path(spark, "stream-latest")
    stream = staged_stream(sq.integrated(spark, sf).drop("created_at"), "stream-gold", "bronze_row_id")
    upsert.upsert_latest(stream, out, scratch_path(spark, "stream-log")).awaitTermination()
    return upsert.current_rows(spark, out).select("gold_key", "bronze_row_id", "berth", "eta", "row_hash")
