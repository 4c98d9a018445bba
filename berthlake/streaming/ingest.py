"""New snapshot files -> bronze rows, each file once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from berthlake.operators import bronze as bz
from berthlake.sources import sheets
from berthlake.sources.files import RAW_SUFFIXES

DELIVERY = "3 days"  # how long after its time a file may be delivered again
BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def raw_file_stream(
    spark: SparkSession, path: str, suffixes: Sequence[str] = RAW_SUFFIXES, files_per_batch: int = 1000
) -> DataFrame:
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_SCHEMA)
        .option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )


def each_file_once(raw: DataFrame, within: str = DELIVERY) -> DataFrame:
    """A file that is delivered again, by the same name with the same content, is left out.

    Its digest stays in the state for ``within`` after its time; the same content under another name is another snapshot.
    """
    named = raw.withColumns({"_name": F.element_at(F.split("path", "/"), -1), "_digest": F.sha2("content", 256)})
    once = named.withWatermark("modificationTime", within).dropDuplicatesWithinWatermark(["_name", "_digest"])
    return once.drop("_name", "_digest")


def ingest(raw: DataFrame, path: str, checkpoint: str, within: str = DELIVERY) -> StreamingQuery:
    """Start the stream; the file source log and the file sink together write every delivery once, and each file counts once."""
    return (
        bz.bronze(sheets.decode(each_file_once(raw, within)))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
