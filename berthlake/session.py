"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on. All of them can be set on a live session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # terminal x hour groups with collect_set: keep the map-side combine hash based
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def get_spark(app: str = "berthlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach. A private one is made only where the cluster names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = getattr(spark, "_berthlake_scratch", None)
    if not base:
        base = tempfile.mkdtemp(prefix="berthlake-")
        spark._berthlake_scratch = base
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"berthlake-{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to reliable storage and go on from there; survives lost executors."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
