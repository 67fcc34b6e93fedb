"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Text work and file writing cost more than their shuffled bytes tell, so small
# shuffles keep their tasks; large ones are cut by the advisory size as ever.
# Gathered diffs are bounded, so a task may hold this many before it turns to sorting.
# A batch of texts for Python is held there several times over, so it has few rows.
# Folders are listed many to a task: a task for each costs more than what it lists.
_SETTINGS = {
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1024",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}

# Has Spark (4.1 and later) remove the shuffle files of a written table with the end of its job, not when the driver
# happens to collect its memory.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Rows up to which a settled table is broadcast where ``sized`` is asked.
BROADCAST_ROWS = 100_000


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are planned for."""
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="commitloom-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/commitloom/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one result feeds several branches: it is computed once, outlives
    lost executors, and the reader gets column pruning and a true size for
    join planning, which a plain checkpoint does not give.  What was shuffled
    for it is freed, as nothing else reads that.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_FREED, before)
    return spark.read.parquet(path)


def sized(settled: DataFrame) -> DataFrame:
    """A settled table with the way in which it is joined, by its rows, which are counted from the file ends.

    Spark takes a table to be as large as its files, but narrow rows are packed
    into a byte or less and take a hundred in the driver that gathers them for
    a broadcast.  Many rows are therefore joined by a sort, which can spill; a
    table of few that meets one of many is broadcast.
    """
    return F.broadcast(settled) if settled.count() <= BROADCAST_ROWS else settled.hint("merge")
