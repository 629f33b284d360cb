"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas

# Rows of one shuffle partition should fit in an executor's share of memory
# even after decompression; adaptive execution merges what turns out smaller.
SHUFFLE_PARTITION_BYTES = 128 << 20


def session_conf(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job that shuffles about ``shuffle_bytes`` on ``cores`` cores."""
    partitions = max(cores, -(-shuffle_bytes // SHUFFLE_PARTITION_BYTES))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(SHUFFLE_PARTITION_BYTES),
        # Lets a task write all kinds side by side instead of sorting by kind first.
        "spark.sql.maxConcurrentOutputFileWriters": "16",
    }


def work_folder(spark: SparkSession, shared: str | None = None) -> str:
    """Name of a fresh folder below ``shared`` or else the session's ``spark.checkpoint.dir``.

    Driver and executors must both see it. A folder of one machine would lose
    rows without an error, so there is no default.
    """
    shared = shared or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("a shared work folder is needed: pass one or set spark.checkpoint.dir")
    return f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder on any file system that Spark can write to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession, shared: str | None = None) -> Iterator[str]:
    """A work folder that is gone afterwards, also after a failure."""
    folder = work_folder(spark, shared)
    try:
        yield folder
    finally:
        remove_folder(spark, folder)


def staged(rows: DataFrame, ddl: str, folder: str, *partition_by: str) -> DataFrame:
    """Rows written once to ``folder`` and read from there.

    For rows that are needed several times or whose size Spark should know:
    what computes them runs once, each reader gets only its columns and
    partitions, and a lost executor costs no recomputation.
    """
    schemas.conform(rows, ddl).write.partitionBy(*partition_by).parquet(folder)
    return schemas.conform(rows.sparkSession.read.schema(ddl).parquet(folder), ddl)
