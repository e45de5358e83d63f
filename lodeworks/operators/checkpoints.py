"""Where loops cut their lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local session without the setting gets a temporary folder; on a
    cluster one machine's folder would be lost with that machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lodeworks-checkpoints-")
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# With it Spark deletes a job's shuffle files when the job has ended, else when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(rows: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write `rows` to `path` and continue from the files, which outlive any executor; shuffle files of the job are deleted."""
    writer = rows.write if partition_by is None else rows.write.partitionBy(partition_by)
    conf = rows.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table made by `store` that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
