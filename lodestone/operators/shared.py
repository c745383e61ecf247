"""Tables that stages hand to each other through the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TASK_ROWS = 1_000_000  # rows that one task sorts or groups


def task_count(rows: int) -> int:
    """Partitions for so many rows, so that a task's memory does not grow with the input."""
    return rows // TASK_ROWS + 1


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one in local mode only. A cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """Cuts a table's lineage: written to the shared folder and read back, so a lost executor costs no recomputation and every reader sees the same rows."""
    path = f"{shared_folder(df.sparkSession)}/lodestone/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.written_path = path
    return found


def removed(*frames: DataFrame) -> None:
    """Deletes tables of `written` once everything that reads them has been written itself."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
