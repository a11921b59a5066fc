"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the session's checkpoint folder.

    Only a local session (tests on one machine) gets a folder of its own without either; on a
    cluster, executors could not share one of the driver's, so that raises RuntimeError.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            found = held.get()
        elif spark.sparkContext.master.startswith("local"):
            found = tempfile.mkdtemp(prefix="inkmill-shared-")
            spark.sparkContext.setCheckpointDir(found)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return found.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it takes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as a table in the shared folder and read them back.

    The lineage ends there, so lost executors cost no recomputation, and what
    several consumers read is computed once.  The table goes when the application ends, or by ``drop``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, where = file_system(spark, path)
    fs.deleteOnExit(where)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def drop(table: DataFrame) -> None:
    """Delete a table of ``cut`` that nothing will read again."""
    fs, where = file_system(table.sparkSession, table._shared_path)
    fs.delete(where, True)
